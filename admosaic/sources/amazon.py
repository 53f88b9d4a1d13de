"""amazon: pages ``{"data" | "ads" | "advertisers": [...], "pagination", "total"}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import media_type_by_name
from ..functions.text import string_list
from .base import Source, next_offset, pick


def _mapping(p: Column) -> dict[str, Column]:
    return {
        "ad_id": F.coalesce(p["id"], p["ad_id"]),
        "advertiser_id": p["advertiser_id"],
        "advertiser_name": F.coalesce(p["advertiser_name"], p["advertiser"]),
        "first_seen": parse_datetime(F.coalesce(p["first_shown"], p["start_date"])),
        "last_seen": parse_datetime(F.coalesce(p["last_shown"], p["end_date"])),
        "ad_text": F.coalesce(p["ad_text"], p["creative_text"]),
        "media_type": media_type_by_name(p["creative_type"], p["media_type"]),
        "countries": F.array_compact(F.array(p["country"])),
        "spend_range": F.coalesce(p["spend_range"], p["spend"]),
        "targeting_age": string_list(p["age_targeting"]),
        "targeting_gender": string_list(p["gender_targeting"]),
        "targeting_locations": string_list(p["location_targeting"]),
    }


AMAZON = Source(
    name="amazon",
    page=(
        "data array<string>, ads array<string>, advertisers array<string>, "
        "pagination struct<offset: bigint, limit: bigint, total: bigint>, total bigint"
    ),
    payload=(
        "id string, ad_id string, advertiser_id string, advertiser_name string, advertiser string, "
        "first_shown string, start_date string, last_shown string, end_date string, ad_text string, "
        "creative_text string, creative_type string, media_type string, country string, "
        "spend_range string, spend string, age_targeting string, gender_targeting string, "
        "location_targeting string"
    ),
    items=lambda page, operation, body: pick(
        operation,
        F.coalesce(page["data"], page["ads"]),
        advertisers=F.coalesce(page["data"], page["advertisers"]),
    ),
    total=lambda page: page["total"],
    next_position=lambda page: next_offset(
        page["pagination"]["offset"], page["pagination"]["limit"], page["pagination"]["total"], 100
    ),
    mapping=_mapping,
)
