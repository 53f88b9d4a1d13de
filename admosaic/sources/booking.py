"""booking: pages ``{"data" | "ads": [...], "total"}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import media_type_by_name
from ..functions.text import string_list
from .base import Source


def _mapping(p: Column) -> dict[str, Column]:
    return {
        "ad_id": F.coalesce(p["id"], p["ad_id"]),
        "advertiser_name": F.lit("Booking.com"),
        "advertiser_type": F.lit("travel_platform"),
        "first_seen": parse_datetime(p["start_date"]),
        "last_seen": parse_datetime(p["end_date"]),
        "ad_text": F.coalesce(p["ad_text"], p["description"]),
        "media_type": media_type_by_name(p["media_type"]),
        "countries": string_list(p["target_countries"]),
    }


_PAGING = "struct<next: string, next_token: string, next_page_token: string>"

BOOKING = Source(
    name="booking",
    page=f"data array<string>, ads array<string>, paging {_PAGING}, pagination {_PAGING}, total bigint",
    payload=(
        "id string, ad_id string, start_date string, end_date string, ad_text string, "
        "description string, media_type string, target_countries string"
    ),
    items=lambda page, operation, body: F.coalesce(page["data"], page["ads"]),
    total=lambda page: page["total"],
    next_position=lambda page: F.coalesce(
        *[
            F.coalesce(page["paging"], page["pagination"])[name]
            for name in ("next", "next_token", "next_page_token")
        ]
    ),
    mapping=_mapping,
)
