"""x: pages ``{"data": [...], "meta": {"next_token", "result_count"}}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import media_type_from_media
from ..functions.text import present_strings, string_list
from .base import Source


def _mapping(p: Column) -> dict[str, Column]:
    return {
        "ad_id": F.coalesce(p["id"], p["tweet_id"]),
        "advertiser_id": p["advertiser_id"],
        "advertiser_name": F.coalesce(p["advertiser_name"], p["account_name"]),
        "advertiser_verified": F.coalesce(p["verified"], F.lit(False)),
        "first_seen": parse_datetime(F.coalesce(p["created_at"], p["start_time"])),
        "last_seen": parse_datetime(F.coalesce(p["updated_at"], p["end_time"])),
        "ad_text": F.coalesce(p["text"], p["tweet_text"]),
        "media_type": media_type_from_media(p["media"]["type"]),
        "media_urls": present_strings(p["media"]["url"]),
        "landing_url": F.try_element_at(p["entities"]["urls"]["expanded_url"], F.lit(1)),
        "countries": string_list(p["geo_targeting"]["countries"]),
        "spend_range": F.coalesce(p["spend"], p["promotion_spend"]),
        "targeting_age": string_list(p["age_targeting"]),
        "targeting_gender": string_list(p["gender_targeting"]),
        "targeting_locations": string_list(p["geo_targeting"]["locations"]),
        "targeting_interests": present_strings(p["entities"]["hashtags"]["text"]),
    }


X = Source(
    name="x",
    page="data array<string>, meta struct<next_token: string, result_count: bigint>",
    payload=(
        "id string, tweet_id string, advertiser_id string, advertiser_name string, account_name string, "
        "verified boolean, created_at string, start_time string, updated_at string, end_time string, "
        "text string, tweet_text string, spend string, promotion_spend string, "
        "media array<struct<type: string, url: string>>, "
        "entities struct<urls: array<struct<expanded_url: string>>, hashtags: array<struct<text: string>>>, "
        "geo_targeting struct<countries: string, locations: string>, age_targeting string, "
        "gender_targeting string"
    ),
    items=lambda page, operation, body: page["data"],
    total=lambda page: page["meta"]["result_count"],
    next_position=lambda page: page["meta"]["next_token"],
    mapping=_mapping,
)
