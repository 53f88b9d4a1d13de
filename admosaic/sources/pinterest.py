"""pinterest: pages ``{"items" | "data": [...], "bookmark"}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.text import string_list
from .base import Source


def _mapping(p: Column) -> dict[str, Column]:
    asked = p["targeting"]
    return {
        "ad_id": F.coalesce(p["id"], p["pin_id"]),
        "advertiser_id": p["advertiser_id"],
        "advertiser_name": p["advertiser_name"],
        "first_seen": parse_datetime(F.coalesce(p["created_time"], p["start_time"])),
        "last_seen": parse_datetime(F.coalesce(p["updated_time"], p["end_time"])),
        "ad_text": F.coalesce(p["pin_description"], p["title"]),
        "media_type": F.lit("image"),
        "media_urls": F.array_compact(F.array(F.coalesce(p["pin_url"], p["image_url"]))),
        "landing_url": F.coalesce(p["destination_url"], p["link"]),
        "countries": string_list(asked["countries"]),
        "targeting_age": string_list(asked["age_bucket"]),
        "targeting_gender": string_list(asked["genders"]),
        "targeting_locations": string_list(asked["geo"]),
        "targeting_interests": string_list(asked["interests"]),
        "targeting_behaviors": string_list(p["keywords"]),
    }


PINTEREST = Source(
    name="pinterest",
    page="items array<string>, data array<string>, bookmark string",
    payload=(
        "id string, pin_id string, advertiser_id string, advertiser_name string, created_time string, "
        "start_time string, updated_time string, end_time string, pin_description string, title string, "
        "pin_url string, image_url string, destination_url string, link string, "
        "targeting struct<countries: string, interests: string, age_bucket: string, genders: string, "
        "geo: string>, keywords string"
    ),
    items=lambda page, operation, body: F.coalesce(page["items"], page["data"]),
    next_position=lambda page: page["bookmark"],
    mapping=_mapping,
)
