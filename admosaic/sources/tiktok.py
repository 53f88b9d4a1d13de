"""tiktok: pages ``{"data": {"ads" | "advertisers": [...]}}`` or ``{"data": [...]}``; flat and nested items."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import collect_urls
from ..functions.text import string_list
from .base import Source, bound, one_object, pick, strings

_DATA = (
    "ads array<string>, advertisers array<string>, total_count bigint, "
    "pagination struct<next_page_token: string>"
)


def _parsed(page: Column) -> Column:
    """The page with its object of data, which is read several times, parsed once."""
    data = F.from_json(F.when(page["data"].startswith("{"), page["data"]), _DATA)
    return F.struct(page["data"].alias("data"), page["error"].alias("error"), page["pagination"].alias("pagination"), data.alias("inner"))


def _items(page: Column, operation: Column, body: Column) -> Column:
    listed = strings(F.when(page["data"].startswith("["), page["data"]))
    found = pick(
        operation,
        F.coalesce(page["inner"]["ads"], listed),
        advertisers=F.coalesce(page["inner"]["advertisers"], listed),
        details=one_object(page["data"]),
    )
    return F.when(page["error"].isNull(), found)


def _mapping(p: Column) -> dict[str, Column]:
    nested = p["ad"].isNotNull()
    info, asked = p["ad_group"]["targeting_info"], p["targeting"]
    nested_urls = collect_urls(p["ad"]["videos"]["url"], p["ad"]["image_urls"])
    nested_media = F.when(F.size(nested_urls) > 0, F.lit("video")).otherwise(F.lit("unknown"))
    return {
        "ad_id": F.coalesce(p["ad"]["id"], p["ad_id"], p["id"]),
        "advertiser_id": F.coalesce(p["advertiser"]["business_id"], p["advertiser_id"]),
        "advertiser_name": F.coalesce(p["advertiser"]["business_name"], p["advertiser_name"], p["brand_name"]),
        "advertiser_verified": F.when(~nested, F.coalesce(p["advertiser_verified"], F.lit(False))),
        "status": p["ad"]["status"],
        "first_seen": parse_datetime(F.coalesce(p["ad"]["first_shown_date"], p["first_shown_date"], p["start_date"])),
        "last_seen": parse_datetime(F.coalesce(p["ad"]["last_shown_date"], p["last_shown_date"], p["end_date"])),
        "ad_text": F.coalesce(p["ad_text"], p["caption"]),
        "media_type": F.when(nested, nested_media).otherwise(F.lit("video")),
        "media_urls": F.when(nested, nested_urls).otherwise(string_list(p["video_url"])),
        "landing_url": F.coalesce(p["landing_url"], p["click_url"]),
        "countries": string_list(F.coalesce(p["reach_countries"], p["countries"])),
        "impressions_range": p["reach"]["unique_users_seen"],
        "targeting_age": string_list(F.coalesce(info["age"], asked["age_groups"])),
        "targeting_gender": string_list(F.coalesce(info["gender"], asked["gender"])),
        "targeting_locations": string_list(F.coalesce(info["country"], asked["locations"])),
        "targeting_interests": F.concat(
            string_list(asked["interests"]), F.array_compact(F.array(F.coalesce(p["industry"], p["category"])))
        ),
        "targeting_behaviors": string_list(asked["behaviors"]),
    }


TIKTOK = Source(
    name="tiktok",
    page="data string, error string, pagination struct<next_page_token: string>",
    payload=(
        "ad_id string, id string, advertiser_id string, advertiser_name string, brand_name string, "
        "advertiser_verified boolean, first_shown_date string, start_date string, last_shown_date string, "
        "end_date string, ad_text string, caption string, landing_url string, click_url string, "
        "industry string, category string, video_url string, reach_countries string, countries string, "
        "targeting struct<age_groups: string, gender: string, locations: string, interests: string, "
        "behaviors: string>, "
        "ad struct<id: string, first_shown_date: string, last_shown_date: string, status: string, "
        "videos: array<struct<url: string>>, image_urls: array<string>>, "
        "advertiser struct<business_id: string, business_name: string>, "
        "reach struct<unique_users_seen: string>, "
        "ad_group struct<targeting_info: struct<age: string, gender: string, country: string>>"
    ),
    items=_items,
    total=lambda page: page["inner"]["total_count"],
    next_position=lambda page: F.coalesce(
        page["inner"]["pagination"]["next_page_token"], page["pagination"]["next_page_token"]
    ),
    error=lambda page: F.coalesce(F.get_json_object(page["error"], "$.message"), page["error"]),
    mapping=_mapping,
    parsed=lambda page: bound(page, _parsed),
)
