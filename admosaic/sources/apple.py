"""apple: pages ``{"data": [...], "pagination"}`` for ads, advertisers and countries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import collect_urls, media_type_from_urls
from ..functions.text import join_text_parts, string_list
from .base import Source, next_offset

_ASSET = "struct<pictureUrl: string, videoUrl: string>"


def _mapping(p: Column) -> dict[str, Column]:
    assets = F.when(
        p["adAssets"].startswith("["), F.from_json(p["adAssets"], f"array<{_ASSET}>")
    ).when(p["adAssets"].startswith("{"), F.array(F.from_json(p["adAssets"], _ASSET)))
    banner, audience = p["adBanner"], p["audienceRefinement"]
    return {
        "ad_id": p["adId"],
        "advertiser_id": p["developerId"],
        "advertiser_name": p["developerName"],
        "advertiser_type": F.lit("app_developer"),
        "first_seen": parse_datetime(F.left(p["firstImpressionDate"], F.lit(10))),
        "last_seen": parse_datetime(F.left(p["lastImpressionDate"], F.lit(10))),
        "ad_text": F.coalesce(
            join_text_parts([banner["subtitle"], banner["shortDescription"], banner["promotionalText"]]),
            p["shortDescription"],
            p["promotionalText"],
        ),
        "media_type": media_type_from_urls(assets["videoUrl"], assets["pictureUrl"]),
        "media_urls": collect_urls(assets["pictureUrl"], assets["videoUrl"]),
        "countries": string_list(p["countryOrRegion"]),
        "targeting_age": string_list(audience["ageTarget"]),
        "targeting_gender": string_list(audience["genderTarget"]),
        "targeting_locations": string_list(audience["locationTarget"]),
        "targeting_interests": F.array_compact(F.array(p["appCategory"])),
    }


APPLE = Source(
    name="apple",
    page="data array<string>, pagination struct<offset: bigint, limit: bigint, total: bigint>",
    payload=(
        "adId string, developerId string, developerName string, appName string, appCategory string, "
        "firstImpressionDate string, lastImpressionDate string, countryOrRegion string, "
        "adBanner struct<subtitle: string, shortDescription: string, promotionalText: string>, "
        "shortDescription string, promotionalText string, adAssets string, "
        "audienceRefinement struct<ageTarget: string, genderTarget: string, locationTarget: string>"
    ),
    items=lambda page, operation, body: page["data"],
    next_position=lambda page: next_offset(
        page["pagination"]["offset"], page["pagination"]["limit"], page["pagination"]["total"], 100
    ),
    mapping=_mapping,
)
