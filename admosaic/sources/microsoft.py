"""microsoft: OData pages ``{"value": [...], "@odata.count", "@odata.nextLink"}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import media_type_from_assets
from ..functions.text import join_text_parts, present_strings, string_list
from .base import Source, one_object, pick


def _mapping(p: Column) -> dict[str, Column]:
    assets = F.from_json(p["AssetJson"], "array<struct<AssetUrl: string, AssetType: string>>")
    urls = present_strings(assets["AssetUrl"])
    return {
        "ad_id": p["AdId"],
        "advertiser_id": p["AdvertiserId"],
        "advertiser_name": p["AdvertiserName"],
        "first_seen": parse_datetime(p["AdDetails"]["StartDate"]),
        "last_seen": parse_datetime(p["AdDetails"]["EndDate"]),
        "ad_text": join_text_parts([p["Title"], p["Description"]]),
        "ad_creative_urls": urls,
        "media_type": media_type_from_assets(assets["AssetType"]),
        "media_urls": urls,
        "landing_url": p["DestinationUrl"],
        "countries": F.array_compact(p["ImpressionsByCountry"]["Country"]),
        "impressions_range": p["AdDetails"]["TotalImpressionsRange"],
        "targeting_other": string_list(p["TargetTypes"]),
        "advertiser_url": p["DisplayUrl"],
    }


MICROSOFT = Source(
    name="microsoft",
    page="value array<string>, `@odata.count` bigint, `@odata.nextLink` string",
    payload=(
        "AdId string, AdvertiserId string, AdvertiserName string, Title string, Description string, "
        "DisplayUrl string, DestinationUrl string, AssetJson string, TargetTypes string, "
        "AdDetails struct<StartDate: string, EndDate: string, TotalImpressionsRange: string>, "
        "ImpressionsByCountry array<struct<Country: string>>"
    ),
    items=lambda page, operation, body: pick(operation, page["value"], details=one_object(body)),
    total=lambda page: page["@odata.count"],
    next_position=lambda page: F.nullif(
        F.regexp_extract(page["@odata.nextLink"], r"\$skip=([0-9]+)", 1), F.lit("")
    ),
    mapping=_mapping,
)
