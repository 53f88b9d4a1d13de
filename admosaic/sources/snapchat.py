"""snapchat: pages ``{"ad_previews": [{"sub_request_status", "ad_preview"}], "paging": {"next_link"}}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.text import string_list
from .base import Source, one_object, pick


def _items(page: Column, operation: Column, body: Column) -> Column:
    good = F.filter(page["ad_previews"], lambda x: x["sub_request_status"] == "SUCCESS")
    return pick(operation, F.array_compact(good["ad_preview"]), details=one_object(page["ad_preview"]))


def _mapping(p: Column) -> dict[str, Column]:
    ballot = p["CandidateBallotInformation"]
    return {
        "ad_id": F.coalesce(p["AdID"], p["Id"]),
        "advertiser_name": F.coalesce(p["OrganizationName"], p["AdvertiserName"]),
        "advertiser_type": F.when(ballot.isNotNull(), F.lit("political")).otherwise(F.lit("advocacy")),
        "beneficiary": ballot["CandidateName"],
        "first_seen": parse_datetime(F.coalesce(p["StartDate"], p["CreatedDate"])),
        "last_seen": parse_datetime(F.coalesce(p["EndDate"], p["LastServedDate"])),
        "media_type": F.lit("video"),
        "countries": F.array_compact(F.array(p["CountryCode"])),
        "spend_range": F.coalesce(p["Spend"], p["SpendUSD"]),
        "impressions_range": p["Impressions"],
        "targeting_age": string_list(p["AgeTargeting"]),
        "targeting_gender": string_list(p["GenderTargeting"]),
        "targeting_locations": string_list(p["GeoTargeting"]),
    }


SNAPCHAT = Source(
    name="snapchat",
    page=(
        "ad_previews array<struct<sub_request_status: string, ad_preview: string>>, ad_preview string, "
        "paging struct<next_link: string>"
    ),
    payload=(
        "AdID string, Id string, OrganizationName string, AdvertiserName string, StartDate string, "
        "CreatedDate string, EndDate string, LastServedDate string, Spend string, SpendUSD string, "
        "Impressions string, CountryCode string, AgeTargeting string, GenderTargeting string, "
        "GeoTargeting string, CandidateBallotInformation struct<CandidateName: string>"
    ),
    items=_items,
    next_position=lambda page: F.nullif(
        F.regexp_extract(page["paging"]["next_link"], "cursor=([^&]+)", 1), F.lit("")
    ),
    mapping=_mapping,
)
