"""meta: pages ``{"data": [...], "paging": {"next"}}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.media import media_type_by_name
from ..functions.ranges import impressions_from_payload, range_high, range_low, spend_from_payload
from ..functions.text import collapse_list, string_list
from .base import Source


def _mapping(p: Column) -> dict[str, Column]:
    return {
        "ad_id": p["id"],
        "advertiser_id": p["page_id"],
        "advertiser_name": p["page_name"],
        "advertiser_verified": p["page_verification"].isNotNull(),
        "payer": p["beneficiary_payers"]["payer"],
        "beneficiary": p["beneficiary_payers"]["beneficiary"],
        "first_seen": parse_datetime(p["ad_delivery_start_time"]),
        "last_seen": parse_datetime(p["ad_delivery_stop_time"]),
        "ad_text": collapse_list(p["ad_creative_bodies"], max_items=None),
        "ad_library_url": p["ad_snapshot_url"],
        "media_type": media_type_by_name(p["media_type"]),
        "media_urls": F.array_compact(F.array(p["ad_snapshot_url"])),
        "countries": F.array_compact(p["impressions_by_country"]["country"]),
        "spend_range": spend_from_payload(p["spend"]),
        "impressions_range": impressions_from_payload(p["impressions"]),
        "eu_reach": p["eu_total_reach"],
        "targeting_age": string_list(p["target_ages"]),
        "targeting_gender": string_list(p["target_gender"]),
        "targeting_locations": string_list(p["target_locations"]),
        "spend_low": range_low(p["spend"]),
        "spend_high": range_high(p["spend"]),
        "impressions_low": range_low(p["impressions"]),
        "impressions_high": range_high(p["impressions"]),
    }


META = Source(
    name="meta",
    page="data array<string>, paging struct<next: string>",
    payload=(
        "id string, page_id string, page_name string, page_verification string, ad_snapshot_url string, "
        "ad_delivery_start_time string, ad_delivery_stop_time string, ad_creative_bodies array<string>, "
        "media_type string, spend string, impressions string, eu_total_reach string, "
        "beneficiary_payers struct<payer: string, beneficiary: string>, target_ages string, "
        "target_gender string, target_locations string, impressions_by_country array<struct<country: string>>"
    ),
    items=lambda page, operation, body: page["data"],
    next_position=lambda page: page["paging"]["next"],
    mapping=_mapping,
)
