"""linkedin: pages ``{"elements": [...], "paging": {"start", "count", "total"}}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.linkedin import facet_segments, strip_country_urn
from ..functions.media import media_type_from_format
from ..functions.ranges import impressions_range_text
from ..functions.text import id_from_url
from .base import Source, next_offset


def utc_day(millis: Column) -> Column:
    """Midnight of the UTC day of an epoch in milliseconds."""
    return F.date_trunc("DAY", F.timestamp_millis(millis))


def _mapping(p: Column) -> dict[str, Column]:
    who, stats = p["details"]["advertiser"], p["details"]["adStatistics"]
    targeting, shown = p["details"]["adTargeting"], stats["totalImpressions"]
    both = shown["from"].isNotNull() & shown["to"].isNotNull()
    return {
        "ad_id": id_from_url(p["adUrl"]),
        "advertiser_id": id_from_url(who["advertiserUrl"]),
        "advertiser_name": who["advertiserName"],
        "payer": who["adPayer"],
        "first_seen": utc_day(stats["firstImpressionAt"]),
        "last_seen": utc_day(stats["latestImpressionAt"]),
        "ad_library_url": p["adUrl"],
        "media_type": media_type_from_format(p["details"]["type"]),
        "countries": strip_country_urn(
            F.array_compact(stats["impressionsDistributionByCountry"]["country"])
        ),
        "impressions_range": F.when(both, impressions_range_text(shown["from"], shown["to"])),
        "targeting_age": facet_segments(targeting, ["Age"]),
        "targeting_gender": facet_segments(targeting, ["Gender"]),
        "targeting_locations": facet_segments(targeting, ["Location"]),
        "targeting_interests": facet_segments(targeting, ["Interest", "Industry", "Skill"]),
        "targeting_custom_audiences": facet_segments(targeting, ["Audience"]),
        "advertiser_url": who["advertiserUrl"],
        "impressions_low": shown["from"],
        "impressions_high": shown["to"],
    }


LINKEDIN = Source(
    name="linkedin",
    page="elements array<string>, paging struct<start: bigint, count: bigint, total: bigint>",
    payload=(
        "adUrl string, isRestricted boolean, restrictionDetails string, details struct<type: string, "
        "advertiser: struct<advertiserName: string, advertiserUrl: string, adPayer: string>, "
        "adStatistics: struct<firstImpressionAt: bigint, latestImpressionAt: bigint, "
        "totalImpressions: struct<`from`: bigint, `to`: bigint>, "
        "impressionsDistributionByCountry: array<struct<country: string, impressionPercentage: double>>>, "
        "adTargeting: array<struct<facetName: string, isIncluded: boolean, includedSegments: array<string>, "
        "isExcluded: boolean, excludedSegments: array<string>>>>"
    ),
    items=lambda page, operation, body: page["elements"],
    total=lambda page: page["paging"]["total"],
    next_position=lambda page: next_offset(
        page["paging"]["start"], page["paging"]["count"], page["paging"]["total"], 25
    ),
    mapping=_mapping,
)
