"""Advertisers from landed pages of the ``advertisers`` operation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.pages import unwrap_source

# Payload fields read from advertiser items, by source.
PAYLOADS = {
    "apple": "id string, name string, type string, countryCode string",
    "linkedin": "urn string, name string, url string",
    "microsoft": "AdvertiserId string, AdvertiserName string, VerifiedAdvertiserId string",
    "tiktok": "advertiser_id string, advertiser_name string, verified boolean, industry string",
}


def advertiser_items(pages: DataFrame, platform: str) -> DataFrame:
    """Advertisers of one source in its own columns."""
    if platform not in PAYLOADS:
        raise ValueError(f"no advertiser pages for {platform}")
    a = F.col("a")
    columns = {
        "apple": lambda: [
            a["id"].alias("entity_id"),
            a["name"].alias("entity_name"),
            a["type"].alias("entity_type"),
            a["countryCode"].alias("country_code"),
        ],
        "linkedin": lambda: [
            a["urn"].alias("advertiser_id"),
            a["name"].alias("advertiser_name"),
            a["url"].alias("advertiser_url"),
        ],
        "microsoft": lambda: [
            a["AdvertiserId"].alias("advertiser_id"),
            a["AdvertiserName"].alias("advertiser_name"),
            a["VerifiedAdvertiserId"].alias("verified_advertiser_id"),
        ],
        "tiktok": lambda: [
            a["advertiser_id"].alias("advertiser_id"),
            a["advertiser_name"].alias("advertiser_name"),
            F.coalesce(a["verified"], F.lit(False)).alias("verified"),
            a["industry"].alias("industry"),
        ],
    }[platform]()
    items = unwrap_source(pages.filter(F.col("operation") == "advertisers"), platform)
    parsed = items.select(F.from_json("item", PAYLOADS[platform]).alias("a"))
    return parsed.select(*columns, F.lit(platform).alias("platform"))


def advertiser_pages(pages: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Advertisers of several sources in one table: id, name and what else each source tells."""
    parts = []
    for platform in sorted(PAYLOADS) if platforms is None else platforms:
        part = advertiser_items(pages, platform)
        if platform == "apple":
            part = part.withColumnsRenamed({"entity_id": "advertiser_id", "entity_name": "advertiser_name"})
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
