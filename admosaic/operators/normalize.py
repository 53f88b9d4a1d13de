"""Normalisation of every source to the common ad table, and conformance to its schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.countries import regions_to_countries
from ..functions.ranges import impressions_range_text, spend_range_text
from ..schema import ADS, ads_columns, empty_ads, missing, no_strings
from ..sources import PAGE_SOURCES
from ..sources.pages import unwrap_source
from .ranking import number_rows


def normalize_items(items: DataFrame, platform: str) -> DataFrame:
    """Ads of one source from its items (``item`` JSON text, optional ``fetched_at``).

    The item is parsed once into its declared payload; an unknown source gives the generic mapping.
    """
    stamp = F.col("fetched_at") if "fetched_at" in items.columns else F.lit(None).cast("timestamp")
    shared = {
        "platform": F.lit(platform),
        "extra_json": F.col("item"),
        "fetched_at": F.coalesce(stamp, F.current_timestamp()),
    }
    if platform not in PAGE_SOURCES:
        return items.select(*ads_columns({**shared, "media_type": F.lit("unknown")}))
    source = PAGE_SOURCES[platform]
    parsed = items.select("item", stamp.alias("fetched_at"), F.from_json("item", source.payload).alias("p"))
    return parsed.select(*ads_columns({**source.mapping(F.col("p")), **shared}))


def normalize_unknown(pages: DataFrame) -> DataFrame:
    """The generic mapping of every readable page of a source without a mapping, or of none, whole page as raw item."""
    mapped = F.coalesce(F.col("platform").isin(*PAGE_SOURCES), F.lit(False))
    other = pages.filter(~mapped & F.try_parse_json("body").isNotNull())
    stamp = F.coalesce(F.col("fetched_at"), F.current_timestamp())
    values = {"platform": F.col("platform"), "extra_json": F.col("body"), "media_type": F.lit("unknown"), "fetched_at": stamp}
    return other.select(*ads_columns(values))


def stamp_fetched(ads: DataFrame) -> DataFrame:
    """Retrieval time: what is there already, else now."""
    known = F.col("fetched_at") if "fetched_at" in ads.columns else F.lit(None).cast("timestamp")
    return ads.withColumn("fetched_at", F.coalesce(known, F.current_timestamp()))


def normalize_creatives(creatives: DataFrame) -> DataFrame:
    """Ads of google from its table; rows without an id keep a NULL id (see `fill_missing_ids`)."""
    c = F.col
    stamp = c("fetched_at") if "fetched_at" in creatives.columns else F.lit(None).cast("timestamp")
    fields = [name for name in creatives.columns if name != "fetched_at"]
    values = {
        "ad_id": c("ad_id"),
        "platform": F.lit("google"),
        "advertiser_id": c("advertiser_id"),
        "advertiser_name": c("advertiser_name"),
        "advertiser_type": F.lit("political"),
        "first_seen": c("date_range_start"),
        "last_seen": c("date_range_end"),
        "ad_text": c("ad_text"),
        "ad_library_url": c("ad_url"),
        "media_type": F.lit("unknown"),
        "countries": regions_to_countries(c("regions")),
        "spend_range": spend_range_text(c("spend_range_min_usd"), c("spend_range_max_usd")),
        "impressions_range": impressions_range_text(c("impressions_min"), c("impressions_max")),
        "targeting_age": c("age_targeting"),
        "targeting_gender": c("gender_targeting"),
        "targeting_locations": c("regions"),
        "extra_json": F.to_json(F.struct(*[c(f) for f in fields])),
        "fetched_at": F.coalesce(stamp, F.current_timestamp()),
        "spend_low": c("spend_range_min_usd"),
        "spend_high": c("spend_range_max_usd"),
        "impressions_low": c("impressions_min"),
        "impressions_high": c("impressions_max"),
    }
    return creatives.select(*ads_columns(values))


def fill_missing_ids(ads: DataFrame) -> DataFrame:
    """Number the ads of each platform that have no id: ``<platform>_<row number>``.

    Rows are numbered in the order of advertiser, start and URL. Only the rows without an id are
    sorted, over all tasks.
    """
    known = ads.filter(F.col("ad_id").isNotNull())
    unknown = ads.filter(F.col("ad_id").isNull())
    numbered = number_rows(
        unknown, "platform", ["advertiser_id", "first_seen", "ad_library_url"], "row_number"
    )
    named = numbered.withColumn("ad_id", F.concat_ws("_", "platform", "row_number")).select(*ads.columns)
    return known.unionByName(named)


def normalize_ads(
    pages: DataFrame | None = None,
    creatives: DataFrame | None = None,
    platforms: list[str] | None = None,
) -> DataFrame:
    """The ad table of landed pages and of the tabular source, stacked.

    Pages of sources that have no mapping of their own give one generic row each: all of them without a list of platforms,
    else those named.
    """
    parts = []
    if pages is not None:
        for platform in sorted(PAGE_SOURCES) if platforms is None else platforms:
            if platform in PAGE_SOURCES:
                parts.append(normalize_items(unwrap_source(pages, platform), platform))
            else:
                parts.append(normalize_unknown(pages.filter(F.col("platform") == platform)))
        if platforms is None:
            parts.append(normalize_unknown(pages))
    if creatives is not None and (platforms is None or "google" in platforms):
        parts.append(normalize_creatives(creatives))
    if not parts:
        frame = pages if pages is not None else creatives
        return empty_ads(frame.sparkSession)
    return union_ads(*parts)


def union_ads(*tables: DataFrame) -> DataFrame:
    """Stack ad tables; columns a table lacks are filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _conformed(table: DataFrame, field: T.StructField) -> Column:
    if field.name not in table.columns:
        return missing(field)
    column, have = F.col(field.name), table.schema[field.name].dataType
    if isinstance(field.dataType, T.ArrayType):
        if isinstance(have, T.ArrayType):
            return F.coalesce(column.cast(field.dataType), no_strings())
        one = column.cast("string")
        return F.when(one.isNull(), no_strings()).otherwise(F.array(one))
    if isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column)
    return column.try_cast(field.dataType)


def conform_ads(table: DataFrame) -> DataFrame:
    """Any ad-like table in the common schema.

    Missing columns are added, values are cast (NULL where they cannot be), scalars in list columns
    become lists of one and NULL lists become empty.
    """
    return table.select(*[_conformed(table, field).alias(field.name) for field in ADS])


def select_fields(ads: DataFrame, fields: list[str] | None) -> DataFrame:
    """Only the fields asked for; all when none are named."""
    if not fields:
        return ads
    unknown = [f for f in fields if f not in ads.columns]
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    return ads.select(*fields)


# Fields the meta source is asked for.
META_FIELDS = (
    "id", "page_id", "page_name", "ad_snapshot_url", "ad_delivery_start_time", "ad_delivery_stop_time",
    "ad_creative_bodies", "media_type", "spend", "impressions", "eu_total_reach", "beneficiary_payers",
    "target_ages", "target_gender", "target_locations", "impressions_by_country", "demographic_distribution",
    "delivery_by_region",
)


def linkedin_flat(items: DataFrame) -> DataFrame:
    """The 13-column table of linkedin items with nested impressions and targeting."""
    p = F.col("p")
    who, stats = p["details"]["advertiser"], p["details"]["adStatistics"]
    impressions = F.transform(
        stats["impressionsDistributionByCountry"],
        lambda x: F.struct(
            x["country"].alias("country"), x["impressionPercentage"].alias("impression_percentage")
        ),
    )
    targeting = F.transform(
        p["details"]["adTargeting"],
        lambda x: F.struct(
            x["facetName"].alias("facet_name"),
            x["isIncluded"].alias("is_included"),
            x["includedSegments"].alias("included_segments"),
            x["isExcluded"].alias("is_excluded"),
            x["excludedSegments"].alias("excluded_segments"),
        ),
    )
    parsed = items.select(F.from_json("item", PAGE_SOURCES["linkedin"].payload).alias("p"))
    return parsed.select(
        p["adUrl"].alias("ad_url"),
        p["isRestricted"].alias("is_restricted"),
        p["restrictionDetails"].alias("restriction_details"),
        who["advertiserName"].alias("advertiser_name"),
        who["advertiserUrl"].alias("advertiser_url"),
        who["adPayer"].alias("ad_payer"),
        p["details"]["type"].alias("ad_type"),
        F.timestamp_millis(stats["firstImpressionAt"]).alias("first_impression_at"),
        F.timestamp_millis(stats["latestImpressionAt"]).alias("latest_impression_at"),
        stats["totalImpressions"]["from"].alias("total_impressions_from"),
        stats["totalImpressions"]["to"].alias("total_impressions_to"),
        F.coalesce(
            impressions, F.array().cast("array<struct<country: string, impression_percentage: double>>")
        ).alias("impressions_by_country"),
        F.coalesce(
            targeting,
            F.array().cast(
                "array<struct<facet_name: string, is_included: boolean, included_segments: array<string>, "
                "is_excluded: boolean, excluded_segments: array<string>>>"
            ),
        ).alias("ad_targeting"),
    )


def latest_ads(ads: DataFrame) -> DataFrame:
    """One row per (platform, ad_id): the copy fetched last.

    A partial aggregate, so a much-repeated ad is reduced before the shuffle. Ads without an id are
    all kept.
    """
    keys = ["platform", "ad_id"]
    rest = [name for name in ads.columns if name not in keys]
    known = ads.filter(F.col("ad_id").isNotNull())
    newest = known.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("fetched_at", F.xxhash64(*rest))).alias("row")
    )
    kept = newest.select(*keys, "row.*").select(*ads.columns)
    return kept.unionByName(ads.filter(F.col("ad_id").isNull()))
