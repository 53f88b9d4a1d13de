"""Counts and breakdowns of ads, targeting and impressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import strings


def ads_by_platform(ads: DataFrame) -> DataFrame:
    """Number of ads by platform, most first."""
    return ads.groupBy("platform").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "platform")


def total_ads(ads: DataFrame) -> DataFrame:
    """Number of ads."""
    return ads.agg(F.count("*").alias("total_ads"))


def advertiser_samples(ads: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` advertiser names of the ads in id order, missing names left out."""
    named = ads.filter(F.col("advertiser_name").isNotNull())
    return named.select("ad_id", "advertiser_name").orderBy("ad_id", "advertiser_name").limit(n)


def unnest_targeting(flat: DataFrame, *keep: str, outer: bool = False) -> DataFrame:
    """One row per targeting facet of the flat table, next to the columns to keep.

    With ``outer`` an ad without targeting keeps one row. Nothing is joined back, so nothing is shuffled.
    """
    return flat.select(*keep, (F.inline_outer if outer else F.inline)("ad_targeting"))


def unnest_impressions(flat: DataFrame, *keep: str, outer: bool = False) -> DataFrame:
    """One row per country of the flat table, next to the columns to keep; ``outer`` as in targeting."""
    return flat.select(*keep, (F.inline_outer if outer else F.inline)("impressions_by_country"))


def targeting_facets(flat: DataFrame, top: int | None = 5) -> DataFrame:
    """How often each targeting facet is used, most first."""
    counted = (
        unnest_targeting(flat)
        .filter(F.col("facet_name").isNotNull())
        .groupBy("facet_name")
        .agg(F.count("*").alias("n"))
    )
    return counted if top is None else counted.orderBy(F.desc("n"), "facet_name").limit(top)


def _by_country(rows: DataFrame) -> DataFrame:
    share = F.col("total_impressions_to") * (F.col("impression_percentage") / 100)
    return rows.groupBy("country").agg(
        F.count("*").alias("total_ads"), F.coalesce(F.sum(share), F.lit(0.0)).alias("sum_impressions")
    )


def _impression_rows(flat: DataFrame) -> DataFrame:
    return unnest_impressions(flat, "total_impressions_to").filter(F.col("country").isNotNull())


def country_impressions(flat: DataFrame, top: int | None = 5) -> DataFrame:
    """Ads and impressions by country (upper bound times the country's share), most impressions first."""
    grouped = _by_country(_impression_rows(flat))
    return grouped if top is None else grouped.orderBy(F.desc("sum_impressions"), "country").limit(top)


def in_top_countries(rows: DataFrame, top_countries: DataFrame) -> DataFrame:
    """The rows whose country is among the top countries."""
    return rows.join(top_countries.select("country"), "country", "left_semi")


def country_impressions_top(flat: DataFrame, top: int = 5) -> DataFrame:
    """Ads and impressions of the top countries only, by country name.

    The same result as keeping the rows of the top countries and aggregating again: the groups are
    those of `country_impressions`, so the table is read once.
    """
    return country_impressions(flat, top).orderBy("country")


def targeting_breakdown(ads: DataFrame, field: str) -> DataFrame:
    """Ads by value of a list column such as ``targeting_age``, most first."""
    exploded = ads.select("platform", F.explode(field).alias("value"))
    counted = exploded.groupBy("platform", "value").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "platform", "value")


def delivery_breakdown(ads: DataFrame, kind: str = "demographic_distribution") -> DataFrame:
    """Sum of the shares that meta reports by age and gender, or by region, in the kept raw item.

    ``kind`` is ``demographic_distribution`` or ``delivery_by_region``.
    """
    fields = {"demographic_distribution": ["age", "gender"], "delivery_by_region": ["region"]}[kind]
    item = "array<struct<age: string, gender: string, region: string, percentage: string>>"
    listed = F.from_json(F.get_json_object("extra_json", f"$.{kind}"), item)
    rows = ads.filter(F.col("platform") == "meta").select(F.inline(listed))
    return rows.groupBy(*fields).agg(
        F.count("*").alias("n"), F.sum(F.col("percentage").try_cast("decimal(20,10)")).alias("sum_percentage")
    )


_CODE = "^[A-Z]{2}$"


def _shares(chosen: Column) -> Column:
    """Sum of the shares of the entries chosen, NULL when there are none."""
    return F.when(
        F.size(chosen) > 0, F.aggregate(chosen, F.lit(0.0), lambda a, x: a + F.coalesce(x["impression_percentage"], F.lit(0.0)))
    )


def _share(country: str) -> Column:
    return _shares(F.filter("impressions_by_country", lambda x: x["country"] == country))


def _other_share(countries: list[str]) -> Column:
    known = strings(countries)
    return _shares(F.filter("impressions_by_country", lambda x: ~F.array_contains(known, F.coalesce(x["country"], F.lit("")))))


def impression_countries(flat: DataFrame) -> list[str]:
    """Two-letter codes that occur in the impressions, sorted: a list bounded by the alphabet."""
    code = F.upper(F.regexp_replace("country", "^urn:li:country:", ""))
    codes = unnest_impressions(flat).select(code.alias("code")).filter(F.col("code").rlike(_CODE))
    return sorted(row.code for row in codes.distinct().collect())


def _plain_countries(flat: DataFrame) -> DataFrame:
    return flat.withColumn(
        "impressions_by_country",
        F.transform(
            "impressions_by_country",
            lambda x: F.struct(
                F.upper(F.regexp_replace(x["country"], "^urn:li:country:", "")).alias("country"),
                x["impression_percentage"].alias("impression_percentage"),
            ),
        ),
    )


def clean_wide(flat: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """The flat table without list columns: one row per ad.

    Adds ``impression_pct_<CC>`` for each country (the sum where an ad names it more than once),
    ``impression_pct_other`` for all else, the midpoint ``impressions_mid`` and the summary ``targeting_facets``. Each row is built from its own lists, so nothing is shuffled.
    """
    codes = impression_countries(flat) if countries is None else [c.upper() for c in countries]
    plain = _plain_countries(flat)
    facets = F.array_sort(F.array_distinct(F.array_compact(F.col("ad_targeting.facet_name"))))
    kept = [c for c in flat.columns if c not in ("impressions_by_country", "ad_targeting")]
    return plain.select(
        *kept,
        ((F.col("total_impressions_from") + F.col("total_impressions_to")) / 2).alias("impressions_mid"),
        F.nullif(F.array_join(facets, ", "), F.lit("")).alias("targeting_facets"),
        *[_share(code).alias(f"impression_pct_{code}") for code in codes],
        _other_share(codes).alias("impression_pct_other"),
    )


def clean_long(flat: DataFrame, *keep: str) -> DataFrame:
    """Targeting and impressions stacked, one row per entry, told apart by ``data_type``.

    Both kinds are built in one list per ad, so the table is read once. Ads with neither give no row.
    """
    keep = keep or ("ad_url", "advertiser_name", "ad_type")

    def entry(kind: str, name: Column, value: Column, included: Column, percentage: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("data_type"),
            name.alias("name"),
            value.alias("value"),
            included.alias("is_included"),
            percentage.alias("impression_percentage"),
        )

    none_bool, none_double = F.lit(None).cast("boolean"), F.lit(None).cast("double")
    targeting = F.transform(
        "ad_targeting",
        lambda t: entry(
            "targeting", t["facet_name"], F.array_join(t["included_segments"], ", "), t["is_included"], none_double
        ),
    )
    impressions = F.transform(
        "impressions_by_country",
        lambda i: entry(
            "impressions", i["country"], F.lit(None).cast("string"), none_bool, i["impression_percentage"]
        ),
    )
    return flat.select(*keep, F.inline(F.concat(targeting, impressions)))
