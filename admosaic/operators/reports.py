"""Aggregate reports on the ad table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranges import range_high, range_low
from .search import dates_match

REPORTS = ("summary", "spending", "reach", "advertisers")


def with_bounds(ads: DataFrame) -> DataFrame:
    """Ads with spend and impression bounds, read from the range texts where a source gives only those."""
    return ads.withColumns(
        {
            "spend_low": F.coalesce("spend_low", range_low(F.col("spend_range"))),
            "spend_high": F.coalesce("spend_high", range_high(F.col("spend_range"))),
            "impressions_low": F.coalesce("impressions_low", range_low(F.col("impressions_range"))),
            "impressions_high": F.coalesce("impressions_high", range_high(F.col("impressions_range"))),
        }
    )


def _unknown(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def platform_report(
    ads: DataFrame, report_type: str = "summary", platform: str | None = None, date_from=None, date_to=None
) -> DataFrame:
    """A report of one kind: ``summary``, ``spending``, ``reach`` or ``advertisers``.

    Spending and reach come by advertiser with a subtotal per platform (NULL advertiser, ``is_total``).
    Ads whose bound is unknown are counted apart and never taken as 0.
    """
    if report_type not in REPORTS:
        raise ValueError(f"unknown report: {report_type}; known: {', '.join(REPORTS)}")
    if platform is not None:
        ads = ads.filter(F.col("platform") == platform)
    if date_from is not None or date_to is not None:
        start = F.lit(date_from).cast("date")
        end = F.lit(date_to).cast("date")
        ads = ads.filter(dates_match(F.col("first_seen"), F.col("last_seen"), start, end, "overlap"))
    return {"summary": _summary, "spending": _spending, "reach": _reach, "advertisers": _advertisers}[report_type](ads)


def _summary(ads: DataFrame) -> DataFrame:
    """Per platform; advertisers are counted from one row each, so no set is held per platform."""
    per_advertiser = ads.groupBy("platform", "advertiser_id").agg(
        F.count("*").alias("n"), F.min("first_seen").alias("first"), F.max("last_seen").alias("last")
    )
    return _by_platform(per_advertiser)


def _by_platform(per_advertiser: DataFrame) -> DataFrame:
    return per_advertiser.groupBy("platform").agg(
        F.sum("n").alias("total_ads"),
        F.count("advertiser_id").alias("advertisers"),
        F.min("first").alias("first_seen"),
        F.max("last").alias("last_seen"),
    )


def _totals(ads: DataFrame, measures: list[Column], names: list[str]) -> DataFrame:
    """Sums by advertiser and per platform. The subtotal adds up the advertisers' sums."""
    by_advertiser = ads.groupBy("platform", "advertiser_id").agg(F.count("*").alias("total_ads"), *measures)
    return _rolled(by_advertiser, names)


def _rolled(by_advertiser: DataFrame, names: list[str]) -> DataFrame:
    rolled = by_advertiser.rollup("platform", "advertiser_id").agg(
        F.grouping_id().alias("_level"),
        F.sum("total_ads").alias("total_ads"),
        *[F.sum(name).alias(name) for name in names],
    )
    return (
        rolled.filter(F.col("_level") < 3)
        .withColumn("is_total", F.col("_level") == 1)
        .drop("_level")
    )


def _spending(ads: DataFrame) -> DataFrame:
    bounded = with_bounds(ads)
    names = ["spend_low", "spend_high", "unknown_low", "unknown_high"]
    return _totals(
        bounded,
        [
            F.sum("spend_low").alias("spend_low"),
            F.sum("spend_high").alias("spend_high"),
            _unknown("spend_low").alias("unknown_low"),
            _unknown("spend_high").alias("unknown_high"),
        ],
        names,
    )


def _reach(ads: DataFrame) -> DataFrame:
    bounded = with_bounds(ads).withColumn("reach", F.col("eu_reach").try_cast("bigint"))
    names = ["impressions_low", "impressions_high", "eu_reach", "unknown_low", "unknown_high", "unknown_reach"]
    return _totals(
        bounded,
        [
            F.sum("impressions_low").alias("impressions_low"),
            F.sum("impressions_high").alias("impressions_high"),
            F.sum("reach").alias("eu_reach"),
            _unknown("impressions_low").alias("unknown_low"),
            _unknown("impressions_high").alias("unknown_high"),
            _unknown("reach").alias("unknown_reach"),
        ],
        names,
    )


def _advertisers(ads: DataFrame) -> DataFrame:
    """Ads per advertiser with a rank by their number; equal numbers share a rank.

    The rank of a number of ads is one plus the advertisers with more: it comes from the counts of
    counts, which are few, and is joined back, so the advertisers themselves are never in one window.
    """
    return _ranked(ads.groupBy("platform", "advertiser_id", "advertiser_name").agg(F.count("*").alias("total_ads")))


def _ranked(counted: DataFrame) -> DataFrame:
    sizes = counted.groupBy("platform", "total_ads").agg(F.count("*").alias("_same"))
    above = (
        Window.partitionBy("platform").orderBy(F.desc("total_ads")).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = sizes.withColumn("rank", F.coalesce(F.sum("_same").over(above), F.lit(0)) + 1).drop("_same")
    return counted.join(ranks, ["platform", "total_ads"])


# --- reports that grow with new ads only

#: Sums that partial rows keep, by report: name in the report, name in the partial rows.
_SUMS = {
    "spending": {"spend_low": "spend_low", "spend_high": "spend_high", "unknown_low": "unknown_spend_low", "unknown_high": "unknown_spend_high"},
    "reach": {
        "impressions_low": "impressions_low", "impressions_high": "impressions_high", "eu_reach": "reach",
        "unknown_low": "unknown_impressions_low", "unknown_high": "unknown_impressions_high", "unknown_reach": "unknown_reach",
    },
}
_BOUNDS = ("spend_low", "spend_high", "impressions_low", "impressions_high", "reach")
PARTIALS = (
    "platform string, advertiser_id string, advertiser_name string, n bigint, first timestamp, last timestamp, "
    + ", ".join(f"{name} bigint, unknown_{name} bigint" for name in _BOUNDS)
    + ", batch bigint"
)


def report_partials(ads: DataFrame) -> DataFrame:
    """One row per advertiser with everything that the reports add up; rows of parts of the ads merge into those of all."""
    bounded = with_bounds(ads).withColumn("reach", F.col("eu_reach").try_cast("bigint"))
    sums = [x for name in _BOUNDS for x in (F.sum(name).cast("bigint").alias(name), _unknown(name).alias(f"unknown_{name}"))]
    return bounded.groupBy("platform", "advertiser_id", "advertiser_name").agg(
        F.count("*").alias("n"), F.min("first_seen").alias("first"), F.max("last_seen").alias("last"), *sums
    )


def report_of_partials(partials: DataFrame, report_type: str = "summary") -> DataFrame:
    """The `platform_report` of all ads whose partial rows these are, however many rows an advertiser has."""
    if report_type not in REPORTS:
        raise ValueError(f"unknown report: {report_type}; known: {', '.join(REPORTS)}")
    if report_type == "advertisers":
        return _ranked(partials.groupBy("platform", "advertiser_id", "advertiser_name").agg(F.sum("n").alias("total_ads")))
    merged = partials.groupBy("platform", "advertiser_id")
    if report_type == "summary":
        return _by_platform(merged.agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")))
    sums = _SUMS[report_type]
    named = [F.sum(partial).alias(name) for name, partial in sums.items()]
    return _rolled(merged.agg(F.sum("n").alias("total_ads"), *named), list(sums))


def add_to_reports(ads: DataFrame, batch: int, path: str) -> None:
    """Write the partial rows of a batch of new ads; a batch that is written again replaces itself."""
    rows = report_partials(ads).withColumn("batch", F.lit(batch).cast("bigint"))
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def stored_report(spark: SparkSession, path: str, report_type: str = "summary") -> DataFrame:
    """The report over all batches at ``path``, from their partial rows alone."""
    rows = spark.read.schema(PARTIALS).option("recursiveFileLookup", True).parquet(path)
    return report_of_partials(rows, report_type)
