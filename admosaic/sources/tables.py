"""The tabular source and the sink of the ad table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapse_list
from ..schema import LIST_FIELDS

CREATIVES = (
    "ad_id string, ad_url string, ad_text string, advertiser_id string, advertiser_name string, "
    "date_range_start date, date_range_end date, regions array<string>, age_targeting array<string>, "
    "gender_targeting array<string>, spend_range_min_usd bigint, spend_range_max_usd bigint, "
    "impressions_min bigint, impressions_max bigint"
)
CREATIVE_COLUMNS = [part.split()[0] for part in CREATIVES.split(", ")]


def read_creatives(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The 14 columns of the political-ads table of google that the mapping needs."""
    return spark.read.format(fmt).load(path).select(*CREATIVE_COLUMNS)


def flatten_lists(ads: DataFrame, max_items: int | None = None) -> DataFrame:
    """List columns as joined text, for formats without lists; all items unless ``max_items`` is given."""
    lists = [name for name in LIST_FIELDS if name in ads.columns]
    return ads.withColumns({name: collapse_list(F.col(name), max_items=max_items) for name in lists})


def write_ads(
    ads: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", files_per_platform: int | None = None
) -> None:
    """Store an ad table by platform.

    ``files_per_platform`` spreads each platform over that many tasks, so that a platform holding most
    of the ads is not written by one of them; without it every task writes what it has. CSV takes the
    joined form of lists.
    """
    if fmt == "csv":
        ads = flatten_lists(ads)
    if files_per_platform is not None:
        own = F.when(F.col("ad_id").isNull(), F.xxhash64(*ads.columns)).otherwise(F.xxhash64("ad_id"))
        spread = F.pmod(own, F.lit(files_per_platform))
        ads = ads.repartition("platform", spread)
    writer = ads.write.mode(mode).partitionBy("platform")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path))


def save_ads_by_id(ads: DataFrame, name: str, buckets: int = 200, path: str | None = None) -> None:
    """Save an ad table in the catalog, at ``path`` or else in the warehouse, in buckets of ``ad_id``, with Bloom filters on
    ids.

    Lists of ids then join without moving the ads, and a search for single ids skips the row groups that lack them.
    """
    writer = ads.write.mode("overwrite").format("parquet").bucketBy(buckets, "ad_id").sortBy("ad_id")
    for column in ("ad_id", "advertiser_id"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
