"""Quota accounting on a stream of fetches, by partial counts that add up.

Each batch writes the counts of its own fetches by window, the newest time it has seen, and the fetches that came late,
all to folders of the batch, which a repeated batch writes over. Nothing is kept in the stream's state and nothing is
rewritten; a late fetch still adds to its window. Reading adds the counts up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.fetchlog import FETCH_LOG, against_limits, quota_counts
from ..operators.storage import stored

_COUNTS = "platform string, period string, start bigint, requests bigint, batch bigint"
_SEEN = "newest timestamp, batch bigint"


def _batches(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """What all batches have written of a kind; each row names its batch."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{kind}/start")
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/{kind}")


def _write(rows: DataFrame, path: str, kind: str, batch: int) -> None:
    rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{path}/{kind}/batch={batch}")


def add_batch(fetches: DataFrame, batch: int, path: str, periods: list[str] | None, sliding: bool, late: str) -> None:
    """Count a batch of fetches and set aside those that are older than the newest of earlier batches by more than ``late``."""
    spark = fetches.sparkSession
    fetches = stored(fetches, "fetches")
    newest = _batches(spark, path, "seen", _SEEN).where(F.col("batch") < batch).agg(F.max("newest")).first()[0]
    behind = F.lit(False) if newest is None else F.col("ts") < F.lit(newest) - F.expr(f"INTERVAL {late}")
    _write(fetches.where(behind), path, "late", batch)
    _write(quota_counts(fetches, periods, sliding), path, "counts", batch)
    _write(fetches.agg(F.max("ts").alias("newest")), path, "seen", batch)


def ingest_quota_stream(
    fetch_log: DataFrame,
    path: str,
    checkpoint: str,
    periods: list[str] | None = None,
    sliding: bool = True,
    late: str = "10 MINUTES",
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the quota counts at ``path`` up to date with a stream of fetches."""
    writer = fetch_log.writeStream.foreachBatch(lambda rows, batch: add_batch(rows, batch, path, periods, sliding, late))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_quota(spark: SparkSession, path: str) -> DataFrame:
    """The windows of all batches so far against the platforms' limits."""
    counts = _batches(spark, path, "counts", _COUNTS).groupBy("platform", "period", "start").agg(F.sum("requests").alias("requests"))
    return against_limits(counts)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Fetches that came late, with their batch; they are counted all the same."""
    return _batches(spark, path, "late", FETCH_LOG + ", batch bigint")
