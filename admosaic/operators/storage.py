"""Tables written between the steps of an operator, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows up to which a stored table may be broadcast.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a folder of its own; on a cluster it is an error, as executors do not
    see each other's folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="admosaic-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(table: DataFrame, name: str) -> DataFrame:
    """The rows of a table, written once, so that later steps read them and a lost executor costs no more than a read.

    A join goes by the size of files, which says little of what their rows take in memory: millions of them may be in a few
    MB. So a table of more than `BROADCAST_ROWS` rows is marked to be joined by sorting and is never gathered by the driver.
    """
    spark = table.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    table.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(table.schema).parquet(path)
    return rows if rows.count() <= BROADCAST_ROWS else rows.hint("merge")


def few(table: DataFrame, most: int) -> bool:
    """Whether a table has at most so many rows; it reads no more than that."""
    return table.limit(most + 1).count() <= most
