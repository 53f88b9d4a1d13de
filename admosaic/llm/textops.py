"""Column helpers that several text operators share, and tables written between their steps."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
WHITE = " \t\n\x0b\f\r"
#: What separates words made of digits, letters in either case and every character beyond ASCII.
NON_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Spark's setting for whether a query's shuffle files go when it has ended, or stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def let(value: Column, body) -> Column:
    """body(value), with value worked out once a row however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(value: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(value, UPPER, LOWER)


def spaced_words(text: Column) -> Column:
    """Runs of characters other than space, tab, line feeds and carriage return; none for null."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE)),
    )


def plain_words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, in their own case; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NON_WORD), lambda w: w != "")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows of a frame, written once as a table in the shared folder, so that later steps read it and lost
    executors cost no more than a read. What was shuffled for it goes once it is written."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(frame.schema).parquet(path)


def sized(frame: DataFrame, most: int) -> DataFrame:
    """The frame, marked for broadcast if it has at most so many rows; beyond, the join shuffles."""
    return F.broadcast(frame) if frame.count() <= most else frame


def document_keys(text: Column, doc_id: Column) -> list[Column]:
    """Two 64-bit hashes of a row's text and id, by which results of a row find their way back to it."""
    name = doc_id.cast("string")
    return [F.xxhash64(name, text), F.xxhash64(F.lit(1), text, name)]


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of the frame has them (case aside)."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def process_cache(name: str) -> dict:
    """A dictionary that the tasks of one worker process share; losing it costs time only."""
    module = sys.modules.setdefault("corpus_process_cache", types.ModuleType("corpus_process_cache"))
    return module.__dict__.setdefault(name, {})


def drop_caches(but: str) -> None:
    """Frees what other steps have kept in this worker process, which costs them time only."""
    for name, kept in vars(sys.modules.get("corpus_process_cache", types.ModuleType("none"))).items():
        if isinstance(kept, dict) and name != but:
            kept.clear()
