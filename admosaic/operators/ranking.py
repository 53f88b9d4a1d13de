"""Ranks, row numbers and top-n that do not put a whole group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import shared_folder, stored


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, the shared one unless another is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return context.getCheckpointDir()


def number_rows(table: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Row number within each group in the given order, for groups of any size.

    The table is range-sorted by group and order and checkpointed; a row's number is its place in its
    task plus the rows its group has in earlier tasks. Only those counts, one row per task and group,
    go through a window. Rows that are equal in group and order, however many, are split by their place
    in the input; which of them comes first does not matter and is fixed by the checkpoint.
    """
    ensure_checkpoint_dir(table.sparkSession)
    place = F.monotonically_increasing_id()
    keys = [group, *order, "_copy"]
    placed = (
        table.withColumn("_copy", place)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_copy")
        .select("*", F.shiftright(place, 33).alias("_task"), place.alias("_place"))
        .checkpoint()
    )
    counts = placed.groupBy(group, "_task").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("_group"),
        F.col("_task").alias("_of"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    joined = placed.join(
        starts, (placed[group].eqNullSafe(starts["_group"])) & (placed["_task"] == starts["_of"])
    )
    number = F.col("_before") + F.col("_place") - F.col("_first") + 1
    return joined.withColumn(name, number).select(*table.columns, name)


def top_per_group(
    table: DataFrame, group: str, order: list[Column], n: Column, spread: list[str], salts: int = 32, skip: Column | None = None
) -> DataFrame:
    """Of each group the ``n`` rows that follow its first ``skip``; both are columns.

    Groups are first cut within ``salts`` parts by the hash of ``spread``, so the last window sees at most
    ``salts`` times the rows wanted of a group, whatever the group's size.
    """
    skip = F.lit(0) if skip is None else skip
    part = Window.partitionBy(group, F.pmod(F.xxhash64(*spread), F.lit(salts))).orderBy(*order)
    cut = table.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= n + skip)
    whole = Window.partitionBy(group).orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(whole))
    return ranked.filter((F.col("_rank") > skip) & (F.col("_rank") <= n + skip)).drop("_rank")


def cut_by_histogram(table: DataFrame, group: str, bin: Column, wanted: DataFrame) -> DataFrame:
    """The rows that can be among the first ``n`` of their group when highest bins come first, a NULL bin last.

    ``wanted`` has ``n`` by group. Rows are counted by group and bin, which is all that is shuffled; of each group the
    bins are kept up to the one in which its n-th row lies. The table is read twice and should be stored.
    """
    rows = table.withColumn("_bin", bin)
    counts = rows.groupBy(group, "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy(F.col("_bin").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    kept = counts.join(wanted.select(group, "n"), group).where("_before < n")
    lowest = kept.groupBy(group).agg(F.min("_bin").alias("_lowest"), F.count_if(F.col("_bin").isNull()).alias("_open"))
    joined = rows.join(stored(lowest, "lowest"), group).where((F.col("_open") > 0) | (F.col("_bin") >= F.col("_lowest")))
    return joined.select(*table.columns)


#: Rows that one task may sort to give a page.
PAGE_ROWS = 100_000


def narrowed_page(table: DataFrame, levels: list[list[tuple[Column, bool]]], first: int, size: int) -> tuple[DataFrame, int]:
    """The part of an ordered table that holds rows ``first`` to ``first + size``, and how many of its rows come before.

    ``levels`` are ever finer keys that agree with the order of the table: columns, each with whether it falls; NULL comes
    last in falling ones, else first. Rows are counted by the first key, and only the keys in which the rows wanted lie
    are kept, at most one for each; while these are too many to be sorted in one task, the next key narrows them
    further. A histogram is all that is shuffled and collected.
    """

    def place_of(key: tuple, level: list[tuple[Column, bool]]) -> tuple:
        return tuple((v is None, 0 if v is None else -v) if falls else (v is not None, v or "") for v, (_, falls) in zip(key, level, strict=True))

    for level in levels:
        names = [f"_k{k}" for k in range(len(level))]
        keyed = table.withColumns(dict(zip(names, [column for column, _ in level], strict=True)))
        counts = sorted(((tuple(r[:-1]), r[-1]) for r in keyed.groupBy(*names).count().collect()), key=lambda x: place_of(x[0], level))
        kept, before, place = [], 0, 0
        for key, n in counts:
            if place < first + size and place + n > first:
                before = before if kept else place
                kept.append((*key, n))
            place += n
        if not kept:
            return table.limit(0), 0
        there = keyed.select(*names, F.lit(0).cast("bigint").alias("_n")).schema
        wanted = F.broadcast(table.sparkSession.createDataFrame(kept, there)).toDF(*[f"_w{n}" for n in [*names, "n"]])
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_w{n}")) for n in names])
        table = keyed.join(wanted, same, "left_semi").select(*table.columns)
        first -= before
        if sum(k[-1] for k in kept) <= PAGE_ROWS + size:
            break
    return table, first
