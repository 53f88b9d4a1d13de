"""Importance resampling towards a target distribution of hashed word runs.

1. Both sides are counted by bucket: a task adds its texts up in one array and hands over its buckets once.
2. The log ratios of the buckets are an array that travels with the tasks; a document's weight is the sum of its
   buckets' entries, and keyed Gumbel noise makes the highest scores a draw without replacement.
3. A quantile sketch brackets the cutoff, exact counts outside the bracket prove or widen it, and only the bracket is
   sorted to find the last row drawn. Everything else is a filter on that row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textops import stored

#: Bytes of text worked on at once; a longer text is cut between words.
PIECE = 1 << 21
#: Words beyond so many bytes are hashed one by one.
LONG_WORD = 64
#: Size of the sketch of scores (its rank error is about 0.1 % of the rows), and in how many parts it is taken.
SKETCH, SKETCH_PARTS = 3000, 128
FIRST_MARGIN = 0.004

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array([_WORD.match(bytes([b])) is not None for b in range(256)])
_ALL = 0xFFFFFFFF


def _remainders() -> np.ndarray:
    """The table of CRC-32 (reversed polynomial) for one byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _remainders()


def _advanced(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes from starts to ends, one byte place of all words at a time."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, LONG_WORD + 1).astype(np.int8), kind="stable")
    first, sizes, out = starts[order], lengths[order], state[order]
    long = int(np.searchsorted(-sizes.clip(max=LONG_WORD + 1), -LONG_WORD, side="left"))
    for k in range(long):
        word = data[first[k] : first[k] + sizes[k]].tobytes()
        out[k] = zlib.crc32(word, int(out[k]) ^ _ALL) ^ _ALL
    sizes, first, now = sizes[long:], first[long:], out[long:]
    for place in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -place, side="left"))
        now[:n] = _TABLE[(now[:n] ^ data[first[:n] + place]) & 255] ^ (now[:n] >> 8)
    back = np.empty_like(out)
    back[order] = out
    return back


def _pieces(texts: list[bytes], most: int) -> Iterator[tuple[int, bytes, int]]:
    """(index of the text, bytes, words at the start that the piece before has counted)."""
    for k, text in enumerate(texts):
        at, carried = 0, []
        while True:
            gap = _GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = gap.start() if gap else len(text)
            yield k, b" ".join([*carried, text[at:end]]), len(carried)
            if not gap:
                break
            if most > 1:
                carried = (carried + _WORD.findall(text[at:end]))[1 - most :]
            at = end


def run_buckets(texts: list[bytes], most: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(index of the text, words, buckets of all its runs of 1 to most words), in one or more parts a text."""
    group, size = [], 0
    for piece in _pieces(texts, most):
        if group and size + len(piece[1]) > PIECE:
            yield from _hashed(group, most, buckets)
            group, size = [], 0
        group.append(piece)
        size += len(piece[1]) + 1
    if group:
        yield from _hashed(group, most, buckets)


def _hashed(group: list[tuple[int, bytes, int]], most: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray]]:
    data = np.frombuffer(b"\n".join(p[1] for p in group).translate(_LOWER), np.uint8)
    edge = np.diff(np.concatenate(([False], _IN_WORD[data], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0] + [len(p[1]) + 1 for p in group])
    first = np.searchsorted(starts, begins)
    states = [_advanced(np.full(len(starts), _ALL, np.uint32), data, starts, ends)]
    for k in range(1, most):
        state = states[-1][: max(0, len(starts) - k)]
        state = _TABLE[(state ^ np.uint32(32)) & 255] ^ (state >> 8)
        states.append(_advanced(state, data, starts[k:], ends[k:]))
    found = [((s ^ np.uint32(_ALL)) % np.uint32(buckets)).astype(np.int64) for s in states]
    for (index, _, carried), low, high in zip(group, first[:-1], first[1:], strict=True):
        runs = [f[max(low, low + carried - k) : max(low, high - k)] for k, f in enumerate(found)]
        yield index, int(high - low - carried), np.concatenate(runs)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(table: DataFrame, text_col: str = "text", most: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many word runs of all texts fall in each bucket; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found in run_buckets(_texts(batch), most, buckets):
                counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held])], ["bucket", "n"])

    own = table.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket long, n long")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for bucket, n in counts.collect():
        out[bucket] = n
    return out


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str, target_col: str, most: int, buckets: int) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket; at most ``buckets`` numbers are collected."""
    own, wanted = (_dense(bucket_counts(x, c, most, buckets), buckets) for x, c in ((docs, text_col), (target, target_col)))
    all_own, all_wanted = float(sum(own) + buckets), float(sum(wanted) + buckets)
    ratios = [((t + 1.0) * all_own) / ((s + 1.0) * all_wanted) for s, t in zip(own, wanted, strict=True)]
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratios], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, most: int) -> DataFrame:
    """(row, id, n_words, n_features, weight) of every row; weight is the sum of its runs' gains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)
            for index, n, found in run_buckets(_texts(batch), most, len(gains)):
                sums[:, index] += n, len(found), gains[found].sum()
            columns = [batch.column("row"), batch.column("id"), *[pa.array(s) for s in sums]]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "n_words", "n_features", "weight"])

    own = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"row long, id {kind}, n_words long, n_features long, weight long")


def gumbel(name: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) with u from the first 32 bits of sha256("seed:name"); a null name counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()]


def ranked(rows: DataFrame) -> DataFrame:
    """Adds rank 1, 2, 3, … by falling score, then id (null last), then place in the input.

    The rows are dealt and sorted by range; a row's rank is its place in its task plus the rows of earlier tasks, of
    which only one count a task goes through a window.
    """
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    dealt = stored(dealt.select("*", F.shiftright(place, 33).alias("task"), place.alias("place")), "drawn")
    counts = dealt.groupBy("task").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("start"))
    return dealt.join(F.broadcast(starts), "task").withColumn("rank", F.col("place") + F.col("start")).select(*rows.columns, "rank")


def last_drawn(rows: DataFrame, wanted: int, total: int):
    """The row that comes ``wanted``-th of ``total`` in the order of `ranked`, by its score, id and row.

    Sketches of parts of the scores are merged into one, whose quantiles around the place wanted are a bracket. Counts
    of all rows above and inside it tell whether it holds the place; if not, its margin is widened until it does, at
    last to all rows. Only the bracket is sorted.
    """
    part = F.pmod(F.xxhash64("row"), F.lit(SKETCH_PARTS)).alias("part")
    parts = rows.groupBy(part).agg(F.kll_sketch_agg_bigint("score", F.lit(SKETCH)).alias("sketch"))
    sketch = stored(parts.agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("sketch")), "sketch")
    place, margin = 1 - (wanted - 0.5) / total, FIRST_MARGIN
    while True:
        low, high = max(0.0, place - margin), min(1.0, place + margin)
        ends = sketch.select(
            F.kll_sketch_get_quantile_bigint("sketch", F.lit(low)), F.kll_sketch_get_quantile_bigint("sketch", F.lit(high))
        ).first()
        above = F.lit(False) if high == 1.0 else F.col("score") > ends[1]
        inside = ~above & (F.lit(True) if low == 0.0 else F.col("score") >= ends[0])
        outside, held = rows.agg(F.count_if(above), F.count_if(inside)).first()
        if outside < wanted <= outside + held:
            return ranked(rows.where(inside)).where(F.col("rank") == wanted - outside).first()
        margin *= 8


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    most: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    percent: int = 10,
    least_words: int = 20,
) -> DataFrame:
    """One row per document row: id, n_words, n_features, weight, score, rank.

    Runs of 1 to ``most`` words are counted by crc32 modulo ``buckets`` over both tables. Of the rows with at least
    ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn, the highest scores first; rank is null for
    the others. Ties go to the smaller id, a null id last, then to the earlier row; repeated rows are drawn each on its
    own. A null or empty text has no words, a weight of 0 and is not drawn unless ``least_words`` is 0. Long texts are
    cut between words. An empty table of documents gives no rows; an empty target is a target without counts. Other
    columns are not looked at.
    """
    gains = bucket_gains(docs, target, text_col, target_col, most, buckets)
    scored = weighted(docs, gains, id_col, text_col, most).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = stored(scored, "scored")
    enough = F.col("n_words") >= least_words
    total = scored.where(enough).count()
    wanted = percent * total // 100
    none = F.lit(None).cast("long").alias("rank")
    if wanted:
        last = last_drawn(scored.where(enough), wanted, total)
        same_id = F.col("id").eqNullSafe(F.lit(last["id"]))
        before = F.col("id").isNotNull() if last["id"] is None else F.coalesce(F.col("id") < F.lit(last["id"]), F.lit(False))
        tied = before | (same_id & (F.col("row") <= last["row"]))
        drawn = enough & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & tied))
        out = ranked(scored.where(drawn)).unionByName(scored.where(~drawn).select("*", none))
    else:
        out = scored.select("*", none)
    return out.drop("row").withColumnRenamed("id", id_col)
