"""SimHash near-dedup with a hierarchical index in Gray order.

1. A document's fingerprint has a bit for each of 64 majorities over the XXH64 of its shingles. Equal fingerprints are
   one from here on, with the number of their documents and the smallest id.
2. Fingerprints are dealt, sorted and numbered by Gray rank, so neighbours differ in few bits, and cut into blocks of
   BLOCK whatever the number of tasks. A block's pattern is the bits that all its fingerprints share; shorter and
   shorter runs inside it have patterns of their own, of which only the bits beyond those above count again. Parents of
   blocks are built the same way until few are left.
3. A fingerprint goes down from the top: at each node the differences from the newly shared bits are added to those
   so far, and a node is left with all that is below it once they exceed the bound. It only looks at blocks before its
   own, as the later ones look at it; inside its own block it is compared when the block is built.

Of the links found only one for each part of a block that hangs together is kept, so dense groups stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .textops import sized, stored

SEED, BITS, APART = 42, 64, 2
#: Bytes of text cut into words at once, and hashes whose bits are counted at once.
PIECE, COUNTED = 1 << 20, 4096
#: Fingerprints in a block, and in the runs inside it that have a pattern.
BLOCK, RUNS = 1 << 16, (2048, 64)
#: Children of an inner node, and nodes that the top level may have: what every task is sent.
FAN, TOP = 256, 2048
#: Fingerprints that one task takes to one block, and pairs that it tests at once.
VISITORS, TESTED = 1 << 16, 1 << 21
BROADCAST_ROWS = 1_000_000
#: Fingerprints of so many documents are joined by broadcast, so that their documents stay where they are.
MANY = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def _word_lists(text: bytes, width: int) -> Iterator[list[bytes]]:
    """Lists of words, each starting with the width - 1 words at the end of the one before."""
    at, carried = 0, []
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        words = carried + text[at:end].translate(_LOWER).split()
        at, carried = end, words[len(words) - width + 1 :] if len(words) >= width else words
        yield words


def fingerprint(text: bytes, width: int = 3) -> int:
    """The fingerprint of a text's word shingles, repeats counted; 0 without words."""
    ones, total, words = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in _word_lists(text, width):
        runs = zip(*[words[k:] for k in range(width)], strict=False)
        hashes = np.fromiter((digest(b" ".join(run), SEED) for run in runs), np.uint64)
        total += len(hashes)
        for low in range(0, len(hashes), COUNTED):
            told = hashes[low : low + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(told, axis=1).sum(axis=0, dtype=np.int64)
    if not total:
        return digest(b" ".join(words), SEED) if words else 0
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) of every row; fp holds the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], ["id", "fp"])

    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, fp long")


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit word in the reflected Gray code, moved by 2^63 so that signed numbers sort alike."""
    for k in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, k))
    return code.bitwiseXOR(F.lit(-(2**63)))


def pattern(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of codes from one start to the next: the bits in which all agree, and their values."""
    both, either = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    masks = ~(both ^ either)
    return masks, both & masks


def _shared_pattern(masks: np.ndarray, values: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """The pattern of several patterns: bits that all have, with one value."""
    mask = np.bitwise_and.reduce(masks) & ~(np.bitwise_or.reduce(values) ^ np.bitwise_and.reduce(values | ~masks))
    return mask, values[0] & mask


class Tree:
    """The patterns of a block's codes, from long runs down to the codes themselves.

    A level holds the number of codes in a run, the bits shared in a run but not in the one above, and their values.
    """

    def __init__(self, codes: np.ndarray, above: np.uint64):
        self.levels, self.size = [], len(codes)
        outer, step = np.array([above]), None
        for size in (*RUNS, 1):
            masks, values = pattern(codes, np.arange(0, len(codes), size))
            inherited = outer[np.zeros(len(masks), np.int64) if step is None else np.arange(len(masks)) * size // step]
            self.levels.append((size, masks & ~inherited, values))
            outer, step = masks, size

    def near(self, asked: np.ndarray, so_far: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in asked, places in the block) of codes with at most ``most`` different bits.

        so_far are the differences of asked from the bits above all runs.
        """
        yield from self._down(asked, np.arange(len(asked)), np.zeros(len(asked), np.int64), so_far, 0, most)

    def _down(self, asked, who, run, so_far, level, most):
        """Takes each of asked[who] to the children of its run, with the differences so far."""
        size, masks, values = self.levels[level]
        fan = len(masks) if level == 0 else self.levels[level - 1][0] // size
        for low in range(0, len(who), max(1, TESTED // fan)):
            few = slice(low, low + max(1, TESTED // fan))
            child = run[few, None] * fan + np.arange(fan)
            there = child < len(masks)
            child = np.where(there, child, 0)
            apart = so_far[few, None] + np.bitwise_count((asked[who[few], None] ^ values[child]) & masks[child])
            one, two = np.nonzero((apart <= most) & there)
            if level + 1 == len(self.levels):
                yield who[few][one], child[one, two]
            else:
                yield from self._down(asked, who[few][one], child[one, two], apart[one, two], level + 1, most)


def block_roots(codes: np.ndarray, shared: np.uint64, most: int) -> np.ndarray:
    """For each code of a block the smallest place that hangs together with its own."""
    root = np.arange(len(codes))
    for who, place in Tree(codes, shared).near(codes, np.zeros(len(codes), np.int64), most):
        while True:
            a, b = root[who], root[place]
            apart = a != b
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (root[root] != root).any():
                root = root[root]
    return root


_BLOCK = "node long, mask long, value long, codes array<long>, roots array<long>"
_PARENT = "node long, mask long, value long, children array<long>, masks array<long>, `values` array<long>"


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _longs(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), _long(np.concatenate([np.empty(0, np.uint64), *rows])))


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict[str, np.ndarray]]:
    """Columns of ``most`` rows at a time (fewer in the last), as unsigned numbers."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for name in batch.schema.names:
            new = batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)
            held[name] = np.concatenate((held[name], new)) if name in held else new
        while len(next(iter(held.values()))) >= most:
            yield {k: v[:most] for k, v in held.items()}
            held = {k: v[most:] for k, v in held.items()}
    if held and len(next(iter(held.values()))):
        yield held


def _block_of(most: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        codes = _column(rows, "fp")
        (mask,), (value,) = pattern(codes, np.array([0]))
        roots = codes[block_roots(codes, mask, most)]
        columns = [rows.column("rank").slice(0, 1).combine_chunks(), _long([mask]), _long([value]), _longs([codes]), _longs([roots])]
        return pa.table(columns, ["node", "mask", "value", "codes", "roots"])

    return run


def _blocks(codes: DataFrame, most: int) -> DataFrame:
    """The blocks of distinct codes, cut by their number in order of Gray rank: their place in their task plus the codes of
    earlier tasks, of which only one count a task goes through a window."""
    place = F.monotonically_increasing_id()
    dealt = codes.select("fp", gray_rank(F.col("fp")).alias("rank")).repartitionByRange("rank").sortWithinPartitions("rank")
    dealt = stored(dealt.select("*", F.shiftright(place, 33).alias("task"), place.alias("place")), "sorted")
    counts = dealt.groupBy("task").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("start"))
    numbered = dealt.join(F.broadcast(starts), "task")
    cut = numbered.select("fp", "rank", F.floor((F.col("place") + F.col("start")) / BLOCK).alias("block"))
    return stored(cut.groupBy("block").applyInArrow(_block_of(most), _BLOCK), "blocks")


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _runs(batches, FAN):
        mask, value = _shared_pattern(rows["mask"], rows["value"])
        columns = [_long([rows["node"][0]]), _long([mask]), _long([value]), *[_longs([rows[c]]) for c in ("node", "mask", "value")]]
        yield pa.RecordBatch.from_arrays(columns, ["node", "mask", "value", "children", "masks", "values"])


def _descend(asked: dict[str, np.ndarray], nodes: np.ndarray, masks: np.ndarray, values: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, home, root, fp, apart) of the fingerprints that go on to each node, which starts before their home."""
    at_once = max(1, TESTED // max(1, len(nodes)))
    for low in range(0, len(asked["fp"]), at_once):
        part = {k: v[low : low + at_once] for k, v in asked.items()}
        apart = part["apart"][:, None] + np.bitwise_count((part["fp"][:, None] ^ values) & masks)
        who, node = np.nonzero((apart <= most) & (nodes.view(np.int64) < part["home"].view(np.int64)[:, None]))
        columns = [_long(nodes[node]), _long(part["home"][who]), _long(part["root"][who]), _long(part["fp"][who]), pa.array(apart[who, node].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "home", "root", "fp", "apart"])


_VISIT = "node long, home long, root long, fp long, apart long"


def _from_top(nodes: np.ndarray, masks: np.ndarray, values: np.ndarray, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes, roots = (np.asarray(batch.column(c)[k].values).view(np.uint64) for c in ("codes", "roots"))
                home = np.full(len(codes), batch.column("node")[k].as_py(), np.int64).view(np.uint64)
                asked = {"fp": codes, "root": roots, "home": home, "apart": np.zeros(len(codes), np.int64)}
                yield from _descend(asked, nodes, masks, values, most)

    return run


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().view(np.uint64)


def _to_children(most: int):
    def run(key, asked: pa.Table, parent: pa.Table) -> pa.Table:
        names = ["node", "home", "root", "fp", "apart"]
        found: list[pa.RecordBatch] = []
        if asked.num_rows and parent.num_rows:
            row = parent.slice(0, 1)
            above = _column(row, "mask")[0]
            children, masks, values = (np.asarray(row.column(c)[0].values).view(np.uint64) for c in ("children", "masks", "values"))
            rows = {c: _column(asked, c) for c in ("fp", "root", "home")} | {"apart": asked.column("apart").to_numpy()}
            found = list(_descend(rows, children, masks & ~above, values, most))
        return pa.Table.from_batches(found, pa.schema([(c, pa.int64()) for c in names]))

    return run


def _to_links(most: int):
    def run(key, asked: pa.Table, block: pa.Table) -> pa.Table:
        links = np.empty((0, 2), np.uint64)
        if asked.num_rows and block.num_rows:
            codes, roots = (np.asarray(block.column(c)[0].values).view(np.uint64) for c in ("codes", "roots"))
            mine, tree = _column(asked, "root"), Tree(codes, _column(block, "mask")[0])
            for who, place in tree.near(_column(asked, "fp"), asked.column("apart").to_numpy(), most):
                links = np.unique(np.concatenate((links, np.column_stack((mine[who], roots[place])))), axis=0)
        return pa.table({"a": _long(links[:, 0]), "b": _long(links[:, 1])})

    return run


def _met(visits: DataFrame, nodes: DataFrame, run, schema: str) -> DataFrame:
    """run(key, fingerprints at a node, the node) of every node with visitors; at most about VISITORS of them at once."""
    counts = stored(visits.groupBy("node").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("parts")), "visitors")
    counts = sized(counts, BROADCAST_ROWS)
    asked = visits.join(counts, "node").select(*visits.columns, F.pmod(F.xxhash64("fp"), "parts").cast("int").alias("part"))
    opened = nodes.toDF(*[f"node_{c}" for c in nodes.columns]).join(counts.toDF("of", "pieces"), F.col("node_node") == F.col("of"))
    at = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("at")
    opened = opened.select("of", at, *[F.col(f"node_{c}").alias(c) for c in nodes.columns if c != "node"])
    return asked.groupBy("node", "part").cogroup(opened.groupBy("of", "at")).applyInArrow(run, schema)


def near_links(codes: DataFrame, most: int = APART) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) whose components are those of all pairs with at most
    ``most`` different bits."""
    blocks = _blocks(codes, most)
    inner = blocks.select(F.explode(F.arrays_zip("codes", "roots")).alias("x")).select(F.col("x.codes").alias("a"), F.col("x.roots").alias("b"))
    links = inner.where("a <> b")
    levels, tops = [], blocks.select("node", "mask", "value")
    while tops.count() > TOP:
        # At least FAN nodes a task, or levels of many tasks would not get smaller.
        parts = max(1, tops.count() // (4 * FAN))
        dealt = tops.repartitionByRange(parts, "node").sortWithinPartitions("node")
        levels.append(stored(dealt.mapInArrow(_parents, _PARENT), "parents"))
        tops = levels[-1].select("node", "mask", "value")
    top = sorted(tops.collect())
    if len(top) < 2 and not levels:
        return links
    nodes, masks, values = (np.array([r[k] for r in top], np.int64).view(np.uint64) for k in range(3))
    visits = stored(blocks.mapInArrow(_from_top(nodes, masks, values, most), _VISIT), "visits")
    for level in reversed(levels):
        visits = stored(_met(visits, level, _to_children(most), _VISIT), "visits")
    return links.unionByName(_met(visits, blocks.select("node", "mask", "codes", "roots"), _to_links(most), "a long, b long"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = APART) -> DataFrame:
    """One row per document row: id, fp (64 bits as a long), component_id.

    Fingerprints are linked at ``most`` or fewer different bits; component_id is the smallest id of the documents
    reachable by links, nulls left aside (null if all are null). Texts of fewer words than ``width`` count as one
    shingle; null, empty and blank texts have the fingerprint 0, which is linked like any other. A bit is set if more
    than half of the hashes have it, so ties give 0. Repeated rows and equal fingerprints are linked. Long texts are read
    in pieces. An empty table gives no rows. Other columns are not looked at.
    """
    told = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    codes = stored(told.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("rows")), "codes")
    roots = components(near_links(codes.select("fp"), most)).select(F.col("node").alias("fp"), "root")
    rooted = stored(codes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stored(rooted.join(sized(stored(named, "named"), BROADCAST_ROWS), "root").select("fp", "rows", "component_id"), "known")
    many = sized(known.where(F.col("rows") >= MANY).select("fp", "component_id"), BROADCAST_ROWS)
    few = known.where(F.col("rows") < MANY).select("fp", "component_id")
    hot = told.join(many, "fp")
    rest = told.join(many, "fp", "left_anti").join(few, "fp")
    return hot.unionByName(rest).select(F.col("id").alias(id_col), "fp", "component_id")
