"""Exact Jaccard join of documents on word shingles, with a token-group matrix.

1. Signatures. A set's hash range is cut into more parts than two linked sets of its size can differ in, so linked
   sets agree on whole parts. Of the sets that agree on a part, those are joined whose part bytes differ in no more
   parts than linked sets can; what hangs together is a cluster. Linked sets are always in one cluster, and most
   documents are in none.
2. Groups. Each cluster is sorted by its smallest hashes, which brings similar sets together, and cut into groups of
   at most GROUP sets. A group is opened in one task; clusters of one group, nearly all, are finished there.
3. Larger clusters are cut and opened again in other orders, then the sets outside a cluster's largest component
   query its other groups. In the last order the task that holds a group writes its token union and the parts of its
   sets, each once a group: the matrix. Groups that share no part with a query hold no linked set; for the others the
   query's tokens are counted in the union, and only groups where enough are found are opened.

Equal sets are one node throughout. Only links that join something are kept, so a group of copies costs one link
per copy, and no pair between different sets is lost for their components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shingles import mix, shingle_sets
from .textops import drop_caches, free_names, process_cache, sized, stored

GROUP = 512
#: Token places that a group holds at most, unless one set alone has more.
GROUP_TOKENS = 1 << 22
QUERIES_A_TASK = 1024
#: Sets that agree on a part are compared if they are at most so many; more are joined without, which loses nothing.
MEETING = 1024
FEW = 16
#: A set's signatures are dealt to lists by so many first bits, and one list is counted and joined after the other.
SLICE_BITS = 2
#: Rows of a few numbers each that a join may broadcast (some 40 MB), and signatures of one list with their two numbers.
BROADCAST_ROWS = 1_000_000
BROADCAST_SIGNATURES = 1_000_000
ORDERS = 3
_COLUMNS = 4096


class Threshold:
    """100 * intersection >= percent * union, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def most_apart(self, a: int, b: int) -> int:
        """The largest symmetric difference of linked sets of sizes a and b."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def least_shared(self, a: int) -> int:
        """The smallest intersection of a set of size a with a linked set."""
        return -(-self.percent * a // 100)

    def linked(self, shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (a + b - shared)

    def classes(self, n: int) -> list[tuple[int, int]]:
        """(lowest, highest) of the size classes that a set of n takes part in: its own, and the next one if a linked
        set can be there. Sets too small to differ at all from a linked set have none."""
        low = next(k for k in range(1, 1000) if self.most_apart(k, k + 1))
        while True:
            high = max(low, int(low * 1.4) - 1, 100 * low // self.percent)
            if n <= high:
                break
            low = high + 1
        out = [(low, high)] if n >= low else []
        above = high + 1 if n >= low else low
        if 100 * n >= self.percent * above:
            out.append((above, max(above, int(above * 1.4) - 1, 100 * above // self.percent)))
        return out


def part_count(percent: int, low: int, high: int) -> tuple[int, int]:
    """Parts for sets of low to high tokens, and how many of them may be empty without being signatures.

    Linked sets agree on spare + 1 parts at least, and spare is chosen so that few sets have more empty ones.
    """
    kept = process_cache("part-counts")
    if (percent, low, high) in kept:
        return kept[percent, low, high]
    apart = Threshold(percent).most_apart(high, high)
    for spare in range(1, 3 + apart // 3):
        parts = apart + 1 + spare
        empty = parts * np.exp(-low / parts)
        if spare >= empty + 4 * np.sqrt(empty) + 0.5:
            break
    kept[percent, low, high] = parts, spare
    return parts, spare


def signatures(hashes: np.ndarray, threshold: Threshold) -> list[tuple[int, np.ndarray, bytes, np.ndarray]]:
    """For each size class its lowest size, a 64-bit signature for each part, a byte for each part, and the signatures
    that a query has to ask for: as linked sets differ in few parts, one more of its fullest parts than that will do.

    Linked sets agree on more parts than are spared. A set with no more empty parts than that leaves them out, as one
    of the agreeing parts is not empty then; a set with more keeps them.
    """
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes, 7), dtype=np.uint64)))
    out = []
    for low, high in threshold.classes(len(hashes)):
        parts, spare = part_count(threshold.percent, low, high)
        bounds = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
        cuts = np.concatenate(([0], np.searchsorted(hashes, bounds), [len(hashes)]))
        sig = mix(sums[cuts[1:]] - sums[cuts[:-1]] + mix(np.arange(parts, dtype=np.uint64), low), 11)
        sizes = np.diff(cuts)
        few = np.count_nonzero(sizes == 0) <= spare
        kept = sig[sizes > 0] if few else sig
        asked = sig[np.argsort(-sizes, kind="stable")[: parts - spare]] if few else sig
        out.append((low, kept, (sig >> np.uint64(56)).astype(np.uint8).tobytes(), asked))
    return out


def all_signatures(hashes: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """A set's signatures of all size classes, and those it asks for as a query."""
    found, none = signatures(hashes, threshold), np.empty(0, np.uint64)
    return np.concatenate([none, *[x[1] for x in found]]), np.concatenate([none, *[x[3] for x in found]])


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _sets_of(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches("part-counts")
        threshold = Threshold(percent)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = list(shingle_sets(_texts(part), width))
                schemes = [signatures(s, threshold) for s in sets]
                ids = np.array([(mix(s, 3).sum(dtype=np.uint64), mix(s, 5).sum(dtype=np.uint64)) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in ("row", "id", "t1", "t2")],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids[:, 0].view(np.int64)),
                        pa.array(ids[:, 1].view(np.int64)),
                        *[column for k in range(2) for column in _scheme([x[k] if len(x) > k else None for x in schemes])],
                    ],
                    ["row", "id", "t1", "t2", "n", "s1", "s2", *[f"{c}{k}" for k in range(2) for c in ("size", "bytes", *_SLICES)]],
                )

    return run


_SLICES = [f"sigs{j}_" for j in range(1 << SLICE_BITS)]


def _scheme(column: list) -> list[pa.Array]:
    none = np.empty(0, np.uint64)
    sigs = [none if x is None else x[1] for x in column]
    return [
        pa.array([x and x[0] for x in column], pa.int64()),
        pa.array([x and x[2] for x in column], pa.binary()),
        *[_lists([s[s >> np.uint64(64 - SLICE_BITS) == j] for s in sigs]) for j in range(len(_SLICES))],
    ]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _close_sets(percent: int):
    """Rows (sig, s1, n, bytes) sorted by signature in; links of sets that agree on a signature and whose bytes differ
    in few enough parts out. Groups of at most FEW sets are compared pair by pair, all of a batch at once; a larger
    one gives a link from each set to the smallest it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches("part-counts")
        apart = 100 - percent

        def close(table: pa.Table) -> pa.RecordBatch:
            sig, nodes, sizes = (table.column(c).to_numpy() for c in ("sig", "s1", "n"))
            told = table.column("bytes").combine_chunks()
            told = told.chunk(0) if isinstance(told, pa.ChunkedArray) else told
            starts = np.frombuffer(told.buffers()[1], np.int32)[told.offset : told.offset + len(told) + 1].astype(np.int64)
            data, lengths = np.frombuffer(told.buffers()[2] or b"", np.uint8), np.diff(starts)
            first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(sig))))
            many = np.bincount(group) > FEW
            links = [np.empty((0, 2), np.int64)]

            def most(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                return (a + b) * apart // (200 - apart)

            for step in range(1, FEW):
                left = np.flatnonzero((group[:-step] == group[step:]) & ~many[group[step:]]) if step < len(group) else []
                for length in np.unique(lengths[left]) if len(left) else []:
                    a = left[lengths[left] == length]
                    at = np.arange(length)
                    differ = data[starts[a][:, None] + at] != data[starts[a + step][:, None] + at]
                    a = a[differ.sum(axis=1) <= most(sizes[a], sizes[a + step])]
                    links.append(np.column_stack((nodes[a], nodes[a + step])))
            for g in np.flatnonzero(many):
                rows = np.flatnonzero(group == g)
                matrix = data[starts[rows][:, None] + np.arange(lengths[rows[0]])]
                differ = np.zeros((len(rows), len(rows)), np.int32)
                for part in matrix.T:
                    differ += part[:, None] != part[None, :]
                roots = _roots(nodes[rows], differ <= most(sizes[rows][:, None], sizes[rows][None, :]))
                links.append(np.column_stack((nodes[rows], roots)))
            found = np.concatenate(links)
            found = np.unique(np.sort(found[found[:, 0] != found[:, 1]], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 1]), pa.array(found[:, 0])], ["a", "b"])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            sig = table.column("sig").to_numpy()
            last = int(np.searchsorted(sig, sig[-1])) if len(sig) else 0
            if last:
                yield close(table.slice(0, last).combine_chunks())
            rest = table.slice(last)
        if rest is not None and rest.num_rows:
            yield close(rest.combine_chunks())

    return run


def _meeting(sets: DataFrame, name: str) -> DataFrame:
    """Signatures of one list that several sets have, with each of these, the smallest and the number of rows. What is
    one set's own size class is another's next one, so both are counted together."""
    schemes = F.array(*[F.struct(F.col(f"size{k}").alias("size"), F.col(f"{name}{k}").alias("sigs")) for k in range(2)])
    parts = sets.select("s1", F.explode(schemes).alias("x")).select("s1", "x.size", F.explode("x.sigs").alias("sig"))
    met = parts.groupBy("sig").agg(F.min("s1").alias("least"), F.max("s1").alias("most"), F.count("*").alias("sets"))
    met = stored(met.where("least < most").select("sig", "least", "sets"), "met")
    return stored(parts.join(sized(met, BROADCAST_SIGNATURES), "sig").distinct(), "meeting")


def _tokens_of(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches("part-counts")
        threshold = Threshold(percent)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = list(shingle_sets(_texts(part), width))
                signed = [all_signatures(x, threshold) for x in sets]
                keys = [pa.array([int(mix(s, 100 + k).min().view(np.int64)) for s in sets], pa.int64()) for k in range(ORDERS)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("cluster"), part.column("node"), _lists(sets), *[_lists([x[k] for x in signed]) for k in range(2)], *keys],
                    ["cluster", "node", "tokens", "parts", "asks", *[f"key{k}" for k in range(ORDERS)]],
                )

    return run


def _tokens(column: pa.ListArray) -> list[np.ndarray]:
    return [np.asarray(x.values).view(np.uint64) for x in column]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each of left shares with each of right, by products of blocks of a 0/1 matrix."""
    one, two = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(one, two)
    out = np.zeros((len(left), len(right)), np.int64)
    place = [
        (np.repeat(np.arange(len(sets)), [len(s) for s in sets])[keep], np.searchsorted(common, flat[keep]))
        for sets, flat in ((left, one), (right, two))
        for keep in [np.isin(flat, common)]
    ]
    for low in range(0, len(common), _COLUMNS):
        blocks = []
        for (rows, columns), sets in zip(place, (left, right), strict=True):
            inside = (columns >= low) & (columns < low + _COLUMNS)
            block = np.zeros((len(sets), min(_COLUMNS, len(common) - low)), np.float32)
            block[rows[inside], columns[inside] - low] = 1
            blocks.append(block)
        out += (blocks[0] @ blocks[1].T).astype(np.int64)
    return out


def _roots(nodes: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest node each node of a small group reaches."""
    root = nodes.copy()
    while True:
        new = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == root).all():
            return root
        root = new


def _open_groups(percent: int, last: bool):
    """Sorted sets in, the same rows with a group number and the smallest node reached inside the group out.

    In the last order the first row of each group carries the group's distinct parts and the union of its tokens, and
    the sets' own parts are left out, as nothing reads them any more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        threshold, waiting, held = Threshold(percent), [], 0

        def opened(rows: list) -> pa.RecordBatch:
            nodes = np.array([r[1] for r in rows])
            sets = [r[2] for r in rows]
            sizes = np.array([len(s) for s in sets])
            linked = threshold.linked(shared_counts(sets, sets), sizes[:, None], sizes[None, :])
            np.fill_diagonal(linked, True)
            rest = [None] * (len(rows) - 1)
            whole = [[np.unique(np.concatenate([r[k] for r in rows])).view(np.int64), *rest] if last else [None, *rest] for k in (3, 2)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[0][0]] * len(rows), pa.int64()),
                    pa.array([int(nodes[0])] * len(rows), pa.int64()),
                    pa.array(nodes),
                    _lists(sets),
                    pa.nulls(len(rows), pa.list_(pa.int64())) if last else _lists([r[3] for r in rows]),
                    _lists([r[4] for r in rows]),
                    *[pa.array(x, pa.list_(pa.int64())) for x in whole],
                    pa.array(_roots(nodes, linked)),
                    *[pa.array([r[5][k] for r in rows], pa.int64()) for k in range(ORDERS)],
                ],
                _GROUPED_NAMES,
            )

        for batch in batches:
            ids = [batch.column(c).to_pylist() for c in ("cluster", "node")]
            lists = [_tokens(batch.column(c)) for c in ("tokens", "parts", "asks")]
            keys = zip(*[batch.column(f"key{k}").to_pylist() for k in range(ORDERS)], strict=True)
            for row in zip(*ids, *lists, keys, strict=True):
                if waiting and row[1] == waiting[-1][1]:
                    continue
                held += len(row[2])
                if waiting and (row[0] != waiting[0][0] or len(waiting) == GROUP or held > GROUP_TOKENS):
                    yield opened(waiting)
                    waiting, held = [], len(row[2])
                waiting.append(row)
        if waiting:
            yield opened(waiting)

    return run


_LISTS = ("tokens", "parts", "asks", "group_parts", "group_tokens")
_GROUPED_NAMES = ["cluster", "group", "node", *_LISTS, "root", *[f"key{k}" for k in range(ORDERS)]]
_GROUPED = ", ".join(f"`{c}` {'array<long>' if c in _LISTS else 'long'}" for c in _GROUPED_NAMES)


def _grouped(sets: DataFrame, order: int, percent: int) -> DataFrame:
    keys = ["cluster", *[f"key{(order + k) % ORDERS}" for k in range(ORDERS)], "node"]
    dealt = sets.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(dealt.mapInArrow(_open_groups(percent, order == ORDERS - 1), _GROUPED), "groups")


def _within_bound(percent: int):
    """A block of queries and one group's token union: the queries with enough tokens in the union."""

    def run(key, queries: pa.Table, unions: pa.Table) -> pa.Table:
        threshold, kept = Threshold(percent), []
        if queries.num_rows and unions.num_rows:
            union = _tokens(unions.column("group_tokens").combine_chunks())[0]
            sets = _tokens(queries.column("tokens").combine_chunks())
            kept = [k for k, q in enumerate(sets) if np.isin(q, union, assume_unique=True).sum() >= threshold.least_shared(len(q))]
        return queries.select(["cluster", "group", "block", "node"]).take(pa.array(kept, pa.int64()))

    return run


def _query_groups(percent: int):
    """Opens one group to a block of queries: links between components, at most one for each query and component."""

    def run(key, queries: pa.Table, members: pa.Table) -> pa.Table:
        threshold, links = Threshold(percent), []
        if queries.num_rows and members.num_rows:
            sets = _tokens(members.column("tokens").combine_chunks())
            asked = _tokens(queries.column("tokens").combine_chunks())
            shared = shared_counts(asked, sets)
            linked = threshold.linked(shared, np.array([len(q) for q in asked])[:, None], np.array([len(s) for s in sets])[None, :])
            mine, theirs = (side.column("root").to_numpy() for side in (queries, members))
            rows, columns = np.nonzero(linked & (mine[:, None] != theirs[None, :]))
            links = sorted({(int(mine[i]), int(theirs[j])) for i, j in zip(rows, columns, strict=True)})
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _cross_links(groups: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links between components of clusters that have several groups. roots: (node, root) so far."""
    labelled = groups.select("cluster", "group", "node", "tokens", "asks").join(roots, "node", "left")
    labelled = stored(labelled.withColumn("root", F.coalesce("root", "node")), "labelled")
    sizes = labelled.groupBy("cluster", "root").count()
    largest = sizes.groupBy("cluster").agg(
        F.max(F.struct("count", -F.col("root"))).alias("top"), F.sum("count").alias("members"), F.max("count").alias("most")
    )
    asking = labelled.join(
        largest.select("cluster", (-F.col("top")["col2"]).alias("main"), (F.col("members") - F.col("most")).alias("outside")), "cluster"
    ).where("root <> main")
    asking = stored(
        asking.select(
            "cluster", F.col("group").alias("home"), "node", "root", "tokens", "asks",
            F.pmod(F.xxhash64("node"), F.ceil(F.col("outside") / QUERIES_A_TASK)).alias("block"),
        ),
        "queries",
    )
    matrix = groups.where("group_parts IS NOT NULL").select("cluster", "group", F.explode("group_parts").alias("part"))
    wanted = asking.select("cluster", "node", "home", "block", F.explode("asks").alias("part"))
    reached = wanted.join(matrix, ["cluster", "part"]).where("`group` <> home").select("cluster", "group", "block", "node").distinct()
    reached = stored(reached, "reached")
    place = ["cluster", "group", "block"]

    def asked(by: DataFrame) -> DataFrame:
        return by.join(asking.select("cluster", "node", "root", "tokens"), ["cluster", "node"])

    def beside(by: DataFrame, sides: DataFrame) -> DataFrame:
        opened = by.select(*place).distinct().join(sides, ["cluster", "group"])
        return opened.withColumnsRenamed({c: f"in_{c}" for c in place}).groupBy(*[f"in_{c}" for c in place])

    unions = groups.where("group_tokens IS NOT NULL").select("cluster", "group", "group_tokens")
    bounded = asked(reached).select(*place, "node", "tokens").groupBy(*place).cogroup(beside(reached, unions))
    bounded = stored(bounded.applyInArrow(_within_bound(percent), "cluster long, `group` long, block long, node long"), "bounded")
    visits = asked(bounded).select(*place, "root", "tokens")
    shown = beside(bounded, labelled.select("cluster", "group", "root", "tokens"))
    return visits.groupBy(*place).cogroup(shown).applyInArrow(_query_groups(percent), "a long, b long")


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """One row per document row: id, t1 and t2 (hashes of its text), n_shingles, component_id, stays.

    component_id is the smallest id of the documents reachable by links, nulls left aside (null if all are null);
    stays marks the row of a component to keep, or its repeats. Rows without words, null texts included, are alone. Repeated rows
    and rows with equal sets are linked. An empty table gives no rows. Sets are compared by 64-bit hashes of their
    shingles, and equal sets are recognised by 128 bits.
    """
    text, name = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    own = docs.select(name.alias("id"), text.alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    keyed = own.select("id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    numbered = keyed.select(F.monotonically_increasing_id().alias("row"), "id", "text", "t1", "t2")
    sets = stored(
        numbered.mapInArrow(
            _sets_of(width, percent), f"row long, id {kind}, t1 long, t2 long, n long, s1 long, s2 long, "
            + ", ".join(f"size{k} long, bytes{k} binary, " + ", ".join(f"{c}{k} array<long>" for c in _SLICES) for k in range(2)),
        ),
        "sets",
    )
    same = ["n", "s1", "s2"]
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "t1", "t2"))
    nodes = sets.where("n > 0").groupBy(*same).agg(first.alias("of"))
    nodes = stored(nodes.select(*same, F.col("of.row").alias("node"), "of.id", "of.t1", "of.t2"), "nodes")

    meeting = reduce(DataFrame.unionByName, [_meeting(sets, c) for c in _SLICES])
    stars = meeting.where(F.col("sets") > MEETING).where("s1 <> least").select(F.col("s1").alias("a"), F.col("least").alias("b"))
    schemes = F.array(*[F.struct(F.col(f"size{k}").alias("size"), F.col(f"bytes{k}").alias("bytes")) for k in range(2)])
    told = sets.select("s1", "n", F.explode(schemes).alias("x")).select("s1", "n", "x.size", "x.bytes").where("size IS NOT NULL")
    told = told.join(meeting.select("s1", "size").distinct(), ["s1", "size"], "left_semi").dropDuplicates(["s1", "size"])
    small = meeting.where(F.col("sets") <= MEETING).select("sig", "s1", "size").join(told, ["s1", "size"])
    compared = small.repartition("sig").sortWithinPartitions("sig", "s1").mapInArrow(_close_sets(percent), "a long, b long")
    stars = stars.unionByName(compared).distinct()
    clusters = components(stars).select(F.col("node").alias("s1"), F.col("root").alias("cluster"))

    members = nodes.join(clusters, "s1").select("cluster", "node", F.col("id").alias("j"), F.col("t1").alias("j1"), F.col("t2").alias("j2"))
    members = sized(stored(members, "members"), BROADCAST_ROWS)
    read = keyed.join(members, (F.col("t1") == F.col("j1")) & (F.col("t2") == F.col("j2")) & F.col("id").eqNullSafe(F.col("j")))
    token_schema = "cluster long, node long, tokens array<long>, parts array<long>, asks array<long>, " + ", ".join(f"key{k} long" for k in range(ORDERS))
    tokens = stored(read.select("cluster", "node", "text").mapInArrow(_tokens_of(width, percent), token_schema), "tokens")

    groups = _grouped(tokens, 0, percent)
    links = groups.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    several = groups.groupBy("cluster").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high")
    large = stored(groups.join(several.select("cluster"), "cluster", "left_semi"), "large")
    if not large.isEmpty():
        for order in range(1, ORDERS):
            groups = _grouped(large.drop("group", "root"), order, percent)
            links = links.unionByName(groups.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        so_far = components(links)
        links = links.unionByName(_cross_links(groups, so_far, percent))
    found = components(links)

    placed = stored(nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("node")))
    named = placed.groupBy("root").agg(first.alias("of")).select("root", F.col("of.id").alias("component_id"), F.col("of.node").alias("main"))
    named = sized(stored(named, "named"), BROADCAST_ROWS)
    known = placed.join(named, "root").select(*same, "component_id", (F.col("main") == F.col("node")).alias("leads"))
    full = sets.where("n > 0").join(stored(known, "known"), same)
    stays = F.col("leads") & F.col("id").eqNullSafe(F.col("component_id"))
    alone = sets.where("n = 0").withColumn("component_id", F.col("id")).withColumn("stays", F.lit(True))
    columns = ["id", "t1", "t2", "n", "component_id", "stays"]
    rows = full.withColumn("stays", stays).select(*columns).unionByName(alone.select(*columns))
    return rows.withColumnsRenamed({"id": id_col, "n": "n_shingles"})


def without_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Of each component one row stays, with all its columns: the one with the smallest id, nulls last.

    Rows that agree in id and text are one row and stay once, with the other columns of any of them. Texts without
    words are alone and stay.
    """
    found = similar_components(docs, id_col, text_col, width, percent).select(F.col(id_col).alias("id"), "t1", "t2", "stays")
    counted = stored(found.groupBy("id", "t1", "t2").agg(F.max("stays").alias("stays"), F.count("*").alias("rows")), "kept")
    k1, k2, k3 = free_names(docs, "t1", "t2", "t3")
    text, name = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def among(rows: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
        keys = sized(chosen.select(F.col("t1").alias(k1), F.col("t2").alias(k2), F.col("id").alias(k3)), BROADCAST_ROWS)
        same = (F.xxhash64(text) == F.col(k1)) & (F.xxhash64(F.lit(1), text) == F.col(k2)) & name.eqNullSafe(F.col(k3))
        return rows.join(keys, same, how)

    again = counted.where("rows > 1 AND stays")
    once = among(docs, counted.where("rows > 1 OR NOT stays"), "left_anti")
    if again.isEmpty():
        return once.select(*columns)
    return once.unionByName(among(docs, again, "left_semi").dropDuplicates([id_col, text_col])).select(*columns)
