"""Class-based n-gram language model after Brown et al.: exchange clustering puts words into classes; a text's
probability is the product of class transitions and of word emissions from the classes.

Every word that occurs EXCHANGE_COUNT times or more is exchanged between CLASSES classes, at every size of input; rarer
and unknown words have the class of their form (length, and whether it ends in a letter). Texts are turned once into
numbers of their words, in a table. What a turn needs of a word, how often each class stands before and after it, is
counted from that table with the classes of the moment, so pairs of words are never gathered; a task hands over one row
for each word, with all its counts. Tasks look numbers and classes up in slices of SLICE_WORDS words; where there are more words, the slices are
gone through one after another, with the same result. Counts of words, classes and transitions are of all training
texts. Unknown words share one extra place in the class of their form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shingles import SET_CHUNK, chunks, word_hashes
from .textops import stored

EXCHANGE_COUNT = 10
CLASSES = 48
#: Every word is moved ROUNDS times, a TURNS-th of the words at once.
ROUNDS, TURNS = 2, 4
#: Words that one task moves one by one in a turn; tasks do not see the moves of one another before the turn's end.
TASK_WORDS = 512
#: Words that a task, and the driver, look up at once: 16 bytes each for numbers, one byte each for classes.
SLICE_WORDS = 2_000_000
#: Tokens, rows and counters that a task works on at once.
PIECE, ROWS, HELD_CELLS = 1 << 20, 512, 1 << 20
#: Counted words that a task holds before it hands them over, and rows that it hands over at once.
HELD_WORDS, OUT_ROWS = 1 << 20, 1 << 16
#: Spark's setting for the rows that a Python task gets at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Weight of a class's own frequency in a transition.
TRANSITION_WEIGHT = 10.0
FORMS = 16
EVERY = CLASSES + FORMS + 1
END = np.uint64(0x0E0F_E0D0_C0DE_0001)
END_WORD = int(END.astype(np.int64))
#: Codes of tokens: the number of an exchanged word, or -1 less its form; the end of a text comes after the forms.
END_CODE, END_CLASS = -1 - FORMS, CLASSES + FORMS

Batches = Iterator[pa.RecordBatch]


def forms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A class of form for each word: its length in bytes, and whether its last byte is of a letter."""
    last = data[ends - 1]
    letter = ((last >= 97) & (last <= 122)) | ((last >= 65) & (last <= 90)) | (last >= 128)
    return np.minimum(ends - starts, FORMS // 2) - 1 + np.where(letter, 0, FORMS // 2)


def token_runs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of texts: hashes and forms of all tokens, each text's words and then an end, and where texts begin."""
    for chunk in chunks(texts, SET_CHUNK):
        begins = np.cumsum([0] + [len(t) + 1 for t in chunk])
        data = np.frombuffer(b"\n".join(chunk), np.uint8)
        starts, ends, words = word_hashes(data)
        stops = np.searchsorted(starts, begins[1:])
        tokens = np.insert(words, stops, END)
        kinds = np.insert(forms(data, starts, ends), stops, -1)
        yield tokens, kinds, np.concatenate(([0], stops[:-1])) + np.arange(len(chunk))


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python tasks get ROWS rows at once meanwhile, so that neither they nor Spark hold much text outside its heap."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, the sum of n for each, and a place where each stands."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first), order[first]


def _word_counts(batches: Batches) -> Batches:
    """How often each word stands in the texts of a task; handed over early only beyond HELD_WORDS."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        words, n, place = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts]))
        return words, np.concatenate([p[1] for p in parts])[place], n

    def rows(*found: np.ndarray) -> Batches:
        for at in range(0, len(found[0]), OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + OUT_ROWS]) for c in found], ["word", "form", "n"])

    parts, size = [], 0
    for batch in batches:
        for tokens, kinds, _ in token_runs(_bytes(batch)):
            words, first, n = np.unique(tokens.view(np.int64), return_index=True, return_counts=True)
            parts.append((words, kinds[first], n))
            size += len(words)
            if size > HELD_WORDS:
                parts = [merged(parts)]
                size = len(parts[0][0])
                if size > HELD_WORDS // 2:
                    yield from rows(*parts[0])
                    parts, size = [], 0
    if parts:
        yield from rows(*merged(parts))


@dataclass
class Slice:
    """Exchanged words numbered from first on: their hashes, sorted, and how often each occurs."""

    first: int
    words: np.ndarray
    counts: np.ndarray


def exchanged_words(counts: DataFrame) -> DataFrame:
    return counts.where((F.col("n") >= EXCHANGE_COUNT) & (F.col("word") != END_WORD)).select("word", "n")


def word_slices(counts: DataFrame) -> Iterator[Slice]:
    """All exchanged words in the order of their hashes, in slices of about SLICE_WORDS; one at least."""
    exchanged = exchanged_words(counts)
    slices = max(1, -(-exchanged.count() // SLICE_WORDS))
    width, first = -(-(1 << 64) // slices), 0
    for k in range(slices):
        low = k * width - (1 << 63)
        high = min(low + width, 1 << 63) - 1
        found = exchanged.where(F.col("word").between(low, high)).toArrow()
        words = found.column("word").to_numpy()
        order = np.argsort(words)
        yield Slice(first, words[order], found.column("n").to_numpy()[order])
        first += len(words)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists of a column, and where each list begins and the last one ends."""
    cuts = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), cuts - cuts[0]


def _lists(cuts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))


def _look_up(part: Slice, codes: np.ndarray, cuts: np.ndarray, unnamed: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gives the words of a slice their numbers. unnamed has the hashes of the words without one, in their order.

    Returns codes, the hashes still unnamed, their cuts, and for each text how many words were named and the sum of
    log10(count + 1) of these.
    """
    n, codes = len(cuts) - 1, codes.copy()
    places = np.flatnonzero((codes < 0) & (codes != END_CODE))
    owner = np.searchsorted(cuts, places, side="right") - 1
    if len(part.words):
        at = np.minimum(np.searchsorted(part.words, unnamed), len(part.words) - 1)
        found = part.words[at] == unnamed
        codes[places[found]] = part.first + at[found]
        weights = np.log10(part.counts[at[found]] + 1.0)
    else:
        found, weights = np.zeros(len(unnamed), bool), np.empty(0)
    named = np.bincount(owner[found], minlength=n)
    counted = np.bincount(owner[found], weights, minlength=n)
    left = np.concatenate(([0], np.cumsum(np.bincount(owner[~found], minlength=n))))
    return codes, unnamed[~found], left, named, counted


def _numbers(part: Slice, ends: int):
    """Texts as codes, the words of the first slice numbered; ends is the count of ends in training texts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            at = 0
            for tokens, kinds, begins in token_runs(_bytes(batch)):
                cuts = np.append(begins, len(tokens))
                codes = np.where(kinds < 0, END_CODE, -1 - kinds).astype(np.int32)
                codes, left, left_cuts, named, counted = _look_up(part, codes, cuts, tokens[kinds >= 0].view(np.int64))
                rest = batch.slice(at, len(begins))
                at += len(begins)
                columns = [rest.column(c) for c in ("row", "id", "held_out")]
                columns += [pa.array(np.diff(cuts)), pa.array(named + int(ends > 0)), pa.array(counted + np.log10(ends + 1.0))]
                yield pa.RecordBatch.from_arrays([*columns, _lists(cuts, codes), _lists(left_cuts, left)], _TOKENS)

    return run


_TOKENS = ["row", "id", "held_out", "n_tokens", "n_known", "counted", "codes", "unnamed"]


def _more_numbers(part: Slice):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                codes, cuts = _flat(rows.column("codes"))
                codes, left, left_cuts, named, counted = _look_up(part, codes, cuts, _flat(rows.column("unnamed"))[0])
                columns = [rows.column(c) for c in _TOKENS[:4]]
                columns += [pa.array(rows.column("n_known").to_numpy() + named), pa.array(rows.column("counted").to_numpy() + counted)]
                yield pa.RecordBatch.from_arrays([*columns, _lists(cuts, codes), _lists(left_cuts, left)], _TOKENS)

    return run


def numbered(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (id, text, held_out) as codes of their tokens, written once: row, id, held_out, n_tokens, n_known and
    counted (of the exchanged words and the end: tokens with a count, sum of log10(count + 1)), codes, and unnamed, the
    hashes of all other words."""
    end = counts.where(F.col("word") == END_WORD).first()
    schema = f"row long, id {rows.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, counted double, codes array<int>, unnamed array<long>"
    tokens = None
    for part in word_slices(counts):
        if tokens is None:
            texts = rows.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text")
            tokens = stored(texts.mapInArrow(_numbers(part, end["n"] if end else 0), schema), "tokens")
        else:
            tokens = stored(tokens.mapInArrow(_more_numbers(part), schema), "tokens")
    return tokens


def _named(low: int, classes: np.ndarray):
    """Adds the classes of the tokens, of words those numbered from low on; others keep theirs or get -1."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                names = [c for c in rows.schema.names if c != "classes"]
                codes, cuts = _flat(rows.column("codes"))
                if len(names) < rows.num_columns:
                    found = _flat(rows.column("classes"))[0].copy()
                else:
                    found = np.where(codes < 0, CLASSES - 1 - codes, -1).astype(np.int8)
                here = (codes >= low) & (codes < low + len(classes))
                found[here] = classes[codes[here] - low]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], _lists(cuts, found)], [*names, "classes"])

    return run


def with_classes(tokens: DataFrame, now: DataFrame, n_words: int, finish: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """What finish makes of batches of tokens with their classes; now has the class of every exchanged word."""
    lows = range(0, max(n_words, 1), SLICE_WORDS)
    for low in lows:
        found = now.where(F.col("item").between(low, low + SLICE_WORDS - 1)).toArrow()
        classes = np.zeros(min(SLICE_WORDS, n_words - low), np.int8)
        classes[found.column("item").to_numpy() - low] = found.column("class").to_numpy()
        name = _named(low, classes)
        if low != lows[-1]:
            fields = [f for f in tokens.schema.fields if f.name != "classes"] + [T.StructField("classes", T.ArrayType(T.ByteType()))]
            tokens = stored(tokens.mapInArrow(name, T.StructType(fields)), "classed")
    return tokens.mapInArrow(lambda batches: finish(name(batches)), schema)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and classes of neighbouring tokens, the last of a piece being the first of the next. An end stands before
    each text, as the text before it has one."""
    codes = np.concatenate(([END_CODE], _flat(batch.column("codes"))[0])).astype(np.int64)
    classes = np.concatenate(([END_CLASS], _flat(batch.column("classes"))[0])).astype(np.int64)
    for at in range(0, len(codes) - 1, PIECE):
        yield codes[at : at + PIECE + 1], classes[at : at + PIECE + 1]


def _class_pairs(batches: Batches) -> Batches:
    cells = np.zeros(EVERY * EVERY, np.int64)
    for batch in batches:
        for _, classes in _pieces(batch):
            cells += np.bincount(classes[:-1] * EVERY + classes[1:], minlength=EVERY * EVERY)
    met = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(cells[met])], ["cell", "n"])


def _neighbours(turn: int):
    """How often each class follows (cell: the class) or precedes (cell: EVERY more) the words of a turn, counted over
    a whole task; handed over early only beyond HELD_CELLS counters."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))[:2]

    def rows(keys: np.ndarray, n: np.ndarray) -> Batches:
        for at in range(0, len(keys), OUT_ROWS):
            word, cell = np.divmod(keys[at : at + OUT_ROWS], 2 * EVERY)
            item, home = np.divmod(word, CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (item, home, cell, n[at : at + OUT_ROWS])], ["item", "home", "cell", "n"])

    def run(batches: Batches) -> Batches:
        parts, size = [], 0
        for batch in batches:
            for codes, classes in _pieces(batch):
                moving = (codes >= 0) & (codes % TURNS == turn)
                words = (codes * CLASSES + classes) * (2 * EVERY)
                after, ahead = np.flatnonzero(moving[:-1]), np.flatnonzero(moving[1:]) + 1
                keys = np.concatenate((words[after] + classes[after + 1], words[ahead] + EVERY + classes[ahead - 1]))
                parts.append(np.unique(keys, return_counts=True))
                size += len(parts[-1][0])
                if size > HELD_CELLS:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > HELD_CELLS // 2:
                        yield from rows(*parts[0])
                        parts, size = [], 0
        if parts:
            yield from rows(*merged(parts))

    return run


def _by_word(batches: Batches) -> Batches:
    """The rows of _neighbours, in which a word's stand together, as one row a word with the lists of its cells and n."""
    for batch in batches:
        item, home, cell, n = (c.to_numpy() for c in batch.columns)
        first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        cuts = np.append(first, len(item))
        columns = [pa.array(item[first]), pa.array(home[first]), _lists(cuts, cell.astype(np.int16)), _lists(cuts, n)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "home", "cells", "n"])


def _log_sum(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _exchange(joint: np.ndarray):
    """Moves words, each to the class that makes the text's class pairs most likely, one by one within a task.

    Rows are (item, home, around): around has (cells, n) of each task that met the word, how often each class follows or
    precedes, as in _by_word; a cell's numbers add up. A last row without an item has what the task's moves change in the
    class pairs.
    """

    def run(batches: Batches) -> Batches:
        cells = joint.astype(np.float64).copy()
        logs = _log_sum(cells)

        def change(at: int, right: np.ndarray, left: np.ndarray) -> None:
            cells[at, :] += right
            cells[:, at] += left
            np.maximum(cells[at, :], 0, out=cells[at, :])
            np.maximum(cells[:, at], 0, out=cells[:, at])
            logs[at, :], logs[:, at] = _log_sum(cells[at, :]), _log_sum(cells[:, at])

        for batch in batches:
            homes, lists = batch.column("home").to_numpy(), batch.column("around")
            cells_met, times = (lists.values.field(k) for k in range(2))
            cuts = cells_met.offsets.to_numpy()[lists.offsets.to_numpy()]
            cell, n = (c.values.to_numpy(zero_copy_only=False) for c in (cells_met, times))
            moved = np.empty(len(homes), np.int64)
            for k, (home, a, b) in enumerate(zip(homes.tolist(), cuts[:-1], cuts[1:], strict=True)):
                around = np.bincount(cell[a:b], n[a:b], 2 * EVERY)
                right, left = around[:EVERY], around[EVERY:]
                count = right.sum()
                change(home, -right, -left)
                sums = cells.sum(axis=1)[:CLASSES]
                after, ahead = np.flatnonzero(right), np.flatnonzero(left)
                gain = (_log_sum(cells[:CLASSES, after] + right[after]) - logs[:CLASSES, after]).sum(axis=1)
                gain += (_log_sum(cells[ahead, :CLASSES] + left[ahead][:, None]) - logs[ahead, :CLASSES]).sum(axis=0)
                gain -= 2 * (_log_sum(sums + count) - _log_sum(sums))
                best = int(np.argmax(gain))
                best = home if gain[home] >= gain[best] - 1e-6 else best
                change(best, right, left)
                moved[k] = best
            none = pa.nulls(len(moved), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(moved), none], ["item", "moved", "change"])
        total = pa.array([(cells - joint).ravel()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), total], ["item", "moved", "change"])

    return run


@dataclass
class Model:
    now: DataFrame
    """(item, class) of every exchanged word by its number."""
    n_words: int
    transitions: np.ndarray
    """log10 of P(class | class before), by row."""
    emissions: np.ndarray
    """log10 of the denominators of the classes' words."""
    tokens: int
    distinct: int

    @property
    def steps(self) -> np.ndarray:
        """By class before and class: what a token's score has besides its count."""
        return self.transitions - self.emissions


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, form, n): how often each token, by its hash, stands in the texts; the end of a text is one."""
    rows = texts.select(F.col(f"`{text_col}`").alias("text"))
    counted = rows.mapInArrow(_word_counts, "word long, form long, n long")
    return counted.groupBy("word").agg(F.min("form").alias("form"), F.sum("n").alias("n"))


def train(tokens: DataFrame, counts: DataFrame) -> Model:
    """Fits the classes and their probabilities to training texts as numbered() gives them, of which counts are the
    word_counts. The driver holds the class pairs and one slice of words at a time."""
    spark = tokens.sparkSession
    tokens = tokens.select("codes")
    sizes = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    n_words = exchanged_words(counts).count()
    start = F.pmod(F.xxhash64("id"), F.lit(CLASSES)).cast("long")
    now = stored(spark.range(n_words).select(F.col("id").alias("item"), start.alias("class")), "classes")

    def class_pairs(now: DataFrame) -> np.ndarray:
        joint = np.zeros(EVERY * EVERY)
        found = with_classes(tokens, now, n_words, _class_pairs, "cell long, n long")
        for r in found.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            joint[r["cell"]] = r["n"]
        return joint.reshape(EVERY, EVERY)

    joint = class_pairs(now)
    tasks = max(1, -(-n_words // (TURNS * TASK_WORDS)))
    for turn in range(ROUNDS * TURNS if n_words else 0):
        count = _neighbours(turn % TURNS)
        met = with_classes(tokens, now, n_words, lambda batches, count=count: _by_word(count(batches)), "item long, home long, cells array<short>, n array<long>")
        around = met.repartition(tasks, "item").groupBy("item").agg(F.min("home").alias("home"), F.collect_list(F.struct("cells", "n")).alias("around"))
        dealt = around.sortWithinPartitions("item")
        moved = stored(dealt.mapInArrow(_exchange(joint), "item long, moved long, change array<double>"), "moves")
        now = now.join(moved.where("item IS NOT NULL"), "item", "left").select("item", F.coalesce("moved", "class").alias("class"))
        now = stored(now, "classes")
        if turn % TURNS == TURNS - 1:
            joint = class_pairs(now)
            continue
        # Within a round the tasks' changes are added up; only pairs whose words both moved are counted again at its end.
        changes = moved.where("item IS NULL").select(F.posexplode("change").alias("cell", "by")).groupBy("cell").agg(F.sum("by").alias("by"))
        for r in changes.collect():
            joint[divmod(r["cell"], EVERY)] = max(joint[divmod(r["cell"], EVERY)] + r["by"], 0)
    frequency = joint.sum(axis=0) / max(joint.sum(), 1)
    frequency = (frequency + 1e-9) / (frequency + 1e-9).sum()
    row_sums = joint.sum(axis=1, keepdims=True)
    transitions = np.log10((joint + TRANSITION_WEIGHT * frequency) / (row_sums + TRANSITION_WEIGHT))
    totals = np.zeros((2, EVERY))
    totals[0] = joint.sum(axis=0)
    for r in now.groupBy("class").count().collect():
        totals[1, r["class"]] = r["count"]
    rare = counts.where((F.col("n") < EXCHANGE_COUNT) | (F.col("word") == END_WORD))
    for r in rare.groupBy("form").agg(F.count("*").alias("n")).collect():
        totals[1, END_CLASS if r["form"] < 0 else CLASSES + r["form"]] = r["n"]
    return Model(now, n_words, transitions, np.log10(totals[0] + totals[1] + 1), int(sizes["tokens"] or 0), int(sizes["distinct"]))


def _scored(steps: np.ndarray):
    """Sums of the steps of each text, and its distinct words without a number with how often each stands there."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            classes, cuts = _flat(batch.column("classes"))
            before = np.concatenate(([END_CLASS], classes[:-1]))
            sums = np.add.reduceat(steps[before, classes], cuts[:-1])
            words, word_cuts = _flat(batch.column("unnamed"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(word_cuts))
            order = np.lexsort((words, owner))
            words = words[order]
            new = np.ones(len(words), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (words[1:] != words[:-1])
            first = np.flatnonzero(new)
            own_cuts = np.searchsorted(owner[first], np.arange(batch.num_rows + 1))
            times = np.diff(np.append(first, len(words)))
            columns = [batch.column(c) for c in _TOKENS[:6]]
            arrays = [*columns, pa.array(sums), _lists(own_cuts, words[first]), _lists(own_cuts, times)]
            yield pa.RecordBatch.from_arrays(arrays, [*_TOKENS[:6], "steps", "words", "times"])

    return run


def perplexities(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    The model learns from the rows that are not held out, and all rows are scored. base_score adds log10 of
    (c + 1) / (N + V + 1) over tokens, score is the log10 probability of the class model, and perplexity
    10 ** (-score / n_tokens). Null and empty texts are an end alone; nothing to learn from leaves all words unknown.
    Texts of any length are taken whole; repeated rows and ids count and are scored each on their own, and other columns,
    whatever their names, are not read. Of classes equally good for a word, its own stays, else the first is taken.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    with small_batches(docs.sparkSession):
        counts = stored(word_counts(rows.where(~F.col("held_out"))), "counts")
        tokens = numbered(rows, counts)
        model = train(tokens.where(~F.col("held_out")), counts)
        schema = f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, counted double, steps double, words array<long>, times array<long>"
        local = stored(with_classes(tokens.drop("classes"), model.now, model.n_words, _scored(model.steps), schema), "scores")
    rare = local.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    few = counts.where((F.col("n") < EXCHANGE_COUNT) & (F.col("word") != END_WORD)).select("word", "n")
    more = rare.join(few, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("found")
    )
    joined = local.drop("words", "times").join(more, "row", "left")
    counted = F.col("counted") + F.coalesce("more", F.lit(0.0))
    score = counted + F.col("steps")
    return joined.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * float(np.log10(model.tokens + model.distinct + 1))).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
