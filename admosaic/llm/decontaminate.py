"""Benchmark decontamination over a positional inverted index of the training documents.

The index holds postings (term, document, position) of the terms that searches open: of every phrase its two rarest
terms. A search starts from the list of the rarest term, shifts it by the term's offset in the phrase, intersects it
with the shifted list of the second rarest, and compares the remaining words with those stored beside the posting.
Phrases that hold a term the corpus lacks are never searched.

Every document is indexed and every phrase searched. Terms and phrases go to the tasks in blocks of at most
BLOCK_TERMS and BLOCK_PHRASES, so what is broadcast has a bound of its own; a larger benchmark takes more passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import ascii_lower, document_keys, free_names, plain_words, sized, stored

WINDOW = 10
BLOCK_TERMS = 200_000
BLOCK_PHRASES = 100_000
BROADCAST_ROWS = 1_000_000


def _key(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that tell documents apart; repeated rows share them and have the same result."""
    return [k.alias(name) for k, name in zip(document_keys(text, doc_id), ("k1", "k2"), strict=True)]


def benchmark_phrases(items: DataFrame, item_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(item, phrase, words) of every window of consecutive words; a shorter item is one window, one without words none."""
    words = plain_words(ascii_lower(F.col(f"`{text_col}`")))
    cut = items.select(F.col(f"`{item_col}`").alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    spread = cut.select("item", "w", F.explode(starts).alias("at"))
    spread = spread.select("item", F.slice("w", F.col("at"), F.least(F.lit(window), F.size("w"))).alias("words"))
    return spread.select("item", F.array_join("words", " ").alias("phrase"), "words")


def term_counts(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(term, n): how often each term stands in all documents, 0 if nowhere. terms: (term), distinct."""
    words = docs.select(F.explode(plain_words(F.col(f"`{text_col}`"))).alias("word"))
    found = words.select(F.lower("word").alias("term")).groupBy("term").count()
    return terms.join(found, "term", "left").select("term", F.coalesce("count", F.lit(0)).alias("n"))


def rank_phrases(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, words, term1, off1, term2, off2): each distinct phrase with its two rarest places, ties by place.

    Phrases with a term that stands nowhere are left out; of one word, the second term is null.
    """
    places = phrases.dropDuplicates(["phrase"]).select("phrase", "words", F.posexplode("words").alias("off", "word"))
    known = places.join(counts.withColumnRenamed("term", "low"), F.lower("word") == F.col("low"))
    ranked = known.groupBy("phrase").agg(
        F.first("words").alias("words"),
        F.min("n").alias("least"),
        F.sort_array(F.collect_list(F.struct("n", "off", F.col("low").alias("term")))).alias("by"),
    )
    return ranked.where("least > 0").select(
        "phrase",
        "words",
        F.col("by")[0]["term"].alias("term1"),
        F.col("by")[0]["off"].alias("off1"),
        F.get("by", F.lit(1))["term"].alias("term2"),
        F.get("by", F.lit(1))["off"].alias("off2"),
    )


def _blocks(frame: DataFrame, by: str, most: int) -> list[DataFrame]:
    n = -(-frame.count() // most)
    if n <= 1:
        return [frame]
    return [frame.where(F.pmod(F.xxhash64(by), F.lit(n)) == b) for b in range(n)]


def positional_index(docs: DataFrame, id_col: str, text_col: str, ranked: DataFrame, window: int = WINDOW) -> DataFrame:
    """(term, k1, k2, pos, near, before): postings of the terms in ranked, with the words around the rarest ones.

    near holds the words from window - 1 places before to as many after, as far as there are any; before is how many
    of them precede the posting. Terms are matched in full lower case, which never misses a word that differs from
    the phrase in A-Z only; the phrase comparison is exact.
    """
    first = ranked.select(F.col("term1").alias("term")).distinct().withColumn("opens", F.lit(True))
    second = ranked.where("term2 IS NOT NULL").select(F.col("term2").alias("term")).distinct()
    terms = stored(first.join(second, "term", "full").select("term", F.coalesce("opens", F.lit(False)).alias("opens")), "terms")
    words = docs.select(
        *_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), plain_words(F.col(f"`{text_col}`")).alias("w")
    )
    placed = words.select("k1", "k2", "w", F.posexplode("w").alias("pos", "word"))
    placed = placed.withColumn("term", F.lower("word"))
    start = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    lists = [
        placed.join(F.broadcast(block), "term").select(
            "term",
            "k1",
            "k2",
            "pos",
            F.when(F.col("opens"), F.slice("w", start + 1, F.col("pos") + window - start)).alias("near"),
            (F.col("pos") - start).alias("before"),
        )
        for block in _blocks(terms, "term", BLOCK_TERMS)
    ]
    return reduce(DataFrame.unionByName, lists)


def phrase_matches(index: DataFrame, ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, phrase, start, len) of exact matches, and (k1, k2, phrase) of proximity matches: around a posting of
    the rarest term stand all words of the phrase, in any order."""
    opened = index.where("near IS NOT NULL")
    candidates = reduce(
        DataFrame.unionByName,
        [
            opened.join(F.broadcast(block), opened["term"] == block["term1"])
            for block in _blocks(ranked, "phrase", BLOCK_PHRASES)
        ],
    ).select(
        "k1",
        "k2",
        "phrase",
        (F.col("pos") - F.col("off1")).alias("start"),
        F.size("words").alias("len"),
        "words",
        "near",
        (F.col("before") - F.col("off1")).alias("skip"),
        "term2",
        "off2",
    )
    around = F.transform("near", ascii_lower)
    close = candidates.where(F.size(F.array_except("words", around)) == 0).select("k1", "k2", "phrase").distinct()
    placed = candidates.where("start >= 0 AND skip >= 0")
    lists = index.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "pos", F.col("term").alias("other"))
    on = [
        placed["k1"] == lists["j1"],
        placed["k2"] == lists["j2"],
        placed["start"] + placed["off2"] == lists["pos"],
        placed["term2"] == lists["other"],
    ]
    both = placed.where("term2 IS NOT NULL").join(lists, on, "left_semi").unionByName(placed.where("term2 IS NULL"))
    found = F.array_join(F.slice("near", F.greatest(F.col("skip"), F.lit(0)) + 1, F.col("len")), " ")
    exact = both.where(ascii_lower(found) == F.col("phrase"))
    return exact.select("k1", "k2", "phrase", "start", "len"), close


def covered_words(spans: Column) -> Column:
    """How many words the (start, len) spans cover; spans in ascending order."""
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans,
        state,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["start"] + s["len"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["start"] + s["len"]).alias("end"),
        ),
        lambda a: a["n"],
    )


def _search(own, items, id_col, text_col, item_col, item_text_col, window) -> tuple[DataFrame, DataFrame, DataFrame]:
    phrases = stored(benchmark_phrases(items, item_col, item_text_col, window), "phrases")
    terms = phrases.select(F.explode("words").alias("t")).select(F.lower("t").alias("term")).distinct()
    ranked = stored(rank_phrases(phrases, term_counts(own, text_col, terms)), "ranked")
    index = stored(positional_index(own, id_col, text_col, ranked, window), "index")
    exact, close = phrase_matches(index, ranked)
    return phrases, stored(exact.distinct(), "matches"), close


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document row: id, n_words, n_hit (words inside a window of an item), items (sorted, as strings),
    near_items (how many items have a window whose words all stand close together, in any order), contaminated.

    Null and empty texts have no words and no hits; items without words have no windows; without items or documents
    nothing is hit. Items under one id, and rows repeated, count once and each get the same result.
    """
    own = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    phrases, exact, close = _search(own, items, id_col, text_col, item_col, item_text_col, window)
    owners = phrases.select("phrase", F.col("item").cast("string").alias("item")).distinct()
    named = (
        exact.select("k1", "k2", "phrase").distinct().join(owners, "phrase").select("k1", "k2", "item").distinct()
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    near = (
        close.join(owners, "phrase").select("k1", "k2", "item").distinct()
        .groupBy("k1", "k2").agg(F.count("*").alias("near_items"))
    )
    hit = exact.groupBy("k1", "k2").agg(
        covered_words(F.sort_array(F.collect_set(F.struct("start", "len")))).cast("long").alias("n_hit")
    )
    found = hit.join(named, ["k1", "k2"], "full").join(near, ["k1", "k2"], "full")
    rows = own.select(
        F.col(f"`{id_col}`").alias("_id"),
        *_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")),
        F.size(plain_words(F.col(f"`{text_col}`"))).cast("long").alias("n_words"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, ["k1", "k2"], "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("near_items", F.lit(0).cast("long")).alias("near_items"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents without any word inside a window of an item, with all their columns."""
    own = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    _, exact, _ = _search(own, items, id_col, text_col, item_col, item_text_col, window)
    k1, k2 = free_names(docs, "k1", "k2")
    hit = sized(stored(exact.select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct(), "hit"), BROADCAST_ROWS)
    keys = document_keys(F.col(f"`{text_col}`"), F.col(f"`{id_col}`"))
    return docs.join(hit, (keys[0] == F.col(k1)) & (keys[1] == F.col(k2)), "left_anti")
