"""License scans: an exact set-similarity join of text blocks with license templates.

Blocks are runs of words, each beginning half a run after the last, so that every statement lies whole in some block.
A block contains a template if it has at least percent of the template's distinct words and, where a template has
deciding words, those stand in the block side by side in their order, as templates of one family differ in one word.
Words are ordered by how often the whole corpus has them, rarest first. A pair is looked at only if one of the
template's rarest words is in the block (prefix), the block has enough of the templates' words (length), and the words
before and from the shared word on can be enough on both sides (position); then the overlap is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import document_keys, plain_words
from .textops import ascii_lower as lower

# The phrases of the base scan, and short statements by which documents name their license.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("all rights reserved", "all-rights-reserved"),
)
# The words that tell a statement from others of its family.
DECIDING = {
    "released under the mit license": "mit license",
    "permission is hereby granted free of charge to any person": "hereby granted free of charge",
    "licensed under the apache license version 2 0": "apache license version 2",
    "licensed under cc by nc 4 0": "by nc 4",
    "licensed under cc by 4 0": "by 4",
    "licensed under cc by sa 4 0": "by sa 4",
    "licensed under cc by nd 4 0": "by nd 4",
    "licensed under cc by nc sa 4 0": "by nc sa 4",
    "licensed under cc by nc nd 4 0": "by nc nd 4",
    "licensed under the gnu general public license version 3": "general public license version 3",
    "licensed under the gnu general public license version 2": "general public license version 2",
    "mozilla public license version 2 0": "mozilla public license version 2",
    "redistribution and use in source and binary forms": "source and binary forms",
    "all rights reserved": "all rights reserved",
}
PERCENT = 85


def lower_words(text: Column) -> Column:
    """Words of digits, letters and characters beyond ASCII, A-Z in lower case; none for null."""
    return plain_words(lower(text))


def places_of(words: Column, phrases: list[list[str]]) -> Column:
    """(place, phrase number) of every place where a phrase's words stand consecutively, by place and number."""

    def here(w: Column, i: Column, phrase: list[str]) -> Column:
        match = w == phrase[0]
        for k, other in enumerate(phrase[1:], 1):
            match = match & (F.coalesce(F.get(words, i + k), F.lit("")) == other)
        return match

    def found(number: int, phrase: list[str]) -> Column:
        each = F.transform(words, lambda w, i: F.when(here(w, i, phrase), F.struct(i.alias("at"), F.lit(number).alias("phrase"))))
        return F.filter(each, lambda x: x.isNotNull())

    return F.sort_array(F.concat(*[found(n, p) for n, p in enumerate(phrases)]))


def word_order(docs: DataFrame, text_col: str, templates: tuple[tuple[str, str], ...]) -> list[str]:
    """The templates' distinct words, rarest in the corpus first, ties by the word. As many rows as the templates,
    which are a parameter, have words."""
    vocabulary = sorted({w for text, _ in templates for w in text.split()})
    words = docs.select(F.explode(lower_words(F.col(f"`{text_col}`"))).alias("word")).where(F.col("word").isin(vocabulary))
    counts = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_prefixes(
    docs: DataFrame, order: list[str], templates: tuple[tuple[str, str], ...], deciding: dict[str, str], percent: int
) -> DataFrame:
    """(word, template, label, place, size, least, words, deciding): the rarest words of each template, of which a block
    that contains it has at least one."""
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for number, (text, label) in enumerate(templates):
        words = sorted(set(text.split()), key=rank.__getitem__)
        least = -(-percent * len(words) // 100)
        for place, word in enumerate(words[: len(words) - least + 1]):
            rows.append((word, number, label, place, len(words), least, words, f" {deciding.get(text, '')} "))
    return docs.sparkSession.createDataFrame(
        rows, "word string, template int, label string, place int, size int, least int, words array<string>, deciding string"
    )


def contained_templates(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    deciding: dict[str, str] = DECIDING,
    percent: int = PERCENT,
) -> DataFrame:
    """(k1, k2, block, template, label, shared, size) of every block that contains a template."""
    longest = max(len(text.split()) for text, _ in templates)
    order = word_order(docs, text_col, templates)
    prefixes = template_prefixes(docs, order, templates, deciding, percent)
    least = min(-(-percent * len(set(text.split())) // 100) for text, _ in templates)
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    keys = [k.alias(n) for k, n in zip(document_keys(text, doc_id), ("k1", "k2"), strict=True)]
    known = F.array(*[F.lit(w) for w in order])
    rows = docs.select(*keys, lower_words(text).alias("w"), known.alias("known"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(longest))
    blocks = F.filter(
        F.transform(
            starts,
            lambda s: F.struct(
                s.alias("block"), F.array_intersect("known", F.slice("w", s + 1, F.lit(2 * longest))).alias("words")
            ),
        ),
        lambda b: F.size(b["words"]) >= least,
    )
    run = F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("b.block") + 1, F.lit(2 * longest)), " "), F.lit(" "))
    some = rows.select("k1", "k2", "w", F.explode(blocks).alias("b")).select("k1", "k2", "b.block", F.col("b.words").alias("has"), run.alias("run"))
    each = some.select("k1", "k2", "block", "has", "run", F.posexplode("has").alias("at", "word"))
    pairs = each.join(F.broadcast(prefixes), "word").where(
        (F.size("has") >= F.col("least"))
        & (F.least("at", "place") + F.least(F.size("has") - F.col("at"), F.col("size") - F.col("place")) >= F.col("least"))
        & ((F.col("deciding") == "  ") | F.contains("run", "deciding"))
    )
    shared = F.size(F.array_intersect("words", "has"))
    found = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("least"))
    return found.groupBy("k1", "k2", "block", "template", "label", "size").agg(F.max("shared").alias("shared"))


def license_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    deciding: dict[str, str] = DECIDING,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    score is the largest share of a template's words in one block that contains it, 1 where a phrase stands, else 0.
    n_blocks counts the pairs of blocks and templates. deciding gives, by a template's text, the words that must stand
    side by side in a block; templates that it lacks need none. Whole texts are read however long. Null and empty texts have no words, no labels and null places;
    repeated rows each get the same result.
    """
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    own = docs.select(doc_id.alias("id"), text.alias("text"))
    found = contained_templates(own, "id", "text", templates, deciding, percent)
    named = found.groupBy("k1", "k2").agg(
        F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("size")).alias("share"), F.count("*").alias("blocks")
    )
    keys = [k.alias(n) for k, n in zip(document_keys(F.col("text"), F.col("id")), ("k1", "k2"), strict=True)]
    rows = own.select("id", *keys, lower_words(F.col("text")).alias("w"))
    rows = rows.withColumn("at", places_of(F.col("w"), [p.split() for p, _ in phrases]))
    labels = F.array(*[F.lit(label) for _, label in phrases])
    rows = rows.select(
        "id",
        "k1",
        "k2",
        F.size("w").cast("long").alias("n_words"),
        F.size("at").cast("long").alias("n_base"),
        F.get("at", F.lit(0))["at"].cast("long").alias("first_word"),
        F.try_element_at("at", F.lit(-1))["at"].cast("long").alias("last_word"),
        F.sort_array(F.array_distinct(F.transform("at", lambda x: F.get(labels, x["phrase"])))).alias("base"),
    )
    none = F.array().cast("array<string>")
    return rows.join(named, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )
