"""Language of texts by Bayesian fusion: how likely the text is in each language, what its markup declares, what its
address ends in, and which languages its host has elsewhere.

Text likelihoods come from byte trigrams of labelled texts. Host priors are smoothed from the host to its suffix and on
to all records, and leave the record itself out. The fused score is a sum of logarithms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import sized, stored

BUCKETS = 1 << 16
#: Weight of the text's logarithms, as neighbouring trigrams tell the same again and again.
TEMPER = 0.25
#: How many records the suffix, and all records, weigh in a host's prior.
SUFFIX_WEIGHT, GLOBAL_WEIGHT = 5.0, 20.0
#: Probability that a declared language and that a national suffix tell the language.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.8
BROADCAST_ROWS = 200_000

#: Languages that one model may tell apart: its table has a column for each.
MOST_LANGUAGES = 512
#: Trigrams of a text whose rows of the table are looked up at once.
PIECE = 1 << 16

# National address suffixes by the language most of the country's pages are in.
LANGUAGE_SUFFIXES = {
    "de": ("at", "de", "li"),
    "en": ("au", "ie", "nz", "uk", "us"),
    "es": ("ar", "bo", "cl", "co", "cr", "cu", "do", "ec", "es", "gt", "hn", "mx", "ni", "pa", "pe", "py", "sv", "uy", "ve"),
    "fr": ("fr", "mc"),
    "it": ("it", "sm", "va"),
    "pt": ("br", "pt"),
    "nl": ("nl", "sr"),
    "pl": ("pl",),
    "ru": ("ru", "su"),
    "ja": ("jp",),
    "ko": ("kr",),
    "zh": ("cn", "tw"),
    "tr": ("tr",),
    "sv": ("se",),
    "da": ("dk",),
    "fi": ("fi",),
    "cs": ("cz",),
    "el": ("gr",),
    "hu": ("hu",),
}
# Codes of three letters (ISO 639-2, both forms) by those of two; all other codes stand as they are.
THREE_LETTERS = {
    "deu": "de", "ger": "de", "eng": "en", "spa": "es", "fra": "fr", "fre": "fr", "ita": "it", "por": "pt", "nld": "nl", "dut": "nl",
    "pol": "pl", "rus": "ru", "jpn": "ja", "kor": "ko", "zho": "zh", "chi": "zh", "tur": "tr", "swe": "sv", "dan": "da", "fin": "fi",
    "ces": "cs", "cze": "cs", "ell": "el", "gre": "el", "hun": "hu",
}


def trigram_buckets(text: bytes) -> np.ndarray:
    """A bucket for each three neighbouring bytes, A-Z as a-z, with a space put before and after the text."""
    data = np.frombuffer(b" " + text + b" ", np.uint8)
    data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint32)
    codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return (codes * np.uint32(2654435761)) >> np.uint32(16)


def _counted(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        number = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found, n = np.unique(trigram_buckets((text or "").encode()), return_counts=True)
                counts[number[lang], found] += n
        rows, columns = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(columns.astype(np.int32)), pa.array(counts[rows, columns])], ["lang", "bucket", "n"]
        )

    return run


def train(labelled: DataFrame, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """The languages in order of name, and a table (bucket, language) of logarithms of smoothed probabilities.

    Its size depends on the number of languages only; more than MOST_LANGUAGES are an error. Rows without a language are
    left out, rows without a text teach nothing but the edges of one; repeated rows count each time.
    """
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).where("lang IS NOT NULL")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values")
    counts = np.ones((BUCKETS, len(languages)))
    if languages:
        summed = rows.mapInArrow(_counted(languages), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        found = summed.toPandas()
        counts[found["bucket"], found["lang"]] += found["n"]
    return languages, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _likelihood(table: np.ndarray, text: bytes) -> np.ndarray:
    buckets = trigram_buckets(text)
    pieces = (table[buckets[at : at + PIECE]] for at in range(0, len(buckets), PIECE))
    return sum((p.sum(axis=0, dtype=np.float64) for p in pieces), np.zeros(table.shape[1]))


def _likelihoods(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [_likelihood(table, t.encode()) if t else np.zeros(table.shape[1]) for t in batch.column("text").to_pylist()]
            likely = pa.array([s.tolist() for s in sums], pa.list_(pa.float64()))
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], likely], [*rest, "likely"])

    return run


def _smoothed(lists: Column, languages: list[str], own: Column) -> list[Column]:
    """Counts of each language in a list of (lang, n), less the record's own."""

    def count(name: str) -> Column:
        of = F.aggregate(F.coalesce(lists, F.array().cast("array<struct<lang:string,n:bigint>>")), F.lit(0).cast("long"), lambda a, x: a + F.when(x["lang"] == name, x["n"]).otherwise(0))
        return of - F.when(own == name, 1).otherwise(0)

    return [count(name) for name in languages]


def _counts_by(records: DataFrame, key: str, languages: list[str], out: str) -> DataFrame:
    counts = records.where(F.col("label").isin(languages) & F.col(key).isNotNull()).groupBy(key, F.col("label").alias("lang")).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.collect_list(F.struct("lang", "n")).alias(out))


def identify(records: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """records (id, text, declared, label, host) with lang, probability and text_lang added, text and label left out.

    declared is the language the record states, label what its host's prior may count of it (its statement, or a
    known language); either may be null, as may the text and the host. A record without any evidence gets the
    prior of all records; ties go to the first name. Without languages lang is null. Texts of any length are taken whole,
    repeated rows are records of their own, and other columns are not read. A host without a dot has no suffix.
    """
    kind = records.schema["id"].dataType.simpleString()
    suffix = F.when(F.contains("host", F.lit(".")), F.substring_index("host", ".", -1))
    known = records.select("id", "text", "declared", "label", "host", suffix.alias("suffix"))
    scored = known.mapInArrow(
        _likelihoods(table), f"id {kind}, declared string, label string, host string, suffix string, likely array<double>"
    )
    scored = stored(scored, "likelihoods")
    if not languages:
        return scored.select("id", "declared", "host", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"))
    hosts = sized(stored(_counts_by(scored, "host", languages, "of_host"), "hosts"), BROADCAST_ROWS)
    suffixes = sized(stored(_counts_by(scored, "suffix", languages, "of_suffix"), "suffixes"), BROADCAST_ROWS)
    named_label = F.when(F.col("label").isin(languages), F.col("label")).alias("label")
    totals = {r["label"]: r["count"] for r in scored.where("label IS NOT NULL").groupBy(named_label).count().collect()}
    whole = sum(totals.values())
    joined = scored.join(hosts, "host", "left").join(suffixes, "suffix", "left")
    n_host = _smoothed(F.col("of_host"), languages, F.when(F.col("host").isNotNull(), F.col("label")))
    n_suffix = _smoothed(F.col("of_suffix"), languages, F.when(F.col("suffix").isNotNull(), F.col("label")))
    joined = joined.withColumn("n_host", F.array(*n_host)).withColumn("n_suffix", F.array(*n_suffix))

    def total(name: str) -> Column:
        return F.aggregate(F.col(name), F.lit(0).cast("long"), lambda a, x: a + x)

    def told(stated: Column, name: str, right: float) -> Column:
        wrong = (1 - right) / max(len(languages) - 1, 1)
        return F.when(stated.isin(languages), F.log(F.when(stated == name, right).otherwise(wrong))).otherwise(0.0)

    national = F.coalesce(*[F.when(F.col("suffix") == s, F.lit(lang)) for lang, of in LANGUAGE_SUFFIXES.items() for s in of])
    scores = []
    for k, name in enumerate(languages):
        everywhere = (totals.get(name, 0) + 1.0) / (whole + len(languages))
        of_suffix = (F.get("n_suffix", F.lit(k)) + GLOBAL_WEIGHT * everywhere) / (total("n_suffix") + GLOBAL_WEIGHT)
        of_host = (F.get("n_host", F.lit(k)) + SUFFIX_WEIGHT * of_suffix) / (total("n_host") + SUFFIX_WEIGHT)
        text = TEMPER * F.get("likely", F.lit(k))
        scores.append(text + F.log(of_host) + told(F.col("declared"), name, DECLARED_RIGHT) + told(national, name, SUFFIX_RIGHT))
    named = F.array(*[F.lit(name) for name in languages])

    def first_greatest(values: Column) -> Column:
        return F.get(named, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    fused = joined.withColumn("score", F.array(*scores))
    most = F.array_max("score")
    spread = F.aggregate(F.col("score"), F.lit(0.0), lambda a, x: a + F.exp(x - most))
    return fused.select(
        "id",
        "declared",
        "host",
        first_greatest(F.col("score")).alias("lang"),
        (1.0 / spread).alias("probability"),
        F.when(F.array_max("likely") != F.array_min("likely"), first_greatest(F.col("likely"))).alias("text_lang"),
    )


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Records of web pages: text without markup, the language that the html element declares, the host of the address.

    A script, style, comment or tag that nothing closes goes to the end of the page, so a page is read through once. The
    declared language is the first part of its code, "pt" of "pt-BR", "fil" of "fil"; ISO's codes of three letters count
    as those of two where THREE_LETTERS has them. Null pages are empty, null and broken addresses have no host, repeated
    rows stay, other columns are not read.
    """
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    markup = "(?is)<(script|style)\\b.*?(?:</\\1\\s*>|\\z)|<!--.*?(?:-->|\\z)|</?[A-Za-z!?][^>]*(?:>|\\z)"
    text = F.regexp_replace(html, markup, " ")
    code = F.lower(F.regexp_extract(html, "(?i)<html\\b[^>]*\\blang\\s*=\\s*[\"']?([A-Za-z]{2,8})(?![A-Za-z])", 1))
    declared = F.coalesce(*[F.when(code == three, F.lit(two)) for three, two in THREE_LETTERS.items()], code)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    stated = F.nullif(declared, F.lit(""))
    return pages.select(
        F.col(f"`{id_col}`").alias("id"), text.alias("text"), stated.alias("declared"), stated.alias("label"), F.nullif(host, F.lit("")).alias("host")
    )
