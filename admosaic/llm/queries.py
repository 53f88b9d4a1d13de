"""The registered queries of these operators, each over its whole table, and SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, checks
from .brown import perplexities
from .decontaminate import contamination
from .gray_index import near_copies
from .jaccard import similar_components
from .langid import identify, page_records, train
from .licenses import license_report
from .pii import PATTERNS, with_surrogates
from .quality import quality_report
from .resampling import resampled
from .secrets import secret_report
from .token_files import read_token_files, write_token_files
from .whitening import whitened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, and how many of them only few sources hold."""
    return secret_report(table(spark, sf_dir, "documents"))


def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded by the multilingual ranks and decoded again."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, failed rules and verdict of every document."""
    rated = quality_report(table(spark, sf_dir, "documents"))
    return rated.withColumn("failed_rules", rated["failed_rules"].cast("string"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page and every document.

    Likelihoods are learnt from the documents whose crc32(doc_id as text) is not 0 modulo 5. Documents declare nothing;
    their source is their host, and its prior counts the languages of the documents learnt from.
    """
    docs = table(spark, sf_dir, "documents")
    learnt = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    languages, likelihoods = train(docs.where(learnt), "text", "lang")
    none = F.lit(None).cast("string")
    label = F.when(learnt, F.col("lang"))
    texts = docs.select(F.col("doc_id").alias("id"), "text", none.alias("declared"), label.alias("label"), F.col("source").alias("host"))
    of_pages = identify(page_records(table(spark, sf_dir, "pages")), languages, likelihoods)
    of_texts = identify(texts, languages, likelihoods)
    columns = ["declared", "host", "lang", "probability", "text_lang"]
    no_id = F.lit(None).cast("long")
    return of_texts.select(F.col("id").alias("doc_id"), no_id.alias("page_id"), *columns).unionByName(
        of_pages.select(no_id.alias("doc_id"), F.col("id").alias("page_id"), *columns)
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item, and the items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "near_items",
    )


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under links of Jaccard similarity 0.9 on 3-word shingles."""
    found = similar_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-model and unigram scores of every document, learnt from those whose crc32 is not 2 modulo 7."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return perplexities(table(spark, sf_dir, "documents"), held_out)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from files of patched frame-of-reference blocks."""
    files = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), match_added=True)
    return read_token_files(files, digests=True)


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and statements of every document."""
    return license_report(table(spark, sf_dir, "documents"))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and how many entities of each kind it had."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = with_surrogates(docs, key="corpus")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x == kind)).cast("long").alias(f"n_{kind}")

    return done.select("doc_id", "text", *[count(kind) for kind, _ in PATTERNS])


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document towards the benchmark, and the rank of the tenth that is drawn."""
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on its 32 strongest components, whitened."""
    found = whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and its class under links of at most two different bits."""
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_secret_scans": op2_secret_scans,
    "op3_byte_level_bpe": op3_byte_level_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_files": op8_token_files,
    "op9_pii_surrogates": op9_pii_surrogates,
    "op10_license_scans": op10_license_scans,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": checks.NEAR_COPIES,
    "op2_secret_scans": checks.SECRETS,
    "op4_quality_rules": checks.QUALITY,
    "op6_benchmark_decontamination": checks.DECONTAMINATION,
    "op10_license_scans": checks.LICENSES,
    "op11_importance_resampling": checks.RESAMPLING,
}
