"""Quality rules: a table of thresholds compiled into one projection of counts and ratios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import spaced_words

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "was", "on", "are", "as", "by", "this", "a",
    "der", "die", "das", "und", "ist", "von", "zu", "den", "mit", "nicht", "ein", "eine", "auf", "für", "im", "es", "sich", "auch",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "est", "dans", "que", "pour", "pas", "sur", "avec", "au",
    "el", "los", "las", "y", "en", "una", "por", "con", "para", "se", "del", "al", "lo", "no", "su",
)


@dataclass(frozen=True)
class Rule:
    """Holds if part is at least low and at most high per cent of whole; None leaves that end open."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None


#: The thresholds, in per cent of whole numbers, so that every engine decides alike.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols_per_word", "n_symbols", "n_words", high=30),
    Rule("stop_words", "n_stop_words", "n_words", low=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90),
    Rule("repeated_words", "n_repeat_words", "n_words", high=50),
)
LEAST_WORDS = 50


def repeated_words(words: Column, windows: Column) -> Column:
    """Words inside a 3-word window that the text has twice or more. windows: one hash per start of a window."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.transform(
        F.array(placed),
        lambda p: F.transform(
            p,
            lambda x, j: F.when(
                ((j > 0) & (F.get(p, j - 1)["h"] == x["h"])) | F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        ),
    )[0]
    covered = F.aggregate(
        F.sort_array(F.array_compact(twice)),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(covered)




def quality_columns(docs: DataFrame, text_col: str = "text", prefix: str = "_q_") -> DataFrame:
    """Every row of docs with one struct column named prefix + "quality": the counts, the failed rules and the verdict.

    Counts are of the whole text; a null text has no words and no lines. Windows are told apart by 64-bit hashes of
    their three words, within one text. No row is joined or moved: repeated rows each get their own struct, an empty
    table stays empty, and other columns pass through untouched, whatever their names (only names that begin with
    the prefix are taken).
    """
    p = prefix
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    counted = (
        docs.withColumn(f"{p}w", spaced_words(F.col(f"`{text_col}`")))
        .withColumn(
            f"{p}h",
            F.transform(
                F.slice(F.col(f"{p}w"), F.lit(1), F.greatest(F.size(f"{p}w") - 2, F.lit(0))),
                lambda w, i: F.xxhash64(w, F.get(F.col(f"{p}w"), i + 1), F.get(F.col(f"{p}w"), i + 2)),
            ),
        )
        .withColumn(f"{p}l", F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    )
    words, lines = F.col(f"{p}w"), F.col(f"{p}l")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", "")),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike("^[\\x20\\x09-\\x0D]*[-*•]"))),
        "n_repeat_words": repeated_words(words, F.col(f"{p}h")),
    }
    out = counted.withColumn(f"{p}c", F.struct(*[v.cast("long").alias(k) for k, v in counts.items()]))

    def inside(rule: Rule) -> Column:
        c = F.col(f"{p}c")
        part, whole = 100 * c[rule.part], c[rule.whole]
        held = [part >= rule.low * whole] if rule.low is not None else []
        held += [part <= rule.high * whole] if rule.high is not None else []
        return held[0] & held[1] if len(held) == 2 else held[0]

    c = F.col(f"{p}c")
    failed = F.array_compact(F.array(*[F.when(~inside(r), F.lit(r.name)) for r in RULES]))
    base_failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    fields = [c[k].alias(k) for k in counts]
    out = out.withColumn(f"{p}f", failed)
    quality = F.struct(
        *fields,
        base_failed.alias("base_failed"),
        F.col(f"{p}f").alias("failed_rules"),
        (~base_failed & (F.size(f"{p}f") == 0)).alias("kept"),
    )
    return out.select(*[F.col(f"`{x}`") for x in docs.columns], quality.alias(f"{p}quality"))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the counts, the failed rules and the verdict."""
    rated = quality_columns(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), text_col)
    return rated.select(F.col(f"`{id_col}`"), "_q_quality.*")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents whose verdict is kept, with all their columns.

    Rows are dropped by exploding an empty list: a filter on the verdict would be pushed below the projections and
    work out every count once more for each place that names it.
    """
    rated = quality_columns(docs, text_col)
    once = F.when(F.col("_q_quality")["kept"], F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    columns = [F.col(f"`{x}`") for x in docs.columns]
    return rated.select(*columns, F.explode(once).alias("_q_once")).select(*columns)
