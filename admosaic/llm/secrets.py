"""Secret scans weighed by ownership: how many repositories and owners hold the same value, over the whole corpus.

Spans come from patterns. Of the base kinds every span counts. The further kinds, which also fit harmless text, count
where their value is no example: a value that many owners hold was copied from some text, one that a single owner or
two hold looks live. Values leave a row only as SHA-256.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import document_keys, free_names, sized, stored

#: A value held by so many owners is an example.
EXAMPLE_OWNERS = 3
#: Rows with live spans that the join back to the texts may broadcast.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Kind:
    """head and body are regular expressions; the value is what body matches, the span both."""

    name: str
    head: str
    body: str
    least: int
    base: bool = True
    also: str = ""


# The patterns of each kind, in the order in which spans of one start are listed.
KINDS = (
    Kind("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]+", 6),
    Kind("access", "", "AKIA[A-Z0-9]{16,}", 20),
    Kind("hex", "", "[0-9a-f]{24,}", 24),
    Kind("vendor", "", "(?:gh[opsu]_|xox[abp]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}", 20, base=False),
    Kind("blob", "", "[A-Za-z0-9+/]{40,}", 40, base=False, also="(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"),
)
_SPAN = "array<struct<start:int,ord:int,end:int,value:string>>"
_MARK, _BODY = "\x01", "\x03"


def _spans(clean: Column, order: int, kind: Kind) -> Column:
    """Spans of one kind. Matches are put between marks, the text is cut at the marks, and the lengths of the pieces
    give the places, in characters; clean holds no marks of its own."""
    marked = F.regexp_replace(clean, f"({kind.head})({kind.body})", f"{_MARK}$1{_BODY}$2{_MARK}")

    def step(acc: Column, piece: Column) -> Column:
        match = F.contains(piece, F.lit(_BODY))
        value = F.substring_index(piece, _BODY, -1)
        end = acc["at"] + F.length(piece) - match.cast("int")
        good = match & (F.length(value) >= kind.least)
        if kind.also:
            good = good & value.rlike(kind.also)
        span = F.struct(acc["at"].alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.sha2(value, 256).alias("value"))
        return F.struct(end.alias("at"), F.when(good, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    found = F.aggregate(F.split(marked, _MARK), empty, step, lambda acc: acc["out"])
    return F.when(F.contains(marked, F.lit(_MARK)), found).otherwise(F.array().cast(_SPAN))


def candidate_spans(docs: DataFrame, id_col: str, text_col: str, owner_col: str | None, repo_col: str) -> DataFrame:
    """(row, id, owner, repo, spans): the spans of every kind in every row, by start and kind."""
    clean = F.regexp_replace(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "[\\x01-\\x03]", "\x04")
    owner = F.col(f"`{owner_col}`") if owner_col else F.lit(None)
    cleaned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        owner.cast("string").alias("owner"),
        F.col(f"`{repo_col}`").cast("string").alias("repo"),
        F.transform(
            F.array(clean),
            lambda c: F.sort_array(F.concat(*[_spans(c, k, kind) for k, kind in enumerate(KINDS)])),
        )[0].alias("spans"),
    )
    return cleaned


def ownership(found: DataFrame) -> DataFrame:
    """(value, owners, repos): by how many owners and repositories each value is held; a null one counts as one."""
    values = found.select("owner", "repo", F.explode("spans.value").alias("value"))
    owners = values.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("owners"))
    repos = values.select("value", "repo").distinct().groupBy("value").agg(F.count("*").alias("repos"))
    return owners.join(repos, "value")


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source", repo_col: str = "doc_id"
) -> DataFrame:
    """One row per document row: row (a number of this run), id, spans (start, ord, end, value, owners, repos, live).

    spans holds the base kinds and, of the further kinds, the values that are no examples. A span is live if fewer
    than EXAMPLE_OWNERS owners hold its value. Null and empty texts have no spans; repeated rows are one repository if
    their repo is the same; null owners are one owner, null repos one repository. Starts and ends count characters.
    """
    found = stored(candidate_spans(docs, id_col, text_col, owner_col, repo_col), "spans")
    held = ownership(found)
    base = len([k for k in KINDS if k.base])
    each = found.select("row", F.explode("spans").alias("s")).select("row", "s.*").join(held, "value")
    live = F.col("owners") < EXAMPLE_OWNERS
    kept = each.where((F.col("ord") < base) | live)
    lists = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "ord", "end", "value", "owners", "repos", live.alias("live")))).alias("judged")
    )
    none = "array<struct<start:int,ord:int,end:int,value:string,owners:bigint,repos:bigint,live:boolean>>"
    return found.select("row", "id").join(lists, "row", "left").select(
        "row", F.col("id").alias(id_col), F.coalesce("judged", F.array().cast(none)).alias("spans")
    )


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source", repo_col: str = "doc_id") -> DataFrame:
    """Counts, digest and list of the spans of every row, and how many of its spans are live and how many examples."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["ord"] < len([k for k in KINDS if k.base]))

    def count(order: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["ord"] == order)).cast("long")

    counts = [count(k).alias(f"n_{kind.name}") for k, kind in enumerate(KINDS) if kind.base]
    live = F.size(F.filter(spans, lambda s: s["live"])).cast("long")
    return secret_spans(docs, id_col, text_col, owner_col, repo_col).select(
        F.col(f"`{id_col}`"),
        *counts,
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(spans).alias("spans"),
        live.alias("n_live"),
        (F.size(spans) - live).alias("n_example"),
    )


def redacted(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str | None = "source",
    repo_col: str = "doc_id",
    length_col: str | None = None,
    filler: str = "[SECRET]",
) -> DataFrame:
    """The documents with every live span replaced by filler; examples and other columns stay. Overlapping spans are
    replaced together, once. length_col, if given and there, is set to the new length where the text has changed."""
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    k1, k2, at, new = free_names(docs, "k1", "k2", "live_spans", "new_text")
    narrow = docs.select(
        F.struct(*[k.alias(n) for k, n in zip(document_keys(text, doc_id), ("k1", "k2"), strict=True)]).alias("key"),
        text.alias("text"),
        (F.col(f"`{owner_col}`") if owner_col else F.lit(None)).alias("owner"),
        F.col(f"`{repo_col}`").alias("repo"),
    )
    judged = secret_spans(narrow, "key", "text", "owner", "repo")
    live = judged.select("key", F.filter("spans", lambda s: s["live"]).alias("live")).where(F.size("live") > 0)
    live = live.groupBy("key").agg(F.min("live").alias("live"))
    live = live.select(F.col("key.k1").alias(k1), F.col("key.k2").alias(k2), F.col("live").alias(at))
    cut = F.aggregate(
        F.col(at),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(filler)))
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    keys = document_keys(text, doc_id)
    joined = docs.join(sized(stored(live, "live"), BROADCAST_ROWS), (keys[0] == F.col(k1)) & (keys[1] == F.col(k2)), "left")
    joined = joined.withColumn(new, F.when(F.col(at).isNull(), text).otherwise(cut))
    changed = {text_col: F.col(new)}
    if length_col in docs.columns:
        length = F.length(new).cast(docs.schema[length_col].dataType)
        changed[length_col] = F.when(F.col(at).isNull(), F.col(f"`{length_col}`")).otherwise(length)
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])
