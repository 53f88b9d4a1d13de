"""Landed response pages: reading them and unwrapping their envelopes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import PAGE_SOURCES
from .base import Source, bound

RAW_PAGES = (
    "platform string, operation string, request_id string, page_no int, fetched_at timestamp, body string"
)
KEYS = ("platform", "operation", "request_id", "page_no", "fetched_at")


def page_path(file_path: Column, name: str) -> Column:
    """Value of a ``name=value`` directory in a file path, or NULL."""
    return F.nullif(F.regexp_extract(file_path, rf"/{name}=([^/]+)/", 1), F.lit(""))


def with_page_keys(files: DataFrame) -> DataFrame:
    """Page rows of a text scan of ``platform=/operation=/request_id=/…<page_no>.json`` files.

    Partition columns that the scan found are kept, so a filter on them prunes directories.
    """
    path = F.col("_metadata.file_path")

    def key(name: str) -> Column:
        return (F.col(name).cast("string") if name in files.columns else page_path(path, name)).alias(name)

    return files.select(
        key("platform"),
        key("operation"),
        key("request_id"),
        F.regexp_extract(path, r"([0-9]+)\.[a-z.]+$", 1).try_cast("int").alias("page_no"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
        F.col("value").alias("body"),
    )


def read_raw_pages(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """One row per landed page.

    ``text`` reads one file per page, keyed by its directories; ``json`` and ``parquet`` read compacted
    files that hold one `RAW_PAGES` row per page, the layout to prefer for many small pages.
    """
    if fmt == "text":
        return with_page_keys(spark.read.text(path, wholetext=True))
    return spark.read.format(fmt).schema(RAW_PAGES).load(path)


def _parsed(pages: DataFrame, source: Source) -> DataFrame:
    return pages.filter(F.col("platform") == source.name).select(
        *KEYS, "body", source.parsed(F.from_json("body", source.page)).alias("page")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _wanted(platforms: list[str] | None) -> list[Source]:
    return [PAGE_SOURCES[p] for p in (sorted(PAGE_SOURCES) if platforms is None else platforms)]


def unwrap_source(pages: DataFrame, platform: str) -> DataFrame:
    """One row per item of the pages of one source; error pages and pages that are no JSON give none.

    The outer explode keeps Spark from inferring a filter on the list, which would parse each page twice.
    """
    source = PAGE_SOURCES[platform]
    return (
        _parsed(pages, source)
        .select(*KEYS, source.items(F.col("page"), F.col("operation"), F.col("body")).alias("items"))
        .select(*KEYS, F.explode_outer("items").alias("item"))
        .filter(F.col("item").isNotNull())
    )


def unwrap_pages(pages: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """One row per item of every source, the item as JSON text.

    Each source filters on ``platform``; with pages stored by platform it reads its own files only.
    """
    return _union([unwrap_source(pages, source.name) for source in _wanted(platforms)])


def _start(body: Column) -> Column:
    """The first character of a body that is no white space of JSON."""
    return F.substring(F.ltrim(body, F.lit(" \t\r\n")), 1, 1)


def _object_or_list(body: Column) -> Column:
    """The body, NULL where it starts with a letter or tag: such texts have no fields, and a parser that fails on each
    takes longer than it does for a page."""
    return F.when(~F.coalesce(_start(body).rlike("[<A-Za-z]"), F.lit(False)), body)


def _well_formed(body: Column) -> Column:
    """Whether a body is JSON; texts that start as none can are not parsed."""
    other = F.coalesce(_start(body).rlike("[<A-HJ-MO-Za-eg-mo-su-z]"), F.lit(False))
    return body.isNotNull() & ~other & F.try_parse_json(F.when(~other, body)).isNotNull()


def _summary(source: Source) -> Column:
    """Counters of one page of a source; the page and its number of items are bound, so that it is parsed once."""

    def counted(page: Column) -> Column:
        found = source.items(page, F.col("operation"), F.col("body"))
        return bound(
            F.coalesce(F.size(found), F.lit(0)).cast("bigint"),
            lambda n: F.struct(
                n.alias("items"),
                F.coalesce(source.total(page), n).alias("total_count"),
                source.next_position(page).alias("next_position"),
                source.error(page).alias("error"),
            ),
        )

    return bound(source.parsed(F.from_json(_object_or_list(F.col("body")), source.page)), counted)


#: Where pages of a source without a module of its own may say what follows.
_ANY_PAGING = "next: string, next_token: string, next_page_token: string"


def _any_summary() -> Column:
    """Counters of a page of any other source: one item if it is JSON, and the usual names of a next position."""

    def counted(page: Column) -> Column:
        n = _well_formed(F.col("body"))
        paging = F.coalesce(page["paging"], page["pagination"])
        return F.struct(
            n.cast("bigint").alias("items"),
            n.cast("bigint").alias("total_count"),
            F.coalesce(paging["next"], paging["next_token"], paging["next_page_token"]).alias("next_position"),
            F.lit(None).cast("string").alias("error"),
        )

    parsed = F.from_json(_object_or_list(F.col("body")), f"paging struct<{_ANY_PAGING}>, pagination struct<{_ANY_PAGING}>")
    return bound(parsed, counted)


def page_counters(pages: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Per page: number of items, reported total, position of the next page, error message, and whether the page is
    well-formed and no error page.

    One pass over the pages of all sources, whatever their order in storage. A readable page of a source without a module
    of its own, or of none, counts as one item, as `normalize_unknown` maps it.
    """
    counters = None
    for source in _wanted(None if platforms is None else [p for p in platforms if p in PAGE_SOURCES]):
        here = F.col("platform") == source.name
        counters = F.when(here, _summary(source)) if counters is None else counters.when(here, _summary(source))
    counters = _any_summary() if counters is None else counters.otherwise(_any_summary())
    known = pages if platforms is None else pages.filter(F.col("platform").isin(*platforms))
    # Apart from the counters, so that those who do not ask for it are spared the second parse.
    is_json = _well_formed(F.col("body")).alias("json")
    counted = known.select(*KEYS, counters.alias("c"), is_json)
    return counted.select(*KEYS, "c.*", (F.col("json") & F.col("c.error").isNull()).alias("readable"))


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Landed pages, of any source, whose body is no JSON: truncated, an error text or nothing."""
    return pages.filter(F.try_parse_json("body").isNull())


def page_errors(pages: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Pages that carry an error message of their source."""
    return page_counters(pages, platforms).filter(F.col("error").isNotNull())


def apple_countries(pages: DataFrame) -> DataFrame:
    """Country dimension from landed pages of the apple ``countries`` operation."""
    items = unwrap_source(pages.filter(F.col("operation") == "countries"), "apple")
    return (
        items.select(F.from_json("item", "code string, name string").alias("c"))
        .select(
            F.col("c.code").alias("country_code"),
            F.col("c.name").alias("country_name"),
            F.lit("apple").alias("platform"),
        )
        .distinct()
    )
