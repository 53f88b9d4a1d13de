"""Queries: column jobs on whole columns of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import countries as C
from ..functions import dates, linkedin, media, ranges, text
from . import derived as D
from .compare import plain, sql_joined, sql_list, sql_pick, sql_time
from .derived_sql import BASE, FACETS, IMP_TEXT, REGION_CODES, SPEND_TEXT, with_base

c = F.col


def _clean_text(spark, sf_dir):
    """Whole documents cleaned; the result is compared by digest."""
    documents = D.table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        F.md5(text.clean_text(c("text"), encode_spaces=False)).alias("cleaned"),
        F.md5(text.clean_text(c("text"))).alias("encoded"),
    )


def _percent_encode(spark, sf_dir):
    return D.table(spark, sf_dir, "pages").select("page_id", text.percent_encode(c("url")).alias("encoded"))


def _ids(spark, sf_dir):
    return D.table(spark, sf_dir, "pages").select("page_id", text.id_from_url(c("url")).alias("id"))


def _dates(spark, sf_dir):
    """Order dates in every form a source may send, read back."""
    millis = F.unix_millis("o_orderdate")
    written = (
        F.when(c("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(c("o_orderkey") % 5 == 1, (millis + 1_000_000_000_000).cast("string"))
        .when(c("o_orderkey") % 5 == 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(c("o_orderkey") % 5 == 3, (F.floor(millis / 1000) + 1_000_000_000).cast("string"))
        .otherwise(F.lit("not a date"))
    )
    day = c("o_orderdate").cast("date")
    return plain(
        D.table(spark, sf_dir, "orders").select(
            "o_orderkey",
            dates.parse_datetime(written).alias("parsed"),
            dates.format_day(day).alias("iso"),
            dates.format_day(day, "epoch").alias("epoch"),
            dates.format_day(day, "custom", "apple").alias("custom"),
        )
    )


def _presets(spark, sf_dir):
    b = D.base(spark, sf_dir)
    first, last = c("d1").cast("date"), c("d2").cast("date")
    return b.select(
        "k",
        dates.date_preset(first, last).alias("preset"),
        dates.date_preset(F.lit(None).cast("date"), last).alias("open_preset"),
        F.date_format(dates.day_start(first), "yyyy-MM-dd HH:mm:ss").alias("day_start"),
        F.date_format(dates.day_end(last), "yyyy-MM-dd HH:mm:ss").alias("day_end"),
    )


def _ranges(spark, sf_dir):
    """Range texts of the bounds of every order, and the bounds read back from them."""
    b = D.base(spark, sf_dir).select(
        "k",
        ranges.spend_range_text(c("spend_min"), c("spend_max")).alias("spend"),
        ranges.impressions_range_text(c("imp_min"), c("imp_max")).alias("impressions"),
        F.to_json(
            F.struct(c("spend_min").cast("string").alias("lower_bound"), c("spend_max").alias("upper_bound"))
        ).alias("object"),
    )
    return b.select(
        "k", "spend", "impressions",
        ranges.range_low(c("spend")).alias("spend_low"), ranges.range_high(c("spend")).alias("spend_high"),
        ranges.range_low(c("impressions")).alias("imp_low"), ranges.range_high(c("impressions")).alias("imp_high"),
        ranges.spend_from_payload(c("object")).alias("from_object"),
    )


def _region_codes(spark, sf_dir):
    b = D.base(spark, sf_dir, lines=False)
    return b.select("k", F.array_join(C.regions_to_countries(c("regions")), ",").alias("codes"))


def _messy_codes():
    """Country codes of an order with stray cases, blanks and names."""
    return F.array(
        F.concat(F.lit(" "), F.lower("c1")), "c2", F.lit(""),
        F.when(c("k") % 3 == 0, F.element_at("regions", 1)).otherwise(F.lit("xx")),
    )


def _clean_countries(spark, sf_dir):
    b = D.base(spark, sf_dir, lines=False).select("k", _messy_codes().alias("codes"))
    return b.select(
        "k",
        F.array_join(C.clean_country_codes(c("codes")), ",").alias("kept"),
        F.array_join(C.rejected_country_codes(c("codes")), ",").alias("rejected"),
    )


def _country_numbers(spark, sf_dir):
    b = D.base(spark, sf_dir, lines=False).select("k", F.array("c1", "c2").alias("codes"))
    numbers = C.countries_to_numbers(c("codes"))
    return b.select(
        "k",
        F.array_join(numbers.cast("array<string>"), ",").alias("numbers"),
        F.array_join(C.countries_without_number(c("codes")), ",").alias("unsupported"),
        C.number_to_country((c("k") % 100).cast("int")).alias("back"),
    )


def _supported(spark, sf_dir):
    b = D.base(spark, sf_dir, lines=False)
    codes = F.array("c1", "c2")
    return b.select(
        "k",
        C.first_supported(codes, C.EU_COUNTRIES, "DE").alias("eu"),
        C.first_supported(codes, ["US", "CA", "GB", "UK"], "US").alias("american"),
    )


def _collapse(spark, sf_dir):
    """Facets of an order's lines and its targeting, joined and cut."""
    b = D.base(spark, sf_dir)
    flags = F.transform("flags", lambda f: F.concat_ws("-", f["l_returnflag"], f["l_linestatus"]))
    items = F.array_sort(F.coalesce(flags, F.array().cast("array<string>")))
    nested = F.array(items, F.array(F.lit(None).cast("string"), F.lit("")), c("genders"))
    return b.select(
        "k",
        text.collapse_list(items).alias("five"),
        text.collapse_list(c("ages"), sep="; ", max_items=1).alias("one"),
        text.collapse_lists(nested, max_items=3).alias("nested"),
    )


def _linkedin_params(spark, sf_dir):
    b = D.base(spark, sf_dir)
    codes = F.when(
        c("k") % 4 != 0, F.array(F.lower("c1"), F.concat(F.lit(" "), c("c2")), F.lit("  "))
    ).otherwise(F.array(F.lit("  ")))
    end = F.when(c("k") % 5 == 0, F.lit("invalid-date")).when(c("k") % 5 != 1, F.date_format("d2", "yyyy-MM-dd"))
    start = F.date_format("d1", "yyyy-MM-dd")
    return b.select(
        "k",
        linkedin.countries_param(codes).alias("countries"),
        linkedin.daterange_param(start, end).alias("dates"),
        linkedin.daterange_error(start, end).alias("error"),
    )


def _urns(spark, sf_dir):
    """Countries without their prefix and the segments of facets named by part, from whole targeting lists."""
    b = D.base(spark, sf_dir)
    urns = F.array(F.concat(F.lit("urn:li:country:"), "c1"), F.lit("urn:li:country:"), c("c2"))
    targeting = F.transform(
        "flags",
        lambda f: F.struct(
            F.when(f["l_returnflag"] == "A", "Member Age").when(f["l_returnflag"] == "N", "gender").otherwise("LOCATION")
            .alias("facetName"),
            F.array(f["l_linestatus"], F.lit(None).cast("string")).alias("includedSegments"),
        ),
    )
    return b.select(
        "k",
        F.array_join(linkedin.strip_country_urn(urns), ",").alias("codes"),
        F.array_join(F.array_sort(linkedin.facet_segments(targeting, ["Age", "Gender"])), ",").alias("segments"),
    )


def _media_types(spark, sf_dir):
    """Every media-type rule over part types and sizes."""
    part = D.table(spark, sf_dir, "part")
    k = c("p_partkey")
    assets = F.array(
        F.when(k % 3 == 0, "ImageAsset").otherwise("Text"), F.when(k % 5 == 0, "VideoAsset").otherwise("Text")
    )
    kinds = F.array(F.when(k % 7 == 0, "video").otherwise("animated"), F.when(k % 2 == 0, "photo").otherwise("poll"))
    video = F.array(F.when(k % 4 == 0, "v").otherwise(""))
    image = F.array(F.when(k % 3 == 0, "i").otherwise(""))
    return part.select(
        "p_partkey",
        media.media_type_from_assets(assets).alias("from_assets"),
        media.media_type_from_format(F.concat(F.lower("p_type"), F.when(k % 2 == 0, "_Video_ad").otherwise("-image"))).alias(
            "from_format"
        ),
        media.media_type_from_media(kinds).alias("from_media"),
        media.media_type_from_urls(video, image).alias("from_urls"),
        media.media_type_by_name(F.when(k % 2 == 0, " Carousel"), c("p_type")).alias("by_name"),
        F.array_join(media.collect_urls(image, video), ",").alias("urls"),
        text.join_text_parts([c("p_type"), F.when(k % 2 == 0, c("p_name"))]).alias("joined"),
        text.join_text_parts([F.when(k % 2 == 0, F.lit("")), F.lit(None).cast("string")]).alias("nothing"),
    )


def _paths(spark, sf_dir):
    events = D.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        text.extract_path(c("props"), "$.k").alias("k"),
        text.extract_path(c("props"), "$.a.b", c("event_type")).alias("default"),
    )


def _set_operations(spark, sf_dir):
    """Set operations on the country lists of an order, and distinct, common and missing country rows."""
    b = D.base(spark, sf_dir, lines=False)
    first, second = F.array("c1", "c2", "c1"), F.array("c2", F.lit("DE"), F.lit("XX"))
    return b.select(
        "k",
        F.array_join(F.array_distinct(first), ",").alias("once"),
        F.array_join(F.array_intersect(first, second), ",").alias("both"),
        F.array_join(F.array_except(first, second), ",").alias("rest"),
    )


QUERIES = {
    "clean_text": _clean_text,
    "percent_encode": _percent_encode,
    "id_from_url": _ids,
    "dates": _dates,
    "date_presets": _presets,
    "ranges": _ranges,
    "regions_to_countries": _region_codes,
    "clean_countries": _clean_countries,
    "country_codes": _country_numbers,
    "supported_countries": _supported,
    "collapse_lists": _collapse,
    "linkedin_params": _linkedin_params,
    "linkedin_urns_facets": _urns,
    "media_types": _media_types,
    "extract_path": _paths,
    "set_operations": _set_operations,
}

_BLANKS = r"\s+"
_CLEANED = rf"regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '{_BLANKS}', ' ', 'g')"
_NUMBER_MAP = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in C.COUNTRY_TO_NUMBER.items()) + "}"
_BACK_MAP = "MAP {" + ", ".join(f"{v}: '{k}'" for k, v in C.COUNTRY_TO_NUMBER.items()) + "}"
_EU = sql_list(C.EU_COUNTRIES)
_MESSY = "[upper(c1), c2, CASE WHEN k % 3 = 0 THEN upper(regions[1]) ELSE 'XX' END]"


def _first_of(allowed: str, fallback: str) -> str:
    return (
        f"CASE WHEN list_contains({allowed}, c1) THEN c1 WHEN list_contains({allowed}, c2) THEN c2 ELSE '{fallback}' END"
    )


_FLAGS = """
flags AS (SELECT DISTINCT l_orderkey AS fk, l_returnflag AS flag, l_linestatus AS line FROM lineitem),
listed AS (
  SELECT fk, list_sort(list(flag || '-' || line)) AS items,
    list_sort(list(line) FILTER (flag IN ('A', 'N'))) AS segments
  FROM flags GROUP BY fk
)"""
_ITEMS = "coalesce(items, [])"

ORACLES = {
    "clean_text": f"""SELECT doc_id, md5({_CLEANED}) AS cleaned, md5(replace({_CLEANED}, ' ', '%20')) AS encoded
        FROM documents""",
    "percent_encode": "SELECT page_id, url_encode(url) AS encoded FROM pages",
    "id_from_url": "SELECT page_id, nullif(regexp_extract(url, '([0-9]+)$', 1), '') AS id FROM pages",
    "dates": f"""
        SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN {sql_time('o_orderdate')} WHEN 2 THEN {sql_time('o_orderdate')}
            WHEN 1 THEN {sql_time('make_timestamp((epoch_ms(o_orderdate) + 1000000000000) * 1000)')}
            WHEN 3 THEN {sql_time('make_timestamp((epoch_ms(o_orderdate) // 1000 + 1000000000) * 1000000)')} END AS parsed,
          strftime(o_orderdate, '%Y-%m-%d') AS iso, CAST(epoch_ms(o_orderdate) AS VARCHAR) AS epoch, 'LAST_90_DAYS' AS custom
        FROM orders""",
    "date_presets": with_base(
        """SELECT k, CASE WHEN date_diff('day', d1, d2) <= 90 THEN 'LAST_90_DAYS' WHEN date_diff('day', d1, d2) <= 180
            THEN 'LAST_180_DAYS' ELSE 'LAST_YEAR' END AS preset, 'LAST_90_DAYS' AS open_preset,
          strftime(d1, '%Y-%m-%d 00:00:00') AS day_start, strftime(d2, '%Y-%m-%d 23:59:59') AS day_end
        FROM base"""
    ),
    "ranges": with_base(
        f"""SELECT k, {SPEND_TEXT} AS spend, {IMP_TEXT} AS impressions, spend_min AS spend_low, spend_max AS spend_high,
          imp_min AS imp_low, imp_max AS imp_high, {SPEND_TEXT} AS from_object FROM base"""
    ),
    "regions_to_countries": with_base(
        f"""SELECT k, CASE WHEN r[1] = r[2] THEN r[1] ELSE r[1] || ',' || r[2] END AS codes
        FROM (SELECT k, {REGION_CODES} AS r FROM base)"""
    ),
    "clean_countries": with_base(
        f"""SELECT k, array_to_string(list_filter({_MESSY}, lambda x: regexp_full_match(x, '[A-Z][A-Z]')), ',') AS kept,
          array_to_string(list_filter({_MESSY}, lambda x: NOT regexp_full_match(x, '[A-Z][A-Z]')), ',') AS rejected
        FROM base"""
    ),
    "country_codes": with_base(
        f"""SELECT k,
          array_to_string(list_filter([{_NUMBER_MAP}[c1], {_NUMBER_MAP}[c2]], lambda x: x IS NOT NULL), ',') AS numbers,
          array_to_string(list_filter(CASE WHEN c1 = c2 THEN [c1] ELSE [c1, c2] END,
            lambda x: {_NUMBER_MAP}[x] IS NULL), ',') AS unsupported,
          coalesce({_BACK_MAP}[CAST(k % 100 AS INTEGER)], CAST(k % 100 AS VARCHAR)) AS back
        FROM base"""
    ),
    "supported_countries": with_base(
        f"SELECT k, {_first_of(_EU, 'DE')} AS eu, {_first_of(sql_list(['US', 'CA', 'GB', 'UK']), 'US')} AS american FROM base"
    ),
    "collapse_lists": f"""WITH {_FLAGS.strip()},{BASE}
        SELECT k,
          CASE WHEN len({_ITEMS}) > 5 THEN array_to_string(items[1:5], ', ') || ', ...'
            WHEN len({_ITEMS}) > 0 THEN array_to_string(items, ', ') END AS five,
          CASE WHEN len(ages) > 1 THEN ages[1] || '; ...' WHEN len(ages) = 1 THEN ages[1] END AS one,
          CASE WHEN len({_ITEMS} || genders) > 3 THEN array_to_string(({_ITEMS} || genders)[1:3], ', ') || ', ...'
            WHEN len({_ITEMS} || genders) > 0 THEN array_to_string({_ITEMS} || genders, ', ') END AS nested
        FROM base LEFT JOIN listed ON fk = k""",
    "linkedin_params": with_base(
        """SELECT k, CASE WHEN k % 4 <> 0 THEN '(value:List(urn%3Ali%3Acountry%3A' || c1 || ',urn%3Ali%3Acountry%3A' || c2 || '))'
            END AS countries,
          CASE WHEN k % 5 > 1 THEN '(start:(day:' || day(d1) || ',month:' || month(d1) || ',year:' || year(d1)
            || '),end:(day:' || day(d2) || ',month:' || month(d2) || ',year:' || year(d2) || '))' END AS dates,
          CASE WHEN k % 5 = 0 THEN 'Invalid date format' END AS error
        FROM base"""
    ),
    "linkedin_urns_facets": f"""WITH {_FLAGS.strip()},{BASE}
        SELECT k, c1 || ',' || c2 AS codes,
          CASE WHEN items IS NOT NULL THEN coalesce(array_to_string(segments, ','), '') END AS segments
        FROM base LEFT JOIN listed ON fk = k""",
    "media_types": """
        SELECT p_partkey,
          CASE WHEN p_partkey % 3 = 0 THEN 'image' WHEN p_partkey % 5 = 0 THEN 'video' ELSE 'unknown' END AS from_assets,
          CASE WHEN p_partkey % 2 = 0 THEN 'video' ELSE 'image' END AS from_format,
          CASE WHEN p_partkey % 7 = 0 THEN 'video' WHEN p_partkey % 2 = 0 THEN 'image' ELSE 'text' END AS from_media,
          CASE WHEN p_partkey % 4 = 0 THEN 'video' WHEN p_partkey % 3 = 0 THEN 'image' ELSE 'unknown' END AS from_urls,
          CASE WHEN p_partkey % 2 = 0 THEN 'carousel' ELSE 'unknown' END AS by_name,
          concat_ws(',', CASE WHEN p_partkey % 3 = 0 THEN 'i' END, CASE WHEN p_partkey % 4 = 0 THEN 'v' END) AS urls,
          concat_ws(' ', p_type, CASE WHEN p_partkey % 2 = 0 THEN p_name END) AS joined, CAST(NULL AS VARCHAR) AS nothing
        FROM part""",
    "extract_path": """
        SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS "default" FROM events""",
    "set_operations": with_base(
        """SELECT k, CASE WHEN c1 = c2 THEN c1 ELSE c1 || ',' || c2 END AS once,
          CASE WHEN c1 = c2 THEN c1 WHEN c1 = 'DE' THEN c1 || ',' || c2 ELSE c2 END AS both,
          CASE WHEN c1 = c2 OR c1 = 'DE' THEN '' ELSE c1 END AS rest
        FROM base"""
    ),
}

__all__ = ["FACETS", "ORACLES", "QUERIES", "sql_joined", "sql_pick"]
