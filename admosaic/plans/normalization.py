"""Queries: every source's pages normalised, all orders as ads of the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import normalize as N
from ..operators.advertisers import advertiser_pages
from ..schema import empty_ads
from ..sources.pages import apple_countries, unwrap_pages
from . import derived as D
from .compare import plain, plain_ads, sql_ads, sql_joined, sql_list, sql_pick, sql_time
from .derived_sql import FACETS, FETCHED, IMP_TEXT, REGION_CODES, SHARES, SPEND_TEXT, with_base


def _normalized(platform: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_ads(N.normalize_ads(D.pages_of(spark, sf_dir, platform), platforms=[platform]))

    return run


def _google(spark, sf_dir):
    return plain_ads(N.normalize_creatives(D.creatives(spark, sf_dir)))


def _missing_ids(spark, sf_dir):
    ads = N.normalize_creatives(D.creatives(spark, sf_dir, text=False, missing_ids=True))
    return plain(N.fill_missing_ids(ads).select("ad_id", "ad_library_url"))


def _generic(spark, sf_dir):
    items = D.items_of(spark, sf_dir, "meta").withColumn("fetched_at", F.timestamp_seconds(F.col("k")))
    ads = N.normalize_items(items, "elsewhere")
    raw_id = F.get_json_object("extra_json", "$.id").alias("raw_id")
    return plain(ads.select("platform", "ad_id", "media_type", "fetched_at", raw_id))


def _linkedin_flat(spark, sf_dir):
    flat = N.linkedin_flat(unwrap_pages(D.pages_of(spark, sf_dir, "linkedin"), ["linkedin"]))
    facets = F.transform(
        "ad_targeting", lambda t: F.concat_ws(":", t["facet_name"], F.array_join(t["included_segments"], ""))
    )
    countries = F.transform(
        "impressions_by_country", lambda i: F.concat_ws(":", i["country"], i["impression_percentage"].cast("string"))
    )
    return plain(flat.withColumns({"ad_targeting": facets, "impressions_by_country": countries}))


def _latest(spark, sf_dir):
    """Orders and the lines that repeat them: each ad once per line, fetched at the line's date."""
    orders = D.table(spark, sf_dir, "orders")
    lines = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("ad_id"),
        F.lit("meta").alias("platform"),
        F.col("l_shipdate").alias("fetched_at"),
    )
    return plain(N.latest_ads(N.conform_ads(rows)).select("platform", "ad_id", "fetched_at"))


def _conform(spark, sf_dir):
    """Orders with foreign types: a scalar for a list, text for a number, a date for a time."""
    c = F.col
    rows = D.table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("ad_id"),
        c("o_orderpriority").alias("countries"),
        F.when(c("o_orderstatus") == "O", "many").otherwise(c("o_custkey").cast("string")).alias("spend_low"),
        c("o_orderdate").cast("date").alias("first_seen"),
    )
    return plain(
        N.conform_ads(rows).select("ad_id", "countries", "spend_low", "first_seen", "platform", "languages")
    )


def _union(spark, sf_dir):
    """Ads of two sources with different columns, stacked."""
    ads = D.stored_ads(spark, sf_dir, lines=False)
    left = ads.select("platform", "ad_id", "media_type")
    right = D.creatives(spark, sf_dir, text=False).select(
        F.lit("google").alias("platform"), "ad_id", F.col("ad_url").alias("ad_library_url")
    )
    return plain(N.union_ads(empty_ads(spark).select("platform", "ad_id"), left, right))


def _advertisers(spark, sf_dir):
    return plain(advertiser_pages(D.advertiser_page_bodies(spark, sf_dir)))


def _apple_countries(spark, sf_dir):
    """Supplier and customer nations as landed country pages."""
    nation = D.table(spark, sf_dir, "nation")
    customer = D.table(spark, sf_dir, "customer")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("k"),
        F.to_json(
            F.struct(D.pick(D.NATION_CODES, F.col("n_nationkey")).alias("code"), F.col("n_name").alias("name"))
        ).alias("item"),
    )
    return apple_countries(D.as_pages(rows, "apple", "countries"))


def _select_fields(spark, sf_dir):
    ads = D.stored_ads(spark, sf_dir, lines=False)
    return N.select_fields(ads, ["ad_id", "advertiser_name", "status"])


QUERIES = {f"normalize_{p}": _normalized(p) for p in D.ITEMS} | {
    "normalize_google": _google,
    "normalize_generic": _generic,
    "missing_ids_numbered": _missing_ids,
    "linkedin_flat": _linkedin_flat,
    "latest_ads": _latest,
    "conform_ads": _conform,
    "union_ads": _union,
    "advertiser_payloads": _advertisers,
    "apple_countries": _apple_countries,
    "select_fields": _select_fields,
}


def _fallback(even: str, odd: str, n: int = 2) -> str:
    return f"CASE WHEN k % {n} = 0 THEN {even} ELSE {odd} END"


def _facet(name: str) -> str:
    return f"(SELECT list(f.segment) FROM facets f WHERE f.k = base.k AND f.facet = '{name}')"


_BOTH = "[c1, c2]"
_COMMON = {"ad_id": "ad_id", "first_seen": "d1", "last_seen": "d2", "fetched_at": FETCHED}
_WHO = {"advertiser_id": "cust", "advertiser_name": "name"}
_TARGETS = {"targeting_age": "ages", "targeting_gender": "genders", "targeting_locations": "regions"}
_IMAGE, _VIDEO, _LAND = (f"'https://{h}.example.com/' || ad_id" for h in ("image", "video", "land"))

_EXPECTED = {
    "amazon": {
        **_COMMON, **_TARGETS, "platform": "'amazon'", "advertiser_id": "cust",
        "advertiser_name": _fallback("name", "segment", 3), "ad_text": "ad_text",
        "media_type": _fallback("'video'", "'carousel'"), "countries": "[c1]", "spend_range": SPEND_TEXT,
    },
    "apple": {
        **_COMMON, **_WHO, **_TARGETS, "platform": "'apple'", "advertiser_type": "'app_developer'",
        "ad_text": _fallback("trim(segment || ' ' || ad_text)", "ad_text"),
        "media_type": "CASE WHEN k % 5 = 0 THEN 'video' WHEN k % 3 <> 0 THEN 'image' ELSE 'unknown' END",
        "media_urls": f"list_filter([CASE WHEN k % 3 <> 0 THEN {_IMAGE} END, CASE WHEN k % 5 = 0 THEN {_VIDEO} END], lambda u: u IS NOT NULL)",
        "countries": _BOTH, "targeting_interests": "[segment]",
    },
    "booking": {
        **_COMMON, "platform": "'booking'", "advertiser_name": "'Booking.com'",
        "advertiser_type": "'travel_platform'", "ad_text": _fallback("ad_text", "segment"),
        "media_type": _fallback("'image'", "'unknown'"), "countries": _BOTH,
    },
    "linkedin": {
        **_COMMON, **_WHO, "platform": "'linkedin'", "payer": "segment",
        "ad_library_url": "'https://www.linkedin.example.com/' || ad_id",
        "advertiser_url": "'https://www.linkedin.example.com/company/' || cust",
        "media_type": "CASE k % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'video' ELSE 'unknown' END",
        "countries": "(SELECT list(s.country) FROM shares s WHERE s.k = base.k)",
        "impressions_range": "CASE WHEN imp_max IS NOT NULL THEN format('{:,}', imp_min) || ' - ' || format('{:,}', imp_max) END",
        "impressions_low": "imp_min", "impressions_high": "imp_max", "targeting_age": _facet("Age"),
        "targeting_gender": _facet("Gender"), "targeting_locations": _facet("Location"),
    },
    "meta": {
        **_COMMON, **_WHO, "platform": "'meta'", "advertiser_verified": "k % 3 = 0", "payer": "name",
        "beneficiary": "segment", "ad_text": "ad_text || ', ' || segment",
        "ad_library_url": "'https://ads.example.com/' || ad_id", "media_type": _fallback("'image'", "'unknown'", 4),
        "media_urls": "['https://ads.example.com/' || ad_id]", "countries": _BOTH, "spend_range": SPEND_TEXT,
        "impressions_range": IMP_TEXT, "eu_reach": "CAST(n_lines * 100 AS VARCHAR)", "targeting_age": "ages",
        "targeting_gender": "['All']", "targeting_locations": "regions", "spend_low": "spend_min",
        "spend_high": "spend_max", "impressions_low": "imp_min", "impressions_high": "imp_max",
    },
    "microsoft": {
        **_COMMON, **_WHO, "platform": "'microsoft'", "ad_text": "trim(segment || ' ' || ad_text, ' ')",
        "ad_creative_urls": f"[{_IMAGE}]", "media_urls": f"[{_IMAGE}]",
        "media_type": "CASE k % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'video' ELSE 'unknown' END",
        "landing_url": _LAND, "countries": _BOTH, "impressions_range": IMP_TEXT, "targeting_other": "[prio]",
        "advertiser_url": "'https://show.example.com/' || cust",
    },
    "pinterest": {
        **_COMMON, **_WHO, **_TARGETS, "platform": "'pinterest'", "ad_text": _fallback("ad_text", "segment", 3),
        "media_type": "'image'", "media_urls": f"[{_IMAGE}]", "landing_url": _LAND, "countries": _BOTH,
        "targeting_interests": "[segment]", "targeting_behaviors": "[prio]",
    },
    "snapchat": {
        **_COMMON, **_TARGETS, "platform": "'snapchat'", "advertiser_name": _fallback("name", "segment"),
        "advertiser_type": _fallback("'political'", "'advocacy'", 3), "beneficiary": _fallback("segment", "NULL", 3),
        "media_type": "'video'", "countries": "[c1]",
        "spend_range": "CAST(coalesce(spend_min, 0) AS VARCHAR)", "impressions_range": "CAST(imp_min AS VARCHAR)",
    },
    "tiktok": {
        **_COMMON, **_WHO, "platform": "'tiktok'", "advertiser_verified": _fallback("k % 3 = 0", "NULL"),
        "status": _fallback("NULL", "status"), "ad_text": _fallback("ad_text", "NULL"), "media_type": "'video'",
        "media_urls": _fallback(f"[{_VIDEO}]", f"[{_VIDEO}, {_IMAGE}]"), "landing_url": _fallback(_LAND, "NULL"),
        "countries": _fallback(_BOTH, "CAST([] AS VARCHAR[])"),
        "impressions_range": _fallback("NULL", "n_lines || 'K'"), "targeting_age": "ages",
        "targeting_gender": "genders", "targeting_locations": _fallback("regions", "[c1]"),
        "targeting_interests": _fallback("[prio, segment]", "CAST([] AS VARCHAR[])"),
    },
    "x": {
        **_COMMON, **_WHO, **_TARGETS, "platform": "'x'", "advertiser_verified": "k % 3 = 0", "ad_text": "ad_text",
        "media_type": "CASE k % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'video' ELSE 'text' END",
        "media_urls": f"[{_IMAGE}]", "landing_url": _LAND, "countries": _BOTH, "spend_range": SPEND_TEXT,
        "targeting_interests": "[segment]",
    },
    "google": {
        **_COMMON, **_WHO, **_TARGETS, "platform": "'google'", "advertiser_type": "'political'", "ad_text": "ad_text",
        "ad_library_url": "'https://adstransparency.example.com/ad/' || ad_id", "media_type": "'unknown'",
        "countries": f"list_distinct({REGION_CODES})", "spend_range": SPEND_TEXT, "impressions_range": IMP_TEXT,
        "spend_low": "spend_min", "spend_high": "spend_max", "impressions_low": "imp_min", "impressions_high": "imp_max",
        "first_seen": "date_trunc('day', d1)", "last_seen": "date_trunc('day', d2)",
    },
}


def _expected(platform: str) -> str:
    source = "base WHERE k % 7 <> 6" if platform == "snapchat" else "base"
    select = sql_ads(source, **_EXPECTED[platform])
    if platform == "linkedin":
        return with_base(select).replace("WITH", f"WITH {SHARES.strip()},{FACETS},", 1)
    return with_base(select)


_NATION_CODE = sql_pick(D.NATION_CODES, "c_nationkey")
ORACLES = {f"normalize_{p}": _expected(p) for p in _EXPECTED} | {
    "normalize_generic": f"""
        SELECT 'elsewhere' AS platform, CAST(NULL AS VARCHAR) AS ad_id, 'unknown' AS media_type,
          {sql_time("make_timestamp(1970, 1, 1, 0, 0, 0) + to_seconds(o_orderkey)")} AS fetched_at,
          CAST(o_orderkey AS VARCHAR) AS raw_id
        FROM orders""",
    "missing_ids_numbered": with_base("""
        SELECT CASE WHEN prio <> '5-LOW' THEN ad_id
            ELSE 'google_' || row_number() OVER (PARTITION BY prio <> '5-LOW'
              ORDER BY cust, date_trunc('day', d1), 'https://adstransparency.example.com/ad/' || ad_id) END AS ad_id,
          'https://adstransparency.example.com/ad/' || ad_id AS ad_library_url
        FROM base"""),
    "linkedin_flat": with_base(f"""
        SELECT 'https://www.linkedin.example.com/' || ad_id AS ad_url, FALSE AS is_restricted,
          CAST(NULL AS VARCHAR) AS restriction_details, name AS advertiser_name,
          'https://www.linkedin.example.com/company/' || cust AS advertiser_url, segment AS ad_payer,
          {sql_pick(["SINGLE_IMAGE", "SPONSORED_VIDEO", "TEXT_AD"], "k % 3")} AS ad_type,
          {sql_time("d1 + to_hours(1)")} AS first_impression_at, {sql_time("d2")} AS latest_impression_at,
          imp_min AS total_impressions_from, imp_max AS total_impressions_to,
          {sql_joined("(SELECT list('urn:li:country:' || s.country || ':' || CAST(CAST(s.percentage AS DOUBLE) AS VARCHAR)) FROM shares s WHERE s.k = base.k)")} AS impressions_by_country,
          {sql_joined("(SELECT list(f.facet || ':' || f.segment) FROM facets f WHERE f.k = base.k)")} AS ad_targeting
        FROM base""").replace("WITH", f"WITH {SHARES.strip()},{FACETS},", 1),
    "latest_ads": f"""
        SELECT 'meta' AS platform, CAST(l_orderkey AS VARCHAR) AS ad_id, {sql_time("max(l_shipdate)")} AS fetched_at
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey""",
    "conform_ads": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, o_orderpriority AS countries,
          CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS spend_low, {sql_time("date_trunc('day', o_orderdate)")} AS first_seen,
          CAST(NULL AS VARCHAR) AS platform, '' AS languages
        FROM orders""",
    "union_ads": with_base(f"""
        SELECT platform, ad_id, {sql_pick(D.MEDIA, "k % 4")} AS media_type, CAST(NULL AS VARCHAR) AS ad_library_url FROM base
        UNION ALL
        SELECT 'google', ad_id, NULL, 'https://adstransparency.example.com/ad/' || ad_id FROM base"""),
    "advertiser_payloads": f"""
        WITH c AS (SELECT *, CAST(c_custkey AS VARCHAR) AS id, {_NATION_CODE} AS code FROM customer)
        SELECT 'apple' AS platform, id AS advertiser_id, c_name AS advertiser_name, 'DEVELOPER' AS entity_type,
          code AS country_code, CAST(NULL AS VARCHAR) AS advertiser_url, CAST(NULL AS VARCHAR) AS verified_advertiser_id,
          CAST(NULL AS BOOLEAN) AS verified, CAST(NULL AS VARCHAR) AS industry FROM c
        UNION ALL SELECT 'linkedin', 'urn:li:company:' || id, c_name, NULL, NULL, 'https://www.example.com/' || id, NULL, NULL, NULL FROM c
        UNION ALL SELECT 'microsoft', id, c_name, NULL, NULL, NULL, CASE WHEN c_custkey % 3 = 0 THEN 'v' || id END, NULL, NULL FROM c
        UNION ALL SELECT 'tiktok', id, c_name, NULL, NULL, NULL, NULL, c_custkey % 2 = 0, c_mktsegment FROM c""",
    "apple_countries": f"""
        SELECT DISTINCT {_NATION_CODE} AS country_code, n_name AS country_name, 'apple' AS platform
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "select_fields": with_base("SELECT ad_id, name AS advertiser_name, status FROM base"),
}

__all__ = ["ORACLES", "QUERIES", "sql_list"]
