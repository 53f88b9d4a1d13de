"""Queries: ad search with each kind of condition, batch search, lookups and advertisers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.countries import EU_COUNTRIES
from ..operators import search as S
from ..operators.storage import shared_folder
from ..sources.tables import save_ads_by_id
from . import derived as D
from .compare import plain, sql_list, sql_pick, sql_time
from .derived_sql import with_ads

_COLUMNS = ("ad_id", "platform", "advertiser_name", "first_seen")


def _short(found: DataFrame) -> DataFrame:
    return plain(found.select(*_COLUMNS))


def _find(text: bool = False, **request):
    def run(spark, sf_dir):
        return _short(S.find_ads(D.stored_ads(spark, sf_dir, text=text), **request))

    return run


def _top(spark, sf_dir):
    return _short(S.search_ads(D.stored_ads(spark, sf_dir), "google", date_from="1996-01-01", limit=1000))


def _limit_kept(spark, sf_dir):
    """More rows than the source's own service would send at once."""
    return _short(S.search_ads(D.stored_ads(spark, sf_dir), "meta", date_from="1996-01-01", limit=900))


def _page(spark, sf_dir):
    return _short(S.search_ads(D.stored_ads(spark, sf_dir), "x", limit=40, page_token=20))


def _page_deep(spark, sf_dir):
    """A page far down all ads, found by counts."""
    return _short(S.page_of_results(D.stored_ads(spark, sf_dir, lines=False), 60, 10_500))


def _page_after(spark, sf_dir):
    return _short(S.page_after(D.stored_ads(spark, sf_dir), 50, "1999-06-01", "500"))


def _batch(spark, sf_dir):
    requests = D.requests(spark, sf_dir)
    found = S.search_ads_batch(D.stored_ads(spark, sf_dir, text=True), requests)
    return plain(found.select("request_id", "ad_id", "platform", "first_seen"))


def _batch_counts(spark, sf_dir):
    """How many ads match each request, without the bound on rows."""
    return S.match_counts(D.stored_ads(spark, sf_dir, text=True), D.requests(spark, sf_dir))


def _batch_pages(spark, sf_dir):
    """Requests of which a third asks for the second page and another third has a page token that is no number."""
    requests = D.requests(spark, sf_dir)
    k = F.substring("request_id", 2, 20).cast("bigint")
    requests = requests.withColumn("page_token", F.when(k % 3 == 0, "abc").when(k % 3 == 1, " 20 "))
    found = S.search_ads_batch(D.stored_ads(spark, sf_dir, text=True), requests)
    return plain(found.select("request_id", "ad_id", "platform", "first_seen"))


def _batch_dates(spark, sf_dir):
    """How many ads match each request when nothing but its dates counts."""
    requests = D.requests(spark, sf_dir).withColumns({
        **{name: F.lit(None).cast("string") for name in ("keyword", "media")},
        **{name: F.lit(None).cast("array<string>") for name in ("advertisers", "countries", "types", "languages")},
    }).where("date_from IS NOT NULL OR date_to IS NOT NULL")
    return S.match_counts(D.stored_ads(spark, sf_dir), requests)


def _wanted_ids(spark, sf_dir):
    c = F.col
    return D.table(spark, sf_dir, "events").select(
        (c("event_id") * 2).cast("string").alias("ad_id"), c("event_id").alias("position")
    )


def _details(spark, sf_dir):
    found = S.ad_details(D.stored_ads(spark, sf_dir, lines=False), _wanted_ids(spark, sf_dir))
    return plain(found.select("position", "ad_id", "platform", "status"))


def _details_by_bucket(spark, sf_dir):
    """`ad_details` of a table saved in buckets of the ad's id."""
    name = f"ads_{uuid.uuid4().hex}"
    save_ads_by_id(D.stored_ads(spark, sf_dir, lines=False), name, buckets=16, path=f"{shared_folder(spark)}/{name}")
    found = S.ad_details(spark.table(name), _wanted_ids(spark, sf_dir))
    return plain(found.select("position", "ad_id", "platform", "status"))


def _missing(spark, sf_dir):
    return S.missing_ids(D.stored_ads(spark, sf_dir, lines=False), _wanted_ids(spark, sf_dir))


def _advertisers(spark, sf_dir):
    return plain(S.search_advertisers(D.stored_ads(spark, sf_dir), limit=None))


def _advertisers_named(spark, sf_dir):
    return plain(S.search_advertisers(D.stored_ads(spark, sf_dir), q="r#00000", date_from="1997-01-01", limit=100))


QUERIES = {
    "search_keyword": _find(platform="google", q="of_the", text=True),
    "search_all_terms": _find(platform="linkedin", q="  The OF  and", text=True),
    "search_substring": _find(platform="meta", q="Offer 2-", text=True),
    "search_advertiser": _find(platform="tiktok", advertisers=["Customer#00000001", "77", "cust0"]),
    "search_advertiser_like": _find(platform="google", advertisers=["#%7_"]),
    "search_countries": _find(platform="microsoft", countries=["us", "DE", "fr "]),
    "search_first_country": _find(platform="amazon", countries=["US", "FR", "DE"]),
    "search_default_country": _find(platform="meta", platform_defaults=True),
    "search_country_fallback": _find(platform="amazon", countries=["US"], platform_defaults=True),
    "search_dates_contained": _find(platform="google", date_from="1996-03-01", date_to="1999-06-30"),
    "search_dates_served": _find(platform="linkedin", date_from="1997-01-01", date_to="1998-01-01"),
    "search_dates_overlap": _find(platform="snapchat", date_from="1997-01-01", date_to="1998-01-01"),
    "search_date_preset": _find(platform="apple", date_from="2001-02-01", date_to="2001-06-30", use_date_preset=True),
    "search_types": _find(platform="meta", types=["HOUSING_ADS", "OTHER_ADS"]),
    "search_types_other": _find(platform="x", types=["OTHER_ADS"]),
    "search_languages": _find(platform="pinterest", languages=["fr", "DE"], text=True),
    "search_media": _find(platform="booking", media="IMAGE"),
    "search_status": _find(platform="snapchat", platform_defaults=True),
    "search_top": _top,
    "search_limit_kept": _limit_kept,
    "search_page": _page,
    "search_page_after": _page_after,
    "search_page_deep": _page_deep,
    "search_batch": _batch,
    "search_batch_counts": _batch_counts,
    "search_batch_pages": _batch_pages,
    "search_batch_dates": _batch_dates,
    "ad_details": _details,
    "ad_details_bucketed": _details_by_bucket,
    "missing_ids": _missing,
    "advertisers": _advertisers,
    "advertisers_named": _advertisers_named,
}

_OUT = f"SELECT ad_id, platform, advertiser_name, {sql_time('first_seen')} AS first_seen FROM ads"


def _where(condition: str) -> str:
    return with_ads(f"{_OUT} WHERE {condition}")


_EU = sql_list(EU_COUNTRIES)
_CODE = sql_pick(D.NATION_CODES, "c_nationkey")
_NAMES = sql_list([*D.PLATFORMS, " Meta ", "myspace"])

# Requests with the rules of their platform applied.
_ASKED = f"""
raw AS (
  SELECT c_custkey AS q, 'r' || c_custkey AS request_id,
    lower(trim({_NAMES}[CAST(c_custkey % 13 AS BIGINT) + 1])) AS platform,
    CASE c_custkey % 5 WHEN 0 THEN 'the' WHEN 1 THEN 'of the' WHEN 3 THEN 'offer' WHEN 4 THEN 'in' END AS keyword,
    CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN 'Customer#0000001' END AS who,
    CASE WHEN c_custkey % 3 = 0 THEN [{_CODE}] WHEN c_custkey % 3 = 1 THEN [{_CODE}, 'FR']
      WHEN c_custkey % 7 = 0 THEN [{_CODE}] END AS codes,
    CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 2 = 0
      THEN DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) END AS d_from,
    CASE WHEN c_custkey % 2 = 0 THEN DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER)
      + CAST(floor(c_acctbal / 50) AS INTEGER) END AS d_to,
    CASE WHEN c_custkey % 6 = 0 THEN {sql_pick(D.AD_TYPES, 'c_custkey % 5')} END AS kind,
    c_custkey % 8 = 0 AS images,
    CAST(floor(c_acctbal / 8) AS INTEGER) AS lim
  FROM customer
),
asked AS (
  SELECT * REPLACE (
    CASE WHEN platform = 'amazon' AND len(list_filter(codes, lambda x: list_contains({_EU}, x))) > 0
        THEN list_filter(codes, lambda x: list_contains({_EU}, x))[1:1]
      WHEN platform IN ('amazon', 'booking', 'pinterest', 'tiktok', 'x') THEN codes[1:1] ELSE codes END AS codes,
    CASE WHEN platform = 'meta' AND kind = 'OTHER_ADS' THEN NULL ELSE kind END AS kind,
    lim AS lim)
  FROM raw WHERE q % 11 <> 0
),
pairs AS (
  SELECT request_id, ads.ad_id, ads.platform, ads.first_seen, lim, CASE WHEN q % 10 = 0 THEN 20 ELSE 0 END AS skip
  FROM ads JOIN asked USING (platform)
  WHERE (codes IS NULL OR list_has_any(countries, codes))
    AND (keyword IS NULL OR CASE platform
      WHEN 'linkedin' THEN len(list_filter(string_split(keyword, ' '), lambda t: NOT contains(lower(ad_text), t))) = 0
      ELSE contains(lower(ad_text), keyword) END)
    AND (who IS NULL OR CASE WHEN regexp_full_match(who, '[0-9]+') THEN advertiser_id = who
      ELSE contains(lower(advertiser_name), lower(who)) END)
    AND CASE platform
      WHEN 'google' THEN (d_from IS NULL OR first_seen >= d_from) AND (d_to IS NULL OR last_seen < d_to + 1)
      WHEN 'linkedin' THEN d_from IS NULL OR d_to IS NULL OR (first_seen < d_to AND last_seen >= d_from)
      ELSE (d_to IS NULL OR first_seen < d_to + 1) AND (d_from IS NULL OR last_seen >= d_from) END
    AND (kind IS NULL OR ad_type = kind)
    AND (NOT images OR media_type = 'image')
)"""

_BATCH = f"""SELECT request_id, ad_id, platform, {sql_time('first_seen')} AS first_seen FROM (
          SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY first_seen DESC, ad_id) AS place FROM pairs
        ) WHERE place > skip AND place <= skip + lim"""

ORACLES = {
    "search_keyword": _where("platform = 'google' AND lower(ad_text) LIKE lower('%of_the%')"),
    "search_all_terms": _where(
        "platform = 'linkedin' AND lower(ad_text) LIKE '%the%' AND lower(ad_text) LIKE '%of%' AND lower(ad_text) LIKE '%and%'"
    ),
    "search_substring": _where("platform = 'meta' AND contains(lower(ad_text), 'offer 2-')"),
    "search_advertiser": _where(
        "platform = 'tiktok' AND (contains(lower(advertiser_name), 'customer#00000001') OR advertiser_id = '77' "
        "OR contains(lower(advertiser_name), 'cust0'))"
    ),
    "search_advertiser_like": _where("platform = 'google' AND lower(advertiser_name) LIKE '%#%7_%'"),
    "search_countries": _where("platform = 'microsoft' AND list_has_any(countries, ['US', 'DE', 'FR'])"),
    "search_first_country": _where("platform = 'amazon' AND list_contains(countries, 'FR')"),
    "search_default_country": _where("platform = 'meta' AND list_contains(countries, 'US')"),
    "search_country_fallback": _where("platform = 'amazon' AND list_contains(countries, 'DE')"),
    "search_dates_contained": _where(
        "platform = 'google' AND first_seen >= DATE '1996-03-01' AND last_seen <= DATE '1999-06-30'"
    ),
    "search_dates_served": _where(
        "platform = 'linkedin' AND first_seen < DATE '1998-01-01' AND last_seen >= DATE '1997-01-01'"
    ),
    "search_dates_overlap": _where(
        "platform = 'snapchat' AND first_seen <= TIMESTAMP '1998-01-01 23:59:59' AND last_seen >= DATE '1997-01-01'"
    ),
    "search_date_preset": _where("platform = 'apple' AND last_seen >= DATE '2001-06-30' - 180"),
    "search_types": _where("platform = 'meta' AND ad_type = 'HOUSING_ADS'"),
    "search_types_other": _where("platform = 'x' AND ad_type = 'OTHER_ADS'"),
    "search_languages": _where("platform = 'pinterest' AND lang IN ('fr', 'de')"),
    "search_media": _where("platform = 'booking' AND media_type = 'image'"),
    "search_status": _where("platform = 'snapchat' AND status = 'ACTIVE'"),
    "search_top": with_ads(
        f"""{_OUT} WHERE platform = 'google' AND first_seen >= DATE '1996-01-01'
        ORDER BY ads.first_seen DESC, ads.ad_id LIMIT 1000"""
    ),
    "search_limit_kept": with_ads(
        f"""{_OUT} WHERE platform = 'meta' AND (last_seen IS NULL OR last_seen >= DATE '1996-01-01')
        ORDER BY ads.first_seen DESC, ads.ad_id LIMIT 900"""
    ),
    "search_page": with_ads(
        f"{_OUT} WHERE platform = 'x' ORDER BY ads.first_seen DESC, ads.ad_id LIMIT 40 OFFSET 20"
    ),
    "search_page_deep": with_ads(f"{_OUT} ORDER BY ads.first_seen DESC, ads.ad_id LIMIT 60 OFFSET 10500"),
    "search_page_after": with_ads(
        f"""{_OUT} WHERE first_seen < DATE '1999-06-01' OR (first_seen = DATE '1999-06-01' AND ad_id > '500')
        ORDER BY ads.first_seen DESC, ads.ad_id LIMIT 50"""
    ),
    "search_batch": with_ads(
        f"""SELECT request_id, ad_id, platform, {sql_time('first_seen')} AS first_seen FROM (
          SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY first_seen DESC, ad_id) AS place FROM pairs
        ) WHERE place > skip AND place <= skip + lim"""
    ).replace("\nSELECT request_id", f",{_ASKED}\nSELECT request_id", 1),
    "search_batch_counts": with_ads("SELECT request_id, count(*) AS n FROM pairs GROUP BY request_id").replace(
        "\nSELECT request_id", f",{_ASKED}\nSELECT request_id", 1
    ),
    "search_batch_pages": with_ads(_BATCH).replace("\nSELECT request_id", f",{_ASKED}\nSELECT request_id", 1)
    .replace("WHERE q % 11 <> 0", "WHERE q % 11 <> 0 AND q % 3 <> 0")
    .replace("CASE WHEN q % 10 = 0 THEN 20", "CASE WHEN q % 3 = 1 THEN 20"),
    "search_batch_dates": with_ads(
        f"""SELECT request_id, count(*) AS n FROM ads JOIN (
          SELECT 'r' || c_custkey AS request_id, lower(trim({_NAMES}[CAST(c_custkey % 13 AS BIGINT) + 1])) AS platform,
            DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS d_from,
            DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) + CAST(floor(c_acctbal / 50) AS INTEGER) AS d_to
          FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 11 <> 0
        ) USING (platform)
        WHERE CASE platform WHEN 'google' THEN first_seen >= d_from AND last_seen < d_to + 1
          WHEN 'linkedin' THEN first_seen < d_to AND last_seen >= d_from
          ELSE first_seen < d_to + 1 AND last_seen >= d_from END
        GROUP BY request_id"""
    ),
    "ad_details": with_ads(
        "SELECT event_id AS position, ad_id, platform, status FROM events JOIN ads ON k = event_id * 2"
    ),
    "ad_details_bucketed": with_ads(
        "SELECT event_id AS position, ad_id, platform, status FROM events JOIN ads ON k = event_id * 2"
    ),
    "missing_ids": """
        SELECT CAST(event_id * 2 AS VARCHAR) AS ad_id, event_id AS position
        FROM events WHERE event_id * 2 NOT IN (SELECT o_orderkey FROM orders)""",
    "advertisers": with_ads(
        f"""SELECT advertiser_id, advertiser_name, count(*) AS total_ads, {sql_time('min(first_seen)')} AS first_ad_date,
          {sql_time('max(last_seen)')} AS last_ad_date FROM ads GROUP BY ALL"""
    ),
    "advertisers_named": with_ads(
        f"""SELECT advertiser_id, advertiser_name, count(*) AS total_ads, {sql_time('min(first_seen)')} AS first_ad_date,
          {sql_time('max(last_seen)')} AS last_ad_date FROM ads
        WHERE lower(advertiser_name) LIKE '%r#00000%' AND first_seen >= DATE '1997-01-01'
        GROUP BY advertiser_id, advertiser_name ORDER BY total_ads DESC, advertiser_id LIMIT 100"""
    ),
}
