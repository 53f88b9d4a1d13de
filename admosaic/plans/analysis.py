"""Queries: counts, targeting, impressions, wide and long forms, reports and quality."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import normalize as N
from ..operators import quality, reports
from ..operators.storage import shared_folder, stored
from ..sources import registry
from ..sources.pages import unwrap_pages
from ..sources.registry_values import FIELD_PATHS
from . import derived as D
from .compare import plain, sql_joined, sql_pick, sql_time
from .derived_sql import BASE, FACETS, REGION_CODES, SHARES, with_ads, with_base


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.linkedin_flat(unwrap_pages(D.pages_of(spark, sf_dir, "linkedin"), ["linkedin"]))


def _by_platform(spark, sf_dir):
    return A.ads_by_platform(D.stored_ads(spark, sf_dir, lines=False))


def _total(spark, sf_dir):
    return A.total_ads(D.stored_ads(spark, sf_dir, lines=False))


def _samples(spark, sf_dir):
    return A.advertiser_samples(D.stored_ads(spark, sf_dir, lines=False), 3)


def _facets(spark, sf_dir):
    return A.targeting_facets(_flat(spark, sf_dir))


def _rounded(table: DataFrame) -> DataFrame:
    return table.withColumn("sum_impressions", F.round("sum_impressions", 4))


def _impressions(spark, sf_dir):
    return _rounded(A.country_impressions(_flat(spark, sf_dir), top=None))


def _impressions_top(spark, sf_dir):
    return _rounded(A.country_impressions_top(_flat(spark, sf_dir), 5))


def _top_rows(spark, sf_dir):
    """Country rows of the ads that are in the five top countries."""
    flat = stored(_flat(spark, sf_dir).select("ad_url", "total_impressions_to", "impressions_by_country"), "flat")
    rows = A.unnest_impressions(flat, "ad_url")
    return A.in_top_countries(rows, A.country_impressions(flat, 5)).select("ad_url", "country", "impression_percentage")


def _breakdown(field):
    def run(spark, sf_dir):
        return A.targeting_breakdown(D.stored_ads(spark, sf_dir, lines=False), field)

    return run


def _delivery(kind):
    def run(spark, sf_dir):
        ads = N.normalize_ads(D.pages_of(spark, sf_dir, "meta"), platforms=["meta"])
        table = A.delivery_breakdown(ads, kind)
        return table.withColumn("sum_percentage", F.col("sum_percentage").cast("double"))

    return run


def _wide(spark, sf_dir):
    """A column for each of the first twenty countries, the others in one."""
    codes = D.NATION_CODES[:20]
    wide = A.clean_wide(_flat(spark, sf_dir), codes)
    kept = ["ad_url", "advertiser_name", "impressions_mid", "targeting_facets", "impression_pct_other"]
    return wide.select(*kept, *[f"impression_pct_{code}" for code in codes])


def _long(spark, sf_dir):
    return A.clean_long(_flat(spark, sf_dir), "ad_url")


def _unnested(spark, sf_dir):
    """Every ad with its facets next to it; ads without targeting keep one row."""
    rows = A.unnest_targeting(_flat(spark, sf_dir), "ad_url", "advertiser_name", outer=True)
    return plain(rows.select("ad_url", "advertiser_name", "facet_name", "included_segments"))


def _report(kind, **options):
    def run(spark, sf_dir):
        return plain(reports.platform_report(D.stored_ads(spark, sf_dir), kind, **options))

    return run


def _merged_report(kind):
    """The report put together from the partial rows of three batches, one of them written twice."""

    def run(spark, sf_dir):
        path, ads = f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}", D.stored_ads(spark, sf_dir)
        for batch in (0, 1, 1, 2):
            reports.add_to_reports(ads.where(F.col("ad_id").cast("bigint") % 3 == batch), batch, path)
        return plain(reports.stored_report(spark, path, kind))

    return run


def _check(spark, sf_dir):
    """Violations of the ads of google and apple: types outside the list, names instead of codes."""
    ads = N.normalize_creatives(D.creatives(spark, sf_dir, text=False, missing_ids=True))
    return plain(quality.check_ads(ads).select("ad_library_url", "violations"))


#: Fault by rule: every so many orders have it.
_FAULTS = {
    "ad_id:not_null": 23, "ad_id:not_empty": 29, "platform:not_null": 31, "platform:in_list": 37, "fetched_at:not_null": 41,
    "advertiser_type:in_list": 43, "status:in_list": 47, "media_type:in_list": 53, "targeting_gender:in_list": 59,
    "countries:iso_country_codes": 61, "languages:iso_language_codes": 67,
}


def _check_every_rule(spark, sf_dir):
    """All orders as ads, each rule broken by some of them, several by a few."""
    ads, k = D.stored_ads(spark, sf_dir, lines=False).withColumn("k", F.col("ad_id").cast("bigint")), F.col("k")

    def fault(rule, value):
        column = rule.split(":")[0]
        return {column: F.when(k % _FAULTS[rule] == 0, value).otherwise(F.col(column))}

    none = F.lit(None).cast("string")
    values = {
        "ad_id:not_empty": F.lit(""), "ad_id:not_null": none, "platform:in_list": F.lit("myspace"), "platform:not_null": none,
        "fetched_at:not_null": F.lit(None).cast("timestamp"), "advertiser_type:in_list": F.lit("alien"),
        "status:in_list": F.lit("GONE"), "media_type:in_list": F.lit("hologram"),
        "targeting_gender:in_list": F.array(F.lit("male"), F.lit("robot")), "countries:iso_country_codes": F.array(F.lit("usa")),
        "languages:iso_language_codes": F.array(F.lit("EN"), none),
    }
    for rule, value in values.items():
        ads = ads.withColumns(fault(rule, value))
    return plain(quality.check_ads(ads).select("k", "violations").where("size(violations) > 0"))


def _stamped(spark, sf_dir):
    """Ads of which every third has no time of its own, stamped with one."""
    ads, k = D.stored_ads(spark, sf_dir, lines=False), F.col("ad_id").cast("bigint")
    ads = ads.withColumn("fetched_at", F.when(k % 3 != 0, F.col("fetched_at")))
    return plain(N.stamp_fetched(ads).select("ad_id", (F.col("fetched_at") > "2025-01-01").alias("now")))


def _source_index(spark, sf_dir):
    """Documented paths of every source with the number of its ads."""
    counted = D.stored_ads(spark, sf_dir, lines=False).groupBy("platform").agg(F.count("*").alias("ads"))
    return plain(counted.join(F.broadcast(registry.source_index(spark)), "platform"))


def _violations(spark, sf_dir):
    google = N.normalize_creatives(D.creatives(spark, sf_dir, text=False, missing_ids=True))
    return quality.violation_summary(google.unionByName(D.stored_ads(spark, sf_dir)))


def _flagship(spark, sf_dir):
    """Newest thousand political ads that mention a phrase, normalised and counted by country."""
    from ..operators import search as S

    ads = N.normalize_creatives(D.creatives(spark, sf_dir))
    found = S.find_ads(ads, "google", q="the", date_from="1996-01-01", date_to="2001-12-31")
    return (
        found.select(F.explode_outer("countries").alias("country"))
        .filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "country")
    )


QUERIES = {
    "political_ads_by_country": _flagship,
    "ads_by_platform": _by_platform,
    "total_ads": _total,
    "advertiser_samples": _samples,
    "targeting_facets": _facets,
    "country_impressions": _impressions,
    "country_impressions_top": _impressions_top,
    "top_country_rows": _top_rows,
    "targeting_breakdown": _breakdown("targeting_age"),
    "targeting_breakdown_locations": _breakdown("targeting_locations"),
    "delivery_by_age_gender": _delivery("demographic_distribution"),
    "delivery_by_region": _delivery("delivery_by_region"),
    "clean_wide": _wide,
    "clean_long": _long,
    "unnest_targeting": _unnested,
    "report_summary": _report("summary"),
    "report_summary_dated": _report("summary", date_from="1997-01-01", date_to="1998-12-31"),
    "report_spending": _report("spending"),
    "report_reach": _report("reach"),
    "report_advertisers": _report("advertisers"),
    **{f"report_{kind}_merged": _merged_report(kind) for kind in reports.REPORTS},
    "check_ads": _check,
    "violation_summary": _violations,
    "check_every_rule": _check_every_rule,
    "stamped_ads": _stamped,
    "source_index": _source_index,
}

_URL = "'https://www.linkedin.example.com/' || ad_id"
_PCT = "CAST(percentage AS DOUBLE)"


def _linkedin(select: str) -> str:
    return f"WITH {SHARES.strip()},{FACETS},{BASE}\n{select}"


_COUNTRY_SUMS = f"""
  SELECT 'urn:li:country:' || country AS country, count(*) AS total_ads,
    CAST(coalesce(round(sum(CAST(imp_max * CAST(percentage * 100 AS BIGINT) AS DECIMAL(30, 0))) / 10000, 4), 0) AS DOUBLE)
      AS sum_impressions
  FROM shares JOIN base USING (k) GROUP BY 1"""


def _sums(unknown: str, *names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


def _grouped(sums: str) -> str:
    return with_ads(
        f"""SELECT platform, advertiser_id, FALSE AS is_total, count(*) AS total_ads, {sums} FROM ads GROUP BY platform, advertiser_id
        UNION ALL SELECT platform, NULL, TRUE, count(*), {sums} FROM ads GROUP BY platform"""
    )


def _count_null(expression: str, name: str) -> str:
    return f"count(*) - count({expression}) AS {name}"


def _total_of(expression: str, name: str) -> str:
    return f"CAST(sum({expression}) AS BIGINT) AS {name}"


_REACH = "CASE WHEN eu_reach <> 'unknown' THEN CAST(eu_reach AS BIGINT) END"
_SUMMARY = (
    f"platform, count(*) AS total_ads, count(DISTINCT advertiser_id) AS advertisers, "
    f"{sql_time('min(first_seen)')} AS first_seen, {sql_time('max(last_seen)')} AS last_seen"
)
_RULES = f"""
  list_filter([
    CASE WHEN prio = '5-LOW' THEN 'ad_id:not_null' END, 'advertiser_type:in_list',
    CASE WHEN len(list_filter({REGION_CODES}, lambda r: NOT regexp_full_match(r, '[A-Z][A-Z]'))) > 0
      THEN 'countries:iso_country_codes' END], lambda v: v IS NOT NULL)"""

ORACLES = {
    "political_ads_by_country": with_base(
        f"""SELECT country, count(*) AS n FROM (
          SELECT unnest(list_distinct({REGION_CODES})) AS country FROM base
          WHERE contains(lower(ad_text), 'the') AND d1 >= DATE '1996-01-01' AND d2 <= DATE '2001-12-31'
        ) GROUP BY country"""
    ),
    "ads_by_platform": with_base("SELECT platform, count(*) AS n FROM base GROUP BY platform"),
    "total_ads": "SELECT count(*) AS total_ads FROM orders",
    "advertiser_samples": with_ads("SELECT ad_id, advertiser_name FROM ads ORDER BY ad_id LIMIT 3"),
    "targeting_facets": f"""WITH {FACETS.strip()}
        SELECT facet AS facet_name, count(*) AS n FROM facets JOIN orders ON k = o_orderkey
        GROUP BY facet ORDER BY n DESC, facet LIMIT 5""",
    "country_impressions": _linkedin(_COUNTRY_SUMS),
    "country_impressions_top": _linkedin(f"SELECT * FROM ({_COUNTRY_SUMS}) ORDER BY sum_impressions DESC, country LIMIT 5"),
    "top_country_rows": _linkedin(
        f"""SELECT {_URL} AS ad_url, 'urn:li:country:' || country AS country, {_PCT} AS impression_percentage
        FROM shares JOIN base USING (k) WHERE 'urn:li:country:' || country IN (
          SELECT country FROM ({_COUNTRY_SUMS}) ORDER BY sum_impressions DESC, country LIMIT 5)"""
    ),
    "targeting_breakdown": with_base(
        "SELECT platform, value, count(*) AS n FROM (SELECT platform, unnest(ages) AS value FROM base) GROUP BY ALL"
    ),
    "targeting_breakdown_locations": with_base(
        "SELECT platform, value, count(*) AS n FROM (SELECT platform, unnest(regions) AS value FROM base) GROUP BY ALL"
    ),
    "delivery_by_age_gender": with_base(
        """SELECT age, 'unknown' AS gender, count(*) AS n, CAST(count(*) * 0.25 AS DOUBLE) AS sum_percentage
        FROM (SELECT unnest(ages) AS age FROM base) GROUP BY age"""
    ),
    "delivery_by_region": with_base(
        """SELECT regions[1] AS region, count(*) AS n, CAST(count(*) * 0.5 AS DOUBLE) AS sum_percentage
        FROM base GROUP BY 1"""
    ),
    "clean_wide": _linkedin(
        f"""SELECT {_URL} AS ad_url, name AS advertiser_name, (imp_min + imp_max) / 2 AS impressions_mid,
          (SELECT string_agg(DISTINCT facet, ', ' ORDER BY facet) FROM facets f WHERE f.k = base.k) AS targeting_facets,
          {', '.join(f"p.{c} AS impression_pct_{c}" for c in D.NATION_CODES[:20])}, p.others AS impression_pct_other
        FROM base LEFT JOIN (
          SELECT k, {', '.join(f"CAST(sum(percentage) FILTER (country = '{c}') AS DOUBLE) AS {c}" for c in D.NATION_CODES[:20])},
            CAST(sum(percentage) FILTER (country NOT IN ({', '.join(f"'{c}'" for c in D.NATION_CODES[:20])})) AS DOUBLE) AS others
          FROM shares GROUP BY k) p ON p.k = base.k"""
    ),
    "clean_long": _linkedin(
        f"""SELECT {_URL} AS ad_url, 'targeting' AS data_type, facet AS name, facets.segment AS value, TRUE AS is_included,
          CAST(NULL AS DOUBLE) AS impression_percentage FROM facets JOIN base USING (k)
        UNION ALL
        SELECT {_URL}, 'impressions', 'urn:li:country:' || country, NULL, NULL, {_PCT} FROM shares JOIN base USING (k)"""
    ),
    "unnest_targeting": _linkedin(
        f"""SELECT {_URL} AS ad_url, name AS advertiser_name, facet AS facet_name, facets.segment AS included_segments
        FROM base LEFT JOIN facets USING (k)"""
    ),
    "report_summary": with_ads(f"SELECT {_SUMMARY} FROM ads GROUP BY platform"),
    "report_summary_dated": with_ads(
        f"""SELECT {_SUMMARY} FROM ads WHERE first_seen < DATE '1999-01-01' AND last_seen >= DATE '1997-01-01'
        GROUP BY platform"""
    ),
    "report_spending": _grouped(
        ", ".join(
            [
                _total_of("spend_min", "spend_low"), _total_of("spend_max", "spend_high"),
                _count_null("spend_min", "unknown_low"), _count_null("spend_max", "unknown_high"),
            ]
        )
    ),
    "report_reach": _grouped(
        ", ".join(
            [
                _total_of("imp_min", "impressions_low"), _total_of("imp_max", "impressions_high"),
                _total_of(_REACH, "eu_reach"), _count_null("imp_min", "unknown_low"),
                _count_null("imp_max", "unknown_high"), _count_null(_REACH, "unknown_reach"),
            ]
        )
    ),
    "report_advertisers": with_ads(
        """SELECT platform, advertiser_id, advertiser_name, count(*) AS total_ads,
          rank() OVER (PARTITION BY platform ORDER BY count(*) DESC) AS rank
        FROM ads GROUP BY platform, advertiser_id, advertiser_name"""
    ),
    "check_ads": with_base(
        f"""SELECT 'https://adstransparency.example.com/ad/' || ad_id AS ad_library_url, {sql_joined(_RULES)} AS violations
        FROM base"""
    ),
    "violation_summary": with_base(
        f"""SELECT 'google' AS platform, rule, count(*) AS n FROM (SELECT unnest({_RULES}) AS rule FROM base) GROUP BY rule"""
    ),
}

_PATHS = ", ".join(
    f"('{platform}', '{field}', {position}, '{path}')"
    for platform, fields in FIELD_PATHS.items() for field, paths in fields.items() for position, path in enumerate(paths)
)
_BROKEN = ", ".join(
    f"CASE WHEN k % {n} = 0{' AND k % 23 <> 0' if rule == 'ad_id:not_empty' else ' AND k % 31 <> 0' if rule == 'platform:in_list' else ''} "
    f"THEN '{rule}' END"
    for rule, n in _FAULTS.items()
)
ORACLES |= {
    "check_every_rule": f"""SELECT k, array_to_string(list_sort(v), ',') AS violations FROM (
        SELECT o_orderkey AS k, list_filter([{_BROKEN}], lambda x: x IS NOT NULL) AS v FROM orders) WHERE len(v) > 0""",
    "stamped_ads": "SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, o_orderkey % 3 = 0 AS now FROM orders",
    "source_index": with_base(
        f"""SELECT platform, ads, field, CAST(position AS BIGINT) AS position, path
        FROM (SELECT platform, count(*) AS ads FROM base GROUP BY platform)
        JOIN (VALUES {_PATHS}) p(platform, field, position, path) USING (platform)"""
    ),
}
ORACLES |= {f"report_{kind}_merged": ORACLES[f"report_{kind}"] for kind in reports.REPORTS}

__all__ = ["ORACLES", "QUERIES", "sql_pick"]
