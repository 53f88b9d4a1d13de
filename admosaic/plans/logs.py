"""Queries: requests, registry, landed pages, fetch log, stream and sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fetchlog as L
from ..operators import requests as R
from ..operators.bulk import get_all
from ..operators.normalize import latest_ads, normalize_ads, normalize_unknown
from ..operators.ranking import ensure_checkpoint_dir
from ..operators.storage import stored
from ..sources import registry
from ..sources.pages import page_counters, page_errors, read_raw_pages, unreadable_pages
from ..sources.tables import flatten_lists, write_ads
from ..streaming.ingest import ingest_pages_stream, stream_pages, stream_quota
from ..streaming.quota import ingest_quota_stream, read_late, read_quota
from ..streaming.upsert import read_upserted, upsert_pages_stream
from . import derived as D
from .compare import plain, plain_ads, sql_list, sql_pick, sql_time
from .derived_sql import with_ads, with_base
from .normalization import ORACLES as NORMALIZED

c = F.col


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- requests and registry


def _validate(spark, sf_dir):
    checked = R.validate_requests(D.requests(spark, sf_dir))
    return checked.select("request_id", F.array_join("errors", "; ").alias("errors"))


def _valid(spark, sf_dir):
    return R.valid_requests(D.requests(spark, sf_dir)).select("request_id", "platform", "operation")


def _manifest(spark, sf_dir):
    """Native parameters of the requests for which no line of the same number has landed."""
    landed = D.page_log(spark, sf_dir).select(F.concat(F.lit("r"), "request_id").alias("request_id"))
    manifest = R.request_manifest(D.requests(spark, sf_dir), landed)
    return _as_text(manifest)


def _as_text(manifest: DataFrame) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return manifest.select("request_id", "platform", "operation", F.array_join(entries, "&").alias("params"))


def _details(spark, sf_dir):
    """Every customer's request as one for the details of two ads, one of them named twice, defaults filled in."""
    k = F.substring("request_id", 2, 20)
    ids = F.array(k, F.lit(None).cast("string"), F.concat(k, F.lit(" b")), k, F.lit(" "))
    asked = D.requests(spark, sf_dir).withColumns({"operation": F.lit("details"), "ad_ids": ids})
    entries = F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    found = R.detail_requests(asked, platform_defaults=True)
    return found.select("request_id", "platform", "ad_id", "path", F.array_join(entries, "&").alias("params"))


def _native(spark, sf_dir):
    """Every customer's request, faulty or not, in the parameters of its platform, defaults filled in."""
    asked = D.requests(spark, sf_dir).withColumn("platform", F.lower(F.trim("platform")))
    native = R.native_params(asked, platform_defaults=True)
    return _as_text(native.filter(c("params").isNotNull()))


def _capabilities(spark, sf_dir):
    """Requests that need each feature, by platform, and whether it is supported."""
    asked = D.requests(spark, sf_dir).withColumn("platform", F.lower(F.trim("platform")))
    needs = F.array_compact(
        F.array(
            c("operation"),
            F.when(c("keyword") != "", F.lit("keyword_search")),
            F.when(c("date_from").isNotNull() | c("date_to").isNotNull(), F.lit("date_filtering")),
            F.when(c("countries").isNotNull(), F.lit("country_filtering")),
            F.when(c("page_token").isNotNull(), F.lit("pagination")),
        )
    )
    counted = asked.select("platform", F.explode(needs).alias("feature")).groupBy("platform", "feature").agg(
        F.count("*").alias("requests")
    )
    return counted.join(F.broadcast(registry.platform_capabilities(spark)), ["platform", "feature"])


def _params(spark, sf_dir):
    """Requests by the native name of the keyword and of the start date at their platform."""
    asked = D.requests(spark, sf_dir).withColumn("platform", F.lower(F.trim("platform")))
    used = asked.select("platform", F.explode(F.array(F.lit("keyword"), F.lit("date_from"))).alias("param"))
    named = used.join(F.broadcast(registry.platform_params(spark)), ["platform", "param"])
    return named.groupBy("platform", "param", "native_name").agg(F.count("*").alias("requests"))


def _with_limits(spark, sf_dir):
    fetches = D.fetch_log(spark, sf_dir).groupBy("platform").agg(F.count("*").alias("fetches"))
    return registry.ads_with_limits(fetches).select("platform", "fetches", "requests_per_hour", "requests_per_day", "retry_after_default")


def _platforms(spark, sf_dir):
    """Ads by platform with the platform's settings and coverage."""
    counted = D.stored_ads(spark, sf_dir, lines=False).groupBy("platform").agg(F.count("*").alias("ads"))
    coverage = registry.platform_coverage(spark).select("platform", F.array_join("geographic", "; ").alias("geographic"))
    endpoints = registry.platform_endpoints(spark).filter("operation = 'advertisers'").select("platform", "endpoint")
    joined = counted.join(F.broadcast(registry.platforms(spark)), "platform").join(F.broadcast(coverage), "platform")
    return plain(
        joined.join(F.broadcast(endpoints), "platform").select(
            "platform", "ads", "version", "paging", "max_limit", "geographic", "endpoint"
        )
    )


def _coverage(spark, sf_dir):
    return registry.field_coverage(D.items_of(spark, sf_dir, "meta"), "meta")


# --- landed pages


def _counters(spark, sf_dir):
    return page_counters(D.page_log(spark, sf_dir))


def _page_counters(spark, sf_dir):
    return plain(_counters(spark, sf_dir).select("platform", "request_id", "page_no", "fetched_at", "items", "total_count", "next_position"))


def _audit(spark, sf_dir):
    columns = ["platform", "request_id", "page_no", "copies", "state", "gap_before"]
    return plain(L.page_audit(_counters(spark, sf_dir)).select(*columns))


def _audit_summary(spark, sf_dir):
    return L.audit_summary(L.page_audit(_counters(spark, sf_dir)))


def _collect(spark, sf_dir):
    """Pages that count as collected; of repeated pages the copy landed last counts."""
    return plain(L.collect_pages(_counters(spark, sf_dir), 4).select("platform", "request_id", "page_no", "copies"))


def _broken(spark, sf_dir):
    """The page log with every third page of a request replaced by an error text."""
    body = F.when(c("page_no") % 3 == 1, F.lit("<html>busy</html>")).otherwise(c("body"))
    return D.page_log(spark, sf_dir).withColumn("body", body)


def _collect_broken(spark, sf_dir):
    """Pages that count as collected where some cannot be read: those are passed over and end nothing."""
    collected = L.collect_pages(page_counters(_broken(spark, sf_dir)))
    return plain(collected.select("platform", "request_id", "page_no", "copies"))


def _unreadable(spark, sf_dir):
    return unreadable_pages(_broken(spark, sf_dir)).groupBy("platform").agg(F.count("*").alias("pages"))


def _unknown(spark, sf_dir):
    """Pages of sources without a mapping, by source."""
    pages = D.page_log(spark, sf_dir).withColumn("platform", F.concat(F.lit("new-"), "platform"))
    return normalize_unknown(pages).groupBy("platform", "media_type").agg(F.count("*").alias("ads"))


def _stored_csv(spark, sf_dir):
    """The ad table written as CSV, read back as text."""
    out = scratch(spark, "csv")
    write_ads(D.stored_ads(spark, sf_dir), out, fmt="csv")
    ads = spark.read.option("header", True).csv(out)
    return plain(ads.select("platform", "ad_id", "countries", "targeting_age", "spend_range"))


def _bodies(spark, sf_dir):
    """All landed copies of the collected pages, by request."""
    pages = D.page_log(spark, sf_dir)
    kept = L.collected_bodies(pages, L.collect_pages(page_counters(pages), 10))
    return kept.groupBy("platform", "request_id").agg(F.count("body").alias("copies"))


def _chains(spark, sf_dir):
    return plain(L.page_chains(D.page_positions(spark, sf_dir)))


def _totals(spark, sf_dir):
    return L.page_totals(_counters(spark, sf_dir))


def _errors(spark, sf_dir):
    """Events as pages of tiktok, those of type error as error pages."""
    body = F.when(
        c("event_type") == "error", F.to_json(F.struct(F.struct(c("props").alias("message")).alias("error")))
    ).otherwise(F.lit('{"data":[{"id":"1"}]}'))
    pages = D.table(spark, sf_dir, "events").select(
        F.lit("tiktok").alias("platform"),
        F.lit("search_ads").alias("operation"),
        c("user_id").cast("string").alias("request_id"),
        c("event_id").cast("int").alias("page_no"),
        c("ts").alias("fetched_at"),
        body.alias("body"),
    )
    return plain(page_errors(pages, ["tiktok"]).select("request_id", "page_no", "error"))


# --- fetch log


def _quota(period):
    def run(spark, sf_dir):
        return plain(L.quota_usage(D.fetch_log(spark, sf_dir), period))

    return run


def _tier(spark, sf_dir):
    tiers = L.usage_tier(D.fetch_log(spark, sf_dir))
    return tiers.groupBy("platform", "wait_seconds").agg(F.count("*").alias("n"), F.max("max_usage").alias("max_usage")).select(
        "platform", c("wait_seconds").cast("bigint").alias("wait_seconds"), "n", "max_usage"
    )


def _classified(spark, sf_dir):
    done = L.classify_errors(D.fetch_log(spark, sf_dir))
    return plain(done.select("ts", "platform", "error_class", "retry_seconds", "message", "kept_body", "retryable"))


def _fetch_errors(spark, sf_dir):
    return L.fetch_errors(D.fetch_log(spark, sf_dir))


# --- stream and sink


def _ingest(spark, sf_dir):
    """All orders as pages of x, landed twice, streamed into the ad table; each ad once."""
    landing, out, state = (scratch(spark, name) for name in ("landing", "ads", "state"))
    pages = D.pages_of(spark, sf_dir, "x")
    times = F.explode(F.array(c("fetched_at"), c("fetched_at") + F.expr("INTERVAL 5 MINUTES")))
    pages.withColumn("fetched_at", times).write.option("compression", "zstd").parquet(landing)
    stream = stream_pages(spark, landing, "parquet")
    ingest_pages_stream(stream, out, state, platforms=["x"]).awaitTermination()
    return plain_ads(latest_ads(spark.read.parquet(out))).drop("fetched_at")


def _upserted(spark, sf_dir):
    """Orders as pages of x, landed in two streams' runs, the second with every page again and later ones first; the
    table holds each ad once."""
    landing, out, state = (scratch(spark, name) for name in ("landing", "ads", "state"))
    pages = stored(D.pages_of(spark, sf_dir, "x"), "pages")
    later = pages.withColumn("fetched_at", c("fetched_at") + F.expr("INTERVAL 5 MINUTES"))
    for part in (later.where("page_no % 2 = 0"), pages):
        part.write.mode("append").option("compression", "zstd").parquet(landing)
        upsert_pages_stream(stream_pages(spark, landing, "parquet"), out, state, ["x"], buckets=8).awaitTermination()
    return plain_ads(read_upserted(spark, out)).drop("fetched_at")


def _windows(periods, sliding):
    def run(spark, sf_dir):
        return plain(L.quota_windows(D.fetch_log(spark, sf_dir), periods, sliding))

    return run


def _quota_ingested(spark, sf_dir):
    """The fetch log in two runs of a stream, the older half last, in sliding windows of an hour and tumbling sums of all."""
    landing, out, state = (scratch(spark, name) for name in ("log", "quota", "state"))
    log = D.fetch_log(spark, sf_dir)
    for newer in (True, False):
        log.where((c("ts") >= "2024-01-15") == newer).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(L.FETCH_LOG).parquet(landing)
        ingest_quota_stream(stream, out, state, ["hour"]).awaitTermination()
    late = read_late(spark, out).groupBy("platform").agg(F.count("*").alias("late"))
    return plain(read_quota(spark, out).join(late, "platform", "left").na.fill(0, ["late"]))


def _stream_quota(spark, sf_dir):
    """The fetch log as a stream, in complete mode, against the limits of a day."""
    landing, out, state = (scratch(spark, name) for name in ("log", "quota", "state"))
    D.fetch_log(spark, sf_dir).write.parquet(landing)
    log = spark.readStream.schema(L.FETCH_LOG).parquet(landing)
    usage = stream_quota(log, "day")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    query = (
        usage.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return plain(spark.read.parquet(out))


def _stored(spark, sf_dir):
    """The ad table written by platform, read back and flattened."""
    out = scratch(spark, "stored")
    write_ads(D.stored_ads(spark, sf_dir), out, files_per_platform=2)
    ads = flatten_lists(spark.read.parquet(out))
    return plain(ads.select("platform", "ad_id", "countries", "targeting_age", "spend_range", "first_seen"))


def _get_all(spark, sf_dir):
    """The ads of the first twenty pages of every request of pinterest, those shown in one country."""
    pages = D.pages_of(spark, sf_dir, "pinterest")
    return plain_ads(get_all(pages, "pinterest", max_pages=20, countries=["DE"], media="image")).drop("ad_text")


def _landed_json(spark, sf_dir):
    """Pages of booking written as compacted JSON, read as landed pages and normalised."""
    landing = scratch(spark, "pages")
    D.pages_of(spark, sf_dir, "booking").write.json(landing)
    return plain_ads(normalize_ads(read_raw_pages(spark, landing, "json"), platforms=["booking"]))


QUERIES = {
    "validate_requests": _validate,
    "valid_requests": _valid,
    "request_manifest": _manifest,
    "native_params": _native,
    "detail_params": _details,
    "capabilities": _capabilities,
    "platform_params": _params,
    "fetches_with_limits": _with_limits,
    "platforms": _platforms,
    "field_coverage": _coverage,
    "page_counters": _page_counters,
    "page_audit": _audit,
    "page_audit_summary": _audit_summary,
    "collect_pages": _collect,
    "collect_pages_broken": _collect_broken,
    "unreadable_pages": _unreadable,
    "normalize_unknown": _unknown,
    "collected_bodies": _bodies,
    "stored_csv": _stored_csv,
    "page_chains": _chains,
    "page_totals": _totals,
    "page_errors": _errors,
    "quota_usage": _quota("hour"),
    "quota_usage_day": _quota("day"),
    "usage_tier": _tier,
    "classify_errors": _classified,
    "fetch_errors": _fetch_errors,
    "ingest_stream": _ingest,
    "quota_stream": _stream_quota,
    "quota_minute": _windows(["minute"], False),
    "quota_sliding": _windows(None, True),
    "quota_ingested": _quota_ingested,
    "upsert_stream": _upserted,
    "stored_ads": _stored,
    "landed_json": _landed_json,
    "get_all": _get_all,
}

_NAMES = sql_list([*D.PLATFORMS, " Meta ", "myspace"])
_CODE = sql_pick(D.NATION_CODES, "c_nationkey")
_REQUESTS = f"""
req AS (
  SELECT c_custkey AS q, 'r' || c_custkey AS request_id,
    lower(trim({_NAMES}[CAST(c_custkey % 13 AS BIGINT) + 1])) AS platform,
    CASE c_custkey % 5 WHEN 3 THEN 'advertisers' WHEN 4 THEN 'details' ELSE 'search_ads' END AS operation,
    CASE c_custkey % 5 WHEN 0 THEN 'the' WHEN 1 THEN 'of the' WHEN 2 THEN '' WHEN 3 THEN 'offer' ELSE 'in' END AS keyword,
    CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN 'Customer#0000001' END AS who,
    CASE WHEN c_custkey % 3 = 0 THEN [{_CODE}] WHEN c_custkey % 3 = 1 THEN [{_CODE}, 'FR']
      WHEN c_custkey % 7 = 0 THEN [{_CODE}] END AS codes,
    c_custkey % 3 = 2 AND c_custkey % 7 = 0 AS named,
    c_custkey % 11 = 0 AS soon,
    CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 2 = 0 THEN DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) END AS d_from,
    CASE WHEN c_custkey % 2 = 0 THEN DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER)
      + CAST(floor(c_acctbal / 50) AS INTEGER) END AS d_to,
    CASE WHEN c_custkey % 6 = 0 THEN {sql_pick(D.AD_TYPES, 'c_custkey % 5')} END AS kind,
    CASE WHEN c_custkey % 8 = 0 THEN 'IMAGE' END AS media,
    CAST(floor(c_acctbal / 8) AS INTEGER) AS lim,
    CASE WHEN c_custkey % 10 = 0 THEN '20' END AS token
  FROM customer
),
checked AS (
  SELECT *, list_filter([
    CASE WHEN platform = 'myspace' THEN 'Unknown platform: myspace' END,
    CASE WHEN (platform IN ('meta', 'snapchat') AND operation = 'advertisers') OR (platform = 'linkedin' AND operation = 'details')
      THEN platform || ' does not support ' || operation END,
    CASE WHEN named THEN 'Invalid country codes: Germany' END,
    CASE WHEN soon THEN 'Invalid date_from format' END,
    CASE WHEN d_from > d_to THEN 'date_from must be before or equal to date_to' END,
    CASE WHEN lim < 1 THEN 'limit must be a positive integer' END,
    CASE WHEN lim > 1000 THEN 'limit cannot exceed 1000' END,
    CASE WHEN operation = 'advertisers' AND keyword = '' THEN 'Search query is required for advertiser search' END
  ], lambda e: e IS NOT NULL) AS errors FROM req
)"""


def _requests(select: str) -> str:
    return f"WITH {_REQUESTS}\n{select}"


_EU = sql_list("AT BE BG HR CY CZ DK EE FI FR DE GR HU IE IT LV LT LU MT NL PL PT RO SK SI ES SE".split())
_ISO = "strftime({}, '%Y-%m-%d')"
_FIELDS = (
    "id,page_id,page_name,ad_snapshot_url,ad_delivery_start_time,ad_delivery_stop_time,ad_creative_bodies,media_type,"
    "spend,impressions,eu_total_reach,beneficiary_payers,target_ages,target_gender,target_locations,"
    "impressions_by_country,demographic_distribution,delivery_by_region"
)
_NUMBERS = "MAP {" + ", ".join(
    f"'{k}': {v}"
    for k, v in {
        "US": 84, "GB": 77, "DE": 31, "FR": 30, "IT": 40, "ES": 65, "NL": 54, "BE": 14, "AT": 11, "SE": 67, "DK": 25,
        "NO": 55, "FI": 29, "PL": 58, "CZ": 24, "HU": 38, "RO": 60, "BG": 17, "HR": 37, "SI": 64, "SK": 63, "LT": 45,
        "LV": 44, "EE": 27, "IE": 39, "PT": 59, "GR": 36, "CY": 23, "MT": 51, "LU": 46,
    }.items()
) + "}"


def _pairs(**values: str) -> str:
    """``name=value`` texts joined by ``&`` in order of name, absent values left out."""
    parts = [f"'{name}=' || ({value})" for name, value in sorted(values.items())]
    return f"concat_ws('&', {', '.join(parts)})"


def _native_sql(defaults: bool) -> str:
    key = "replace(keyword, ' ', '%20')"
    first, start, end = "codes[1]", _ISO.format("d_from"), _ISO.format("d_to")
    us = f"coalesce({first}, 'US')" if defaults else first
    de = f"coalesce({first}, 'DE')" if defaults else first
    eu = f"list_filter(codes, lambda x: list_contains({_EU}, x))[1]"
    am = "list_filter(codes, lambda x: list_contains(['US', 'CA', 'GB', 'UK'], x))[1]"
    if defaults:
        eu, am = f"coalesce({eu}, 'DE')", f"coalesce({am}, 'US')"
    every = "CASE WHEN len(codes) > 0 THEN array_to_string(codes, ',') END"
    meta_countries = f"coalesce({every}, 'US')" if defaults else every
    skip = "coalesce(token, '0')"

    def cap(n: int) -> str:
        return f"CAST(least(lim, {n}) AS VARCHAR)"

    numbers = f"nullif(array_to_string(list_filter(list_transform(codes, lambda x: {_NUMBERS}[x]), lambda n: n IS NOT NULL), ','), '')"
    digits = "regexp_full_match(who, '[0-9]+')"
    preset = (
        "CASE WHEN date_diff('day', d_from, coalesce(d_to, current_date)) > 180 THEN 'LAST_YEAR' "
        "WHEN date_diff('day', d_from, coalesce(d_to, current_date)) > 90 THEN 'LAST_180_DAYS' ELSE 'LAST_90_DAYS' END"
    )
    urns = "'(value:List(' || array_to_string(list_transform(codes, lambda x: 'urn%3Ali%3Acountry%3A' || x), ',') || '))'"
    day = "'(day:' || day({0}) || ',month:' || month({0}) || ',year:' || year({0}) || ')'"
    served = (
        "CASE WHEN d_from IS NOT NULL AND d_to IS NOT NULL THEN '(start:' || " + day.format("d_from") + " || ',end:' || "
        + day.format("d_to") + " || ')' END"
    )
    search = {
        "amazon": _pairs(advertiser="who", country=eu, start_date=start, end_date=end, limit=cap(100), offset=skip),
        "apple": "CASE WHEN who IS NULL THEN '' ELSE "
        + _pairs(type="'DEVELOPER'", id="who", countryOrRegion=first, datePreset=preset, limit=cap(100), offset=skip)
        + " END",
        "booking": _pairs(country=first, search_term=key, start_date=start, end_date=end, limit=cap(100), offset=skip),
        "google": _pairs(
            creative_text_filter="keyword", advertiser_name="who", country_code=every, date_range_start=start,
            date_range_end=end, LIMIT=cap(10000), OFFSET=skip,
        ),
        "linkedin": _pairs(
            keyword=key, advertiser="who", countries=urns, dateRange=served, count=cap(25), start=skip
        ),
        "meta": _pairs(
            ad_reached_countries=meta_countries, search_terms=key, ad_type="CASE WHEN kind <> 'OTHER_ADS' THEN kind END",
            ad_delivery_date_min=start, ad_delivery_date_max=end, media_type="media", limit=cap(25), after="token",
            fields=f"'{_FIELDS}'",
        ),
        "microsoft": _pairs(
            searchText=key, top=cap(100), skip=skip, advertiserId="who", startDate=start, endDate=end, countryCodes=numbers
        ),
        "pinterest": _pairs(
            country=us, search_terms=key, advertiser_name="who", start_date=start, end_date=end, page_size=cap(100),
            bookmark="token",
        ),
        "snapchat": _pairs(
            CountryCode=am, AdvertiserName="who", OrganizationName=key, StartDate=start, EndDate=end, limit=cap(100), offset=skip
        ),
        "tiktok": _pairs(
            country_code=us, search_term=key, advertiser_id=f"CASE WHEN {digits} THEN who END",
            advertiser_name=f"CASE WHEN NOT {digits} THEN who END", start_date=start, end_date=end, page_size=cap(100),
            page_token="token",
        ),
        "x": _pairs(
            country=us, advertiser_name="who", search_term=key, start_date=start, end_date=end, count=cap(100), next_token="token"
        ),
    }
    advertisers = {
        "amazon": _pairs(name=key, country=de, limit=cap(100), offset=skip),
        "apple": _pairs(name=key, types="'APP,DEVELOPER'", limit=cap(100), offset=skip),
        "google": _pairs(advertiser_name="keyword", date_range_start=start, LIMIT=cap(1000)),
        "linkedin": _pairs(name=key, count=cap(25), start=skip),
        "microsoft": _pairs(searchText=key, top=cap(100), skip=skip),
        "pinterest": _pairs(name=key, page_size=cap(100), bookmark="token"),
        "snapchat": _pairs(OrganizationName=key, CountryCode=us, limit=cap(100), offset=skip),
        "tiktok": _pairs(country_code=us, advertiser_name=key, page_size=cap(100), page_token="token"),
        "x": _pairs(name=key, country=us, count=cap(100), next_token="token"),
    }
    whens = [f"WHEN platform = '{p}' AND operation = 'search_ads' THEN {v}" for p, v in search.items()]
    whens += [f"WHEN platform = '{p}' AND operation = 'advertisers' THEN {v}" for p, v in advertisers.items()]
    return "CASE " + "\n".join(whens) + " END"


_MORE = "l_linestatus = 'O'"
_PLATFORM = sql_pick(D.PLATFORMS, "l_orderkey % 11")
_PAGES = f"""
landed AS (
  SELECT {_PLATFORM} AS platform, CAST(l_orderkey AS VARCHAR) AS request_id, CAST(l_linenumber - 1 AS BIGINT) AS page_no,
    l_shipdate AS fetched_at, CASE WHEN {_PLATFORM} = 'google' THEN 1 ELSE CAST(greatest(l_quantity - 10, 0) AS BIGINT) END AS items,
    CASE WHEN {_MORE} THEN CASE WHEN {_PLATFORM} IN ('amazon', 'apple', 'linkedin')
      THEN CAST(l_linenumber * 25 AS VARCHAR) ELSE CAST((l_linenumber - 1) * 25 AS VARCHAR) END END AS next_position
  FROM lineitem
),
with_total AS (
  SELECT *, CASE WHEN platform <> 'linkedin' THEN items WHEN next_position IS NOT NULL THEN 1000 ELSE 0 END AS total_count
  FROM landed
),
latest AS (
  SELECT platform, request_id, page_no, max(fetched_at) AS at FROM with_total GROUP BY ALL
)"""


def _paged(select: str) -> str:
    return f"WITH {_PAGES}\n{select}"


_LOG = f"""
log AS (
  SELECT event_id, ts, {sql_pick(D.PLATFORMS, 'user_id % 11')} AS platform,
    CASE event_type WHEN 'signup' THEN 'auth' WHEN 'purchase' THEN 'rate_limit' WHEN 'error' THEN 'server' ELSE 'ok' END AS error_class,
    CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS DOUBLE) END AS retry_seconds,
    CASE event_type WHEN 'signup' THEN props WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'oops' END AS message,
    CASE event_type WHEN 'signup' THEN '{{"message":"' || replace(props, '"', '\\"') || '"}}'
      WHEN 'purchase' THEN '{{"debug_message":"purchase"}}' WHEN 'error' THEN 'oops' END AS kept_body,
    CASE WHEN event_id % 3 = 2 THEN 0.0 ELSE
      greatest(CAST(json_extract_string(props, '$.k') AS DOUBLE), CAST(floor(value) % 100 AS DOUBLE), 0.0) END AS max_usage
  FROM events
)"""


def _logged(select: str) -> str:
    return f"WITH {_LOG}\n{select}"


_LIMITS = "(VALUES " + ", ".join(
    f"('{p}', {h}, {d})"
    for p, h, d in [
        ("amazon", 100, 1000), ("apple", 60, 1000), ("booking", 50, 500), ("google", 100, 1000), ("linkedin", 600, 1000),
        ("meta", 200, 25000), ("microsoft", 100, 1000), ("pinterest", 60, 1000), ("snapchat", 5, 20),
        ("tiktok", 100, 1000), ("x", 50, 500),
    ]
) + ") lim(platform, per_hour, per_day)"


def _quota_sql(period: str) -> str:
    return _logged(
        f"""SELECT platform, {sql_time('period')} AS period_start, requests, CAST(per_{period} AS BIGINT) AS allowed,
          requests > per_{period} AS over_limit
        FROM (SELECT platform, date_trunc('{period}', ts) AS period, count(*) AS requests FROM log GROUP BY ALL)
        JOIN {_LIMITS} USING (platform)"""
    )


def _windows_sql(shapes: list[tuple[str, int, int]], late: str = "", late_column: str = "") -> str:
    """Windows of (period, seconds, seconds between starts) against the limits."""
    each = "\nUNION ALL ".join(
        f"""SELECT platform, '{period}' AS period, ts, unnest(range(CAST(floor(epoch(ts)) AS BIGINT) // {step} * {step} - {length} + {step},
          CAST(floor(epoch(ts)) AS BIGINT) // {step} * {step} + 1, {step})) AS start FROM log"""
        for period, length, step in shapes
    )
    return _logged(
        f"""SELECT platform, period, {sql_time('make_timestamp(start * 1000000)')} AS period_start, requests, allowed,
          requests > allowed AS over_limit{late_column}
        FROM (SELECT platform, period, start, count(*) AS requests FROM ({each}) GROUP BY ALL)
        JOIN (SELECT platform, 'minute' AS period, CAST(60 AS BIGINT) AS allowed FROM {_LIMITS} WHERE platform = 'linkedin'
          UNION ALL SELECT platform, 'hour', CAST(per_hour AS BIGINT) FROM {_LIMITS}
          UNION ALL SELECT platform, 'day', CAST(per_day AS BIGINT) FROM {_LIMITS}) USING (platform, period){late}"""
    )


_WAIT = (
    "CASE WHEN max_usage > 95 THEN 90 WHEN max_usage > 90 THEN 30 WHEN max_usage > 80 THEN 10 "
    "WHEN max_usage > 75 THEN 5 WHEN max_usage > 50 THEN 3 ELSE 0 END"
)
_UNSUPPORTED = (
    "('apple', 'keyword_search'), ('apple', 'date_filtering'), ('linkedin', 'details'), ('meta', 'advertisers'), "
    "('snapchat', 'advertisers'), ('snapchat', 'keyword_search')"
)
_NATIVE_NAMES = "(VALUES " + ", ".join(
    f"('{p}', {k}, {d})"
    for p, k, d in [
        ("amazon", "'search_term'", "'start_date'"), ("apple", "NULL", "NULL"), ("booking", "'searchText'", "'dateFrom'"),
        ("google", "'creative_text_filter'", "'date_range_start'"), ("linkedin", "'keyword'", "'start_date'"),
        ("meta", "'search_terms'", "'ad_delivery_date_min'"), ("microsoft", "'searchText'", "'startDate'"),
        ("pinterest", "'search_term'", "'start_date'"), ("snapchat", "NULL", "'start_date'"),
        ("tiktok", "'search_term'", "'ad_published_date_range.min'"), ("x", "'search_term'", "'start_date'"),
    ]
) + ") names(platform, keyword_name, date_name)"
_SETTINGS = "(VALUES " + ", ".join(
    f"('{p}', '{v}', '{g}', '{cov}', {e})"
    for p, v, g, cov, e in [
        ("amazon", "v1", "token", "EU", "'adlib/advertisers'"),
        ("apple", "v1", "offset", "Global", "'ad-repository-entities'"),
        ("booking", "v1", "offset", "EU (DSA compliance)", "'graphql'"),
        ("google", "v1", "sql_offset", "Global (political); Various (transparency)", "'query'"),
        ("linkedin", "202405", "offset", "Global", "'advertisers'"),
        ("meta", "v19.0", "cursor", "EU; UK; Global (political)", "NULL"),
        ("microsoft", "v1", "offset", "EU; EEA", "'Advertisers'"),
        ("pinterest", "v1", "token", "EU (DSA compliance)", "'advertisers'"),
        ("snapchat", "v1", "cursor", "EU", "NULL"),
        ("tiktok", "v2", "token", "EU; Global (expanding)", "'advertiser/query'"),
        ("x", "v1", "token", "Limited/Non-compliant", "'advertisers'"),
    ]
) + ") s(platform, version, paging, geographic, endpoint)"
_PATHS = [
    ("ad_id", "id", "TRUE"), ("advertiser_id", "page_id", "TRUE"), ("advertiser_name", "page_name", "TRUE"),
    ("first_seen", "ad_delivery_start_time", "TRUE"), ("last_seen", "ad_delivery_stop_time", "TRUE"),
    ("ad_text", "ad_creative_bodies", "TRUE"), ("media_type", "media_type", "k % 4 = 0"),
    ("media_urls", "ad_snapshot_url", "TRUE"), ("spend_range", "spend", "TRUE"), ("impressions_range", "impressions", "TRUE"),
    ("eu_reach", "eu_total_reach", "TRUE"), ("payer", "beneficiary_payers.payer", "TRUE"),
    ("beneficiary", "beneficiary_payers.beneficiary", "TRUE"), ("targeting_age", "target_ages", "TRUE"),
    ("targeting_gender", "target_gender", "TRUE"), ("targeting_locations", "target_locations", "TRUE"),
    ("countries", "impressions_by_country", "TRUE"),
]

ORACLES = {
    "validate_requests": _requests("SELECT request_id, array_to_string(errors, '; ') AS errors FROM checked"),
    "valid_requests": _requests("SELECT request_id, platform, operation FROM checked WHERE len(errors) = 0"),
    "request_manifest": _requests(
        f"""SELECT request_id, platform, operation, {_native_sql(False)} AS params FROM checked
        WHERE len(errors) = 0 AND q NOT IN (SELECT l_orderkey FROM lineitem)"""
    ),
    "native_params": _requests(
        f"""SELECT * FROM (SELECT request_id, platform, operation, {_native_sql(True)} AS params FROM req)
        WHERE params IS NOT NULL"""
    ),
    "detail_params": _requests(
        """SELECT request_id, platform, ad_id,
          CASE platform WHEN 'amazon' THEN 'adlib/ads/' || written WHEN 'microsoft' THEN 'Ads/' || written
            WHEN 'apple' THEN 'ad-repository-ads' WHEN 'booking' THEN 'graphql' WHEN 'google' THEN 'query' WHEN 'meta' THEN 'ads_archive'
            WHEN 'tiktok' THEN 'ad/detail' ELSE 'ads/' || written END AS path,
          CASE WHEN platform = 'meta' THEN 'id=' || ad_id WHEN platform IN ('apple', 'booking', 'google') THEN 'ad_id=' || ad_id
            WHEN platform = 'tiktok' THEN 'ad_id=' || ad_id || '&country_code=' || coalesce(codes[1], 'US') ELSE '' END AS params
        FROM (SELECT *, replace(ad_id, ' ', '%20') AS written FROM (
          SELECT request_id, platform, codes, unnest([CAST(q AS VARCHAR), q || ' b']) AS ad_id FROM req))
        WHERE platform NOT IN ('linkedin', 'myspace')"""
    ),
    "capabilities": _requests(
        f"""SELECT platform, feature, count(*) AS requests, (platform, feature) NOT IN ({_UNSUPPORTED}) AS supported
        FROM (SELECT platform, unnest(list_filter([operation, CASE WHEN keyword <> '' THEN 'keyword_search' END,
          CASE WHEN soon OR d_from IS NOT NULL OR d_to IS NOT NULL THEN 'date_filtering' END,
          CASE WHEN codes IS NOT NULL THEN 'country_filtering' END, CASE WHEN token IS NOT NULL THEN 'pagination' END],
          lambda f: f IS NOT NULL)) AS feature FROM req)
        WHERE platform <> 'myspace' GROUP BY platform, feature"""
    ),
    "platform_params": _requests(
        f"""SELECT platform, param, CASE param WHEN 'keyword' THEN keyword_name ELSE date_name END AS native_name, count(*) AS requests
        FROM (SELECT platform, unnest(['keyword', 'date_from']) AS param FROM req) JOIN {_NATIVE_NAMES} USING (platform)
        GROUP BY ALL"""
    ),
    "fetches_with_limits": _logged(
        f"""SELECT platform, count(*) AS fetches, CAST(per_hour AS BIGINT) AS requests_per_hour,
          CAST(per_day AS BIGINT) AS requests_per_day, CAST(60 AS BIGINT) AS retry_after_default
        FROM log JOIN {_LIMITS} USING (platform) GROUP BY ALL"""
    ),
    "platforms": with_base(
        f"""SELECT platform, count(*) AS ads, version, paging, CAST(1000 AS BIGINT) AS max_limit, geographic, endpoint
        FROM base JOIN {_SETTINGS} USING (platform) GROUP BY ALL"""
    ),
    "field_coverage": "WITH o AS (SELECT o_orderkey AS k FROM orders)\n"
    + "\nUNION ALL ".join(
        f"SELECT 'meta' AS platform, '{f}' AS field, '{p}' AS path, count(*) FILTER ({test}) AS items FROM o"
        for f, p, test in _PATHS
    ),
    "page_counters": _paged(
        f"""SELECT platform, request_id, page_no, {sql_time('fetched_at')} AS fetched_at, items,
          CAST(total_count AS BIGINT) AS total_count, next_position FROM with_total"""
    ),
    "page_totals": _paged(
        """SELECT platform, request_id, CAST(sum(items) AS BIGINT) AS items, count(DISTINCT page_no) AS pages_fetched
        FROM with_total GROUP BY platform, request_id"""
    ),
    "page_errors": """
        SELECT CAST(user_id AS VARCHAR) AS request_id, event_id AS page_no, props AS error
        FROM events WHERE event_type = 'error'""",
    "quota_usage": _quota_sql("hour"),
    "quota_usage_day": _quota_sql("day"),
    "quota_stream": _quota_sql("day"),
    "quota_minute": _windows_sql([("minute", 60, 60)]),
    "quota_sliding": _windows_sql([("minute", 60, 10), ("hour", 3600, 300), ("day", 86400, 3600)]),
    "quota_ingested": _windows_sql(
        [("hour", 3600, 300)],
        """ LEFT JOIN (SELECT platform, count(*) AS late FROM log WHERE ts < TIMESTAMP '2024-01-15'
          AND ts < (SELECT max(ts) FROM log) - INTERVAL 10 MINUTE GROUP BY platform) USING (platform)""",
        ", coalesce(late, 0) AS late",
    ),
    "upsert_stream": f"SELECT * EXCLUDE (fetched_at) FROM ({NORMALIZED['normalize_x']})",
    "usage_tier": _logged(
        f"""SELECT platform, CAST({_WAIT} AS BIGINT) AS wait_seconds, count(*) AS n, max(max_usage) AS max_usage
        FROM log GROUP BY platform, {_WAIT}"""
    ),
    "classify_errors": _logged(
        f"""SELECT {sql_time('ts')} AS ts, platform, error_class, retry_seconds, message, kept_body,
          error_class = 'server' AS retryable FROM log"""
    ),
    "fetch_errors": _logged(
        """SELECT platform, error_class, count(*) AS n, max(retry_seconds) AS max_retry_seconds,
          count(*) FILTER (error_class = 'server') AS retryable FROM log GROUP BY platform, error_class"""
    ),
    "ingest_stream": f"SELECT * EXCLUDE (fetched_at) FROM ({NORMALIZED['normalize_x']})",
    "landed_json": NORMALIZED["normalize_booking"],
    "get_all": f"""SELECT * EXCLUDE (ad_text) FROM ({NORMALIZED['normalize_pinterest']})
        WHERE (CAST(ad_id AS BIGINT) // 25) % 40 < 20 AND list_contains(string_split(countries, ','), 'DE')""",
    "stored_ads": with_ads(
        f"""SELECT platform, ad_id, CASE WHEN c1 = c2 THEN c1 ELSE c1 || ', ' || c2 END AS countries,
          nullif(array_to_string(ages, ', '), '') AS targeting_age, spend_range, {sql_time('first_seen')} AS first_seen FROM ads"""
    ),
}

_ONCE = """
once AS (
  SELECT platform, request_id, page_no, count(*) AS copies, arg_max(struct_pack(items := items, next_position := next_position),
    struct_pack(a := fetched_at, b := items, c := total_count, d := coalesce(next_position, ''))) AS v
  FROM with_total GROUP BY ALL
)"""
_AUDITED = """
audited AS (
  SELECT p.platform, p.request_id, p.page_no, p.copies,
    CASE WHEN p.v.next_position IS NOT NULL THEN CASE WHEN n.page_no IS NOT NULL THEN 'followed' ELSE 'missing_next' END
      WHEN n.page_no IS NOT NULL THEN 'past_end' ELSE 'last' END AS state,
    p.page_no > 0 AND b.page_no IS NULL AS gap_before
  FROM once p
  LEFT JOIN once n ON n.request_id = p.request_id AND n.page_no = p.page_no + 1
  LEFT JOIN once b ON b.request_id = p.request_id AND b.page_no = p.page_no - 1
)"""
_COLLECTED = """
collected AS (
  SELECT * FROM (
    SELECT *, min(v.items) OVER (PARTITION BY request_id ORDER BY page_no) AS fewest FROM once WHERE page_no < {0}
  ) WHERE fewest > 0
)"""
_CHAINS = f"""
WITH RECURSIVE lines AS (
  SELECT {_PLATFORM} AS platform, CAST(l_orderkey AS VARCHAR) AS request_id, l_linenumber AS line,
    CASE WHEN l_linenumber > 1 THEN CAST((CASE WHEN l_partkey % 13 = 0 AND l_linenumber > 2 THEN l_linenumber - 2
      ELSE l_linenumber - 1 END) * 25 AS VARCHAR) END AS position,
    CASE WHEN l_linestatus = 'O' THEN CAST(CASE WHEN l_suppkey % 7 = 0 THEN l_linenumber * 25 + 5 WHEN l_suppkey % 5 = 0 THEN 25
      ELSE l_linenumber * 25 END AS VARCHAR) END AS next_position
  FROM lineitem
), once AS (
  SELECT platform, request_id, CAST(line - 1 AS BIGINT) AS page_no, position, next_position FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id, line ORDER BY next_position DESC NULLS LAST, position DESC NULLS LAST) AS r
    FROM lines) WHERE r = 1
), linked AS (
  SELECT p.*, n.page_no IS NOT NULL AS numbered, n.position = p.next_position AS fits,
    CASE WHEN n.position = p.next_position THEN n.page_no
      ELSE (SELECT min(s.page_no) FROM once s WHERE s.request_id = p.request_id AND s.position = p.next_position) END AS succ,
    (SELECT min(s.page_no) FROM once s WHERE s.request_id = p.request_id AND coalesce(s.position, '') = coalesce(p.position, '')) AS same
  FROM once p LEFT JOIN once n ON n.request_id = p.request_id AND n.page_no = p.page_no + 1
), walk AS (
  SELECT request_id, page_no AS origin, succ AS here, 1 AS steps FROM linked WHERE succ IS NOT NULL
  UNION ALL
  SELECT w.request_id, w.origin, l.succ, w.steps + 1 FROM walk w JOIN linked l ON l.request_id = w.request_id AND l.page_no = w.here
  WHERE l.succ IS NOT NULL AND w.steps < 40
), ends AS (
  SELECT request_id, origin, max(steps) AS steps, bool_or(here = origin) AS circle FROM walk GROUP BY ALL
)
SELECT platform, l.request_id, page_no, position, next_position,
  CASE WHEN circle THEN 'loop' WHEN next_position IS NOT NULL AND numbered AND fits IS NOT TRUE THEN 'wrong_position'
    WHEN next_position IS NOT NULL AND succ IS NULL THEN 'missing_next' WHEN same < page_no THEN 'branch'
    WHEN next_position IS NOT NULL THEN 'followed' WHEN numbered THEN 'past_end' ELSE 'last' END AS state,
  CASE WHEN e.steps IS NULL THEN 0 WHEN e.steps < 40 THEN CAST(e.steps AS BIGINT) END AS steps
FROM linked l LEFT JOIN ends e ON e.request_id = l.request_id AND e.origin = l.page_no"""

ORACLES |= {
    "page_chains": _CHAINS,
    "page_audit": f"WITH {_PAGES},{_ONCE},{_AUDITED}\nSELECT * FROM audited",
    "page_audit_summary": f"WITH {_PAGES},{_ONCE},{_AUDITED}\n"
    """SELECT platform, request_id, count(*) AS pages, CAST(sum(copies - 1) AS BIGINT) AS repeats,
        count(*) FILTER (gap_before) AS gaps, count(*) FILTER (state = 'missing_next') AS missing_next,
        count(*) FILTER (state = 'past_end') AS past_end FROM audited GROUP BY platform, request_id""",
    "collect_pages": f"WITH {_PAGES},{_ONCE},{_COLLECTED.format(4)}\n"
    "SELECT platform, request_id, page_no, copies FROM collected",
    "collect_pages_broken": f"""WITH {_PAGES},{_ONCE},
ends AS (
  SELECT platform, request_id, min(page_no) AS stop FROM once WHERE v.items = 0 AND page_no % 3 <> 1 GROUP BY platform, request_id
)
SELECT platform, request_id, page_no, copies FROM once LEFT JOIN ends USING (platform, request_id)
WHERE v.items > 0 AND page_no % 3 <> 1 AND (stop IS NULL OR page_no < stop)""",
    "unreadable_pages": f"""WITH {_PAGES}
SELECT platform, count(*) AS pages FROM landed WHERE page_no % 3 = 1 GROUP BY platform""",
    "normalize_unknown": f"""WITH {_PAGES}
SELECT 'new-' || platform AS platform, 'unknown' AS media_type, count(*) AS ads FROM with_total GROUP BY platform""",
    "stored_csv": with_ads(
        """SELECT platform, ad_id, CASE WHEN c1 = c2 THEN c1 ELSE c1 || ', ' || c2 END AS countries,
          nullif(array_to_string(ages, ', '), '') AS targeting_age, spend_range FROM ads"""
    ),
    "collected_bodies": f"WITH {_PAGES},{_ONCE},{_COLLECTED.format(10)}\n"
    """SELECT platform, request_id, count(*) AS copies FROM with_total
    JOIN collected USING (platform, request_id, page_no) GROUP BY platform, request_id""",
}
