"""Page accounting, fetch log, validation, quality rules and the streams."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

import admosaic
from admosaic.operators import storage
from admosaic.operators.fetchlog import FETCH_LOG
from admosaic.operators.requests import REQUESTS
from admosaic.plans import derived
from admosaic.sources import registry
from admosaic.sources.pages import RAW_PAGES, unreadable_pages
from admosaic.streaming.ingest import PAGES_AT_ONCE, ingest_pages_stream, stream_pages

AT = datetime.datetime(2024, 5, 1)


def x_page(request, number, items, more=True, minutes=0):
    body = {"data": [{"id": f"{request}-{number}-{i}"} for i in range(items)], "meta": {"next_token": "t"} if more else {}}
    return ("x", "search_ads", request, number, AT + datetime.timedelta(minutes=minutes), json.dumps(body))


def test_page_audit_and_collection(spark):
    rows = [
        x_page("a", 0, 2), x_page("a", 1, 2), x_page("a", 1, 3, minutes=5), x_page("a", 3, 1, more=False),
        x_page("b", 0, 2), x_page("b", 1, 0), x_page("b", 2, 2, more=False), x_page("b", 3, 1, more=False),
    ]
    counters = admosaic.page_counters(spark.createDataFrame(rows, RAW_PAGES))
    audit = {(r.request_id, r.page_no): r for r in admosaic.page_audit(counters).collect()}
    states = {key: r.state for key, r in audit.items()}
    assert states == {
        ("a", 0): "followed", ("a", 1): "missing_next", ("a", 3): "last",
        ("b", 0): "followed", ("b", 1): "followed", ("b", 2): "past_end", ("b", 3): "last",
    }
    assert audit[("a", 1)].copies == 2 and audit[("a", 1)].items == 3
    assert [key for key, r in audit.items() if r.gap_before] == [("a", 3)]
    kept = admosaic.collect_pages(counters, 3)
    assert sorted((r.request_id, r.page_no) for r in kept.collect()) == [("a", 0), ("a", 1), ("b", 0)]
    totals = {r.request_id: (r["items"], r.pages_fetched) for r in admosaic.page_totals(counters).collect()}
    assert totals == {"a": (8, 3), "b": (5, 4)}
    bodies = admosaic.collected_bodies(spark.createDataFrame(rows, RAW_PAGES), kept)
    assert bodies.count() == 4
    with pytest.raises(ValueError):
        admosaic.collect_pages(counters, 0)


def test_chains_of_positions(spark):
    """Numbers without a gap whose positions do not fit, run in circles, start twice or lead nowhere; one long request."""
    rows = [
        ("x", "ok", 0, None, "a"), ("x", "ok", 1, "a", "b"), ("x", "ok", 2, "b", None),
        ("new", "wrong", 0, None, "a"), ("new", "wrong", 1, "z", "b"), ("new", "wrong", 2, "b", "c"),
        ("x", "loop", 0, None, "a"), ("x", "loop", 1, "a", "b"), ("x", "loop", 2, "b", "a"),
        ("x", "self", 0, None, "a"), ("x", "self", 1, "a", "a"),
        (None, "branch", 0, None, "a"), (None, "branch", 1, "a", None), (None, "branch", 2, "a", "q"), (None, "branch", 3, "q", None),
        ("x", None, 0, None, "a"), ("x", None, 2, "a", None), ("x", "twice", 0, None, "a"), ("x", "twice", 0, None, None),
        ("x", "none", None, "a", "b"),
    ]
    rows += [("x", "long", k, str(k) if k else None, str(k + 1)) for k in range(300)]
    table = spark.createDataFrame(rows, "platform string, request_id string, page_no int, position string, next_position string")
    got = {(r.platform, r.request_id, r.page_no): (r.state, r.steps) for r in admosaic.page_chains(table).collect()}
    long = {k: v for k, v in got.items() if k[1] == "long"}
    assert long == {("x", "long", k): ("followed" if k < 299 else "missing_next", 299 - k) for k in range(300)}
    assert {k: v for k, v in got.items() if k[1] != "long"} == {
        ("x", "ok", 0): ("followed", 2), ("x", "ok", 1): ("followed", 1), ("x", "ok", 2): ("last", 0),
        ("new", "wrong", 0): ("wrong_position", 0), ("new", "wrong", 1): ("followed", 1), ("new", "wrong", 2): ("missing_next", 0),
        ("x", "loop", 0): ("followed", None), ("x", "loop", 1): ("loop", None), ("x", "loop", 2): ("loop", None),
        ("x", "self", 0): ("followed", None), ("x", "self", 1): ("loop", None),
        (None, "branch", 0): ("followed", 1), (None, "branch", 1): ("past_end", 0), (None, "branch", 2): ("branch", 1),
        (None, "branch", 3): ("last", 0), ("x", None, 0): ("followed", 1), ("x", None, 2): ("last", 0),
        ("x", "twice", 0): ("missing_next", 0),
    }
    assert admosaic.page_chains(table.limit(0)).collect() == []


def test_long_tables_in_small_files_are_not_broadcast(spark, monkeypatch):
    """Rows that take a few bytes each in files take a hundred times that in a broadcast."""
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 1000)
    k = F.col("id")
    pages = spark.range(3000).select(
        F.lit("x").alias("platform"), (k / 3).cast("int").cast("string").alias("request_id"), (k % 3).cast("int").alias("page_no"),
        F.when(k % 3 > 0, (k % 3).cast("string")).alias("position"), (k % 3 + 1).cast("string").alias("next_position"),
    )
    chains = admosaic.page_chains(pages)
    assert "Broadcast" not in chains._jdf.queryExecution().sparkPlan().toString()
    assert {(r.page_no, r.state, r.steps, r.n) for r in chains.groupBy("page_no", "state", "steps").agg(F.count("*").alias("n")).collect()} == {
        (0, "followed", 2, 1000), (1, "followed", 1, 1000), (2, "missing_next", 0, 1000),
    }
    long, short = (storage.stored(spark.range(n), "rows") for n in (1001, 1000))
    assert "SortMergeJoin" in long.join(long.withColumnRenamed("id", "k"), F.col("id") == F.col("k"))._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in short.join(short.withColumnRenamed("id", "k"), F.col("id") == F.col("k"))._jdf.queryExecution().sparkPlan().toString()


def test_pages_of_every_source_are_counted(spark):
    bodies = [('{"paging": {"next": "n"}}', 0), ('{"pagination": {"next_token": 5}}', 1), ("oops", 2), (None, 3), ('{"paging": "x"}', 4)]
    rows = [(p, "search_ads", "r", k, AT, body) for p in ("google", "new", None) for body, k in bodies]
    pages = spark.createDataFrame(rows, RAW_PAGES)
    got = sorted((str(r.platform), r.page_no, r["items"], r.next_position, r.readable) for r in admosaic.page_counters(pages).collect())
    each = [(0, 1, "n", True), (1, 1, "5", True), (2, 0, None, False), (3, 0, None, False), (4, 1, None, True)]
    assert got == [(p, *e) for p in ("None", "google", "new") for e in each]
    assert admosaic.page_counters(pages, ["new"]).count() == 5
    kept = admosaic.collect_pages(admosaic.page_counters(pages))
    assert sorted((str(r.platform), r.page_no) for r in kept.collect()) == [(p, k) for p in ("None", "google", "new") for k in (0, 1, 4)]
    assert admosaic.collected_bodies(pages, kept).count() == 9
    assert admosaic.normalize_ads(pages).count() == 9
    assert admosaic.normalize_ads(pages, platforms=["new", "x"]).count() == 3


def test_streams_read_few_pages_at_once(spark, tmp_path):
    """The size of a reader's batch is a number of rows, 4,096 by default; long pages need a smaller one, the session does not."""
    key, pages = "spark.sql.parquet.columnarReaderBatchSize", spark.createDataFrame([x_page("long", 0, 3)], RAW_PAGES)
    pages.write.parquet(str(tmp_path / "pages"))
    before, stream = spark.conf.get(key), stream_pages(spark, str(tmp_path / "pages"), "parquet")
    assert int(stream.sparkSession.conf.get(key)) == PAGES_AT_ONCE < int(before) == int(spark.conf.get(key))
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        assert stream.sparkSession.conf.get(name) == spark.conf.get(name)
    ingest_pages_stream(stream, str(tmp_path / "ads"), str(tmp_path / "state"), ["x"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ads")).count() == 3


def test_usage_and_errors(spark):
    rows = [
        (AT, "meta", "e", 200, None, '{"call_count": 96, "total_cputime": 1, "total_time": 2}', "{}"),
        (AT, "meta", "e", 401, None, '{"123": [{"call_count": 10, "total_cputime": 81, "total_time": 2}]}', '{"message": "bad"}'),
        (AT, "meta", "e", 429, "30", "oops", '{"debug_message": "slow"}'),
        (AT, "meta", "e", 404, None, None, '{"other": 1}'),
        (AT, "meta", "e", 503, None, '{"call_count": 50}', "x" * 500),
    ]
    log = spark.createDataFrame(rows, FETCH_LOG)
    assert [r.wait_seconds for r in admosaic.usage_tier(log).orderBy("status").collect()] == [90, 10, 0, 0, 0]
    got = {r.status: r for r in admosaic.classify_errors(log).collect()}
    assert {s: r.error_class for s, r in got.items()} == {200: "ok", 401: "auth", 429: "rate_limit", 404: "client", 503: "server"}
    assert got[401].message == "bad" and got[429].message == "slow" and got[429].retry_seconds == 30.0
    assert got[404].message == "Unknown error" and got[503].kept_body is None and got[503].retryable
    assert got[200].message is None and got[200].kept_body is None


def test_quota(spark):
    rows = [(AT + datetime.timedelta(minutes=i), "snapchat", "e", 200, None, None, None) for i in range(6)]
    row = admosaic.quota_usage(spark.createDataFrame(rows, FETCH_LOG)).first()
    assert (row.requests, row.allowed, row.over_limit) == (6, 5, True)


def test_registry(spark):
    assert registry.platform_names() == sorted(registry.platform_names()) and len(registry.platform_names()) == 11
    assert registry.platforms(spark).filter("max_limit = 1000").count() == 11
    assert not registry.supports("meta", "advertisers") and registry.supports("linkedin", "pagination")
    assert not registry.supports("linkedin", "details") and not registry.supports("apple", "keyword_search")
    assert registry.platform_params(spark).filter("platform = 'linkedin' AND native_name IS NULL").count() == 4
    limits = {r.platform: r for r in registry.platform_limits(spark).collect()}
    assert limits["linkedin"].requests_per_day == 1000 and limits["linkedin"].requests_per_minute == 60
    assert registry.source_index(spark).filter("platform = 'meta'").count() == 17


def test_requests(spark):
    rows = [
        ("ok", " Meta ", "search_ads", "climate change", None, ["us", "CA"], "2024-01-01", None, None, None, None, 50, None),
        ("bad", "meta", "advertisers", " ", None, ["USA"], "2024-02-01", "2024-01-01", None, None, None, 2000, None),
        ("none", None, "search_ads", None, None, None, "soon", None, None, None, None, 0, None),
    ]
    requests = spark.createDataFrame(rows, REQUESTS)
    errors = {r.request_id: r.errors for r in admosaic.validate_requests(requests).collect()}
    assert errors["ok"] == []
    assert len(errors["bad"]) == 5 and len(errors["none"]) == 3
    landed = spark.createDataFrame([("other",)], "request_id string")
    (row,) = admosaic.request_manifest(requests, landed).collect()
    assert row.platform == "meta" and row.params["ad_reached_countries"] == "US,CA"
    assert row.params["search_terms"] == "climate%20change" and row.params["limit"] == "25"
    assert "ad_type" not in row.params
    assert admosaic.request_manifest(requests, spark.createDataFrame([("ok",)], "request_id string")).count() == 0


def test_details_are_asked_ad_by_ad(spark):
    rows = [
        ("m", " Meta ", "details", ["de"], ["1", "1", None, "2"]), ("t", "tiktok", "details", ["de", "FR"], ["a b"]),
        ("a", "amazon", "details", None, ["$1/x"]), ("none", "x", "details", None, []), ("null", "x", "details", None, None),
        ("l", "linkedin", "details", None, ["1"]), ("s", "x", "search_ads", None, ["1"]),
    ]
    schema = "request_id string, platform string, operation string, countries array<string>, ad_ids array<string>"
    rest = [f.split(" ", 1) for f in REQUESTS.split(", ") if f.split()[0] not in schema]
    requests = spark.createDataFrame(rows, schema).select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in rest])
    got = sorted(((r.request_id, r.path, r.params) for r in admosaic.detail_requests(requests).collect()), key=str)
    assert got == [
        ("a", "adlib/ads/%241%2Fx", {}), ("m", "ads_archive", {"id": "1"}), ("m", "ads_archive", {"id": "2"}),
        ("t", "ad/detail", {"ad_id": "a b", "country_code": "DE"}),
    ]
    errors = {r.request_id: r.errors for r in admosaic.validate_requests(requests).collect()}
    assert errors["none"] == errors["null"] == ["At least one ad_id is required"] and errors["m"] == errors["s"] == []
    manifest = admosaic.request_manifest(requests).collect()
    assert sorted((r.request_id, str(r.ad_id)) for r in manifest) == [("a", "$1/x"), ("m", "1"), ("m", "2"), ("s", "None"), ("t", "a b")]
    assert all(r.params is not None for r in manifest)


def test_conform_and_check(spark):
    rough = spark.createDataFrame([("1", "x", "DE", "many", "BOGUS")], "ad_id string, platform string, countries string, spend_low string, status string")
    ads = admosaic.conform_ads(rough)
    row = ads.first()
    assert ads.schema.names == admosaic.ADS.names
    assert row.countries == ["DE"] and row.spend_low is None and row.languages == []
    broken = admosaic.check_ads(ads).first().violations
    assert broken == ["fetched_at:not_null", "status:in_list"]
    assert admosaic.empty_ads(spark).count() == 0 and admosaic.empty_ads(spark).schema == ads.schema


def test_reports(spark):
    rows = [
        ("1", "x", "A", "$10 - $20", None), ("2", "x", "A", None, None), ("3", "x", "B", "$5+", "100"),
    ]
    ads = admosaic.conform_ads(
        spark.createDataFrame(rows, "ad_id string, platform string, advertiser_id string, spend_range string, eu_reach string")
    )
    got = {r.advertiser_id: r for r in admosaic.platform_report(ads, "spending").collect()}
    assert (got["A"].spend_low, got["A"].spend_high, got["A"].unknown_low) == (10, 20, 1)
    assert got[None].is_total and got[None].spend_low == 15 and got[None].unknown_high == 2
    ranks = {r.advertiser_id: r.rank for r in admosaic.platform_report(ads, "advertisers").collect()}
    assert ranks == {"A": 1, "B": 2}
    assert admosaic.platform_report(ads).first().advertisers == 2
    with pytest.raises(ValueError):
        admosaic.platform_report(ads, "other")


def land(folder, request, number, ids):
    target = folder / "platform=x" / "operation=search_ads" / f"request_id={request}"
    target.mkdir(parents=True, exist_ok=True)
    (target / f"page_{number}.json").write_text(json.dumps({"data": [{"id": i, "text": f"t{i}"} for i in ids]}))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "ads"), str(tmp_path / "state")

    def ingest():
        pages = admosaic.stream_pages(spark, str(landing))
        admosaic.ingest_pages_stream(pages, out, state, platforms=["x"]).awaitTermination()

    land(landing, "r1", 0, ["1", "2", "3"])
    land(landing, "r1", 1, ["3", "4"])
    ingest()
    land(landing, "r2", 0, ["2", "5"])
    ingest()
    streamed = sorted((r.ad_id, r.ad_text, r.platform) for r in admosaic.latest_ads(spark.read.parquet(out)).collect())
    pages = admosaic.read_raw_pages(spark, str(landing))
    batch = admosaic.latest_ads(admosaic.normalize_ads(pages, platforms=["x"]))
    assert streamed == sorted((r.ad_id, r.ad_text, r.platform) for r in batch.collect())
    assert [i for i, _, _ in streamed] == ["1", "2", "3", "4", "5"]


def test_targeting_and_countries(spark):
    ads = spark.createDataFrame([("1", "x", ["18-24", "25-34"]), ("2", "x", ["18-24"])], "ad_id string, platform string, targeting_age array<string>")
    got = [(r.value, r.n) for r in admosaic.targeting_breakdown(ads, "targeting_age").collect()]
    assert got == [("18-24", 2), ("25-34", 1)]
    assert [r.n for r in admosaic.ads_by_platform(ads).collect()] == [2]
    assert admosaic.advertiser_samples(ads.withColumn("advertiser_name", F.lit("A")), 1).count() == 1


def test_get_all(spark):
    rows = [x_page("a", 0, 2), x_page("a", 1, 2), x_page("a", 2, 0), x_page("a", 3, 1, more=False), x_page("b", 0, 1)]
    pages = spark.createDataFrame(rows, RAW_PAGES)
    assert sorted(r.ad_id for r in admosaic.get_all(pages, "x").collect()) == ["a-0-0", "a-0-1", "a-1-0", "a-1-1", "b-0-0"]
    assert admosaic.get_all(pages, "x", max_pages=1).count() == 3
    assert admosaic.get_all(pages, "x", q="nothing").count() == 0
    with pytest.raises(ValueError):
        admosaic.get_all(pages, "x", "details")


def test_stamp_and_union(spark):
    a = spark.createDataFrame([("1", AT), ("2", None)], "ad_id string, fetched_at timestamp")
    stamped = {r.ad_id: r.fetched_at for r in admosaic.stamp_fetched(a).collect()}
    assert stamped["1"] == AT and stamped["2"] is not None
    b = spark.createDataFrame([("3", "x")], "ad_id string, platform string")
    assert admosaic.union_ads(a, b).columns == ["ad_id", "fetched_at", "platform"]
    assert admosaic.union_ads(a, b).filter("platform IS NULL").count() == 2


def test_stream_keeps_ads_without_id_and_late_pages(spark, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("landing", "ads", "state"))
    body = json.dumps({"data": [{"text": "a"}, {"text": "b"}, {"id": "1", "text": "c"}]})

    def land_page(request, day):
        rows = [("x", "search_ads", request, 0, datetime.datetime(2024, 5, day), body)]
        spark.createDataFrame(rows, RAW_PAGES).write.mode("append").parquet(landing)
        pages = admosaic.stream_pages(spark, landing, "parquet")
        admosaic.ingest_pages_stream(pages, out, state, platforms=["x"]).awaitTermination()

    land_page("r1", 20)
    land_page("r2", 1)
    kept = admosaic.latest_ads(spark.read.parquet(out)).collect()
    assert sorted(r.ad_text for r in kept) == ["a", "a", "b", "b", "c"]


def test_only_a_well_formed_empty_page_ends_a_request(spark):
    bodies = ['{"data":[{"id":"1"}]}', "<html>busy</html>", '{"data":[{"id":"2"}]}', '{"data":[]}', '{"data":[{"id":"3"}]}']
    rows = [("x", "search_ads", "r", k, datetime.datetime(2024, 1, 1), body) for k, body in enumerate(bodies)]
    rows.append(("newsource", "search_ads", "q", 0, datetime.datetime(2024, 1, 1), '{"ads": 1}'))
    pages = spark.createDataFrame(rows, RAW_PAGES)
    counters = admosaic.page_counters(pages)
    kept = admosaic.collect_pages(counters).orderBy("platform", "page_no").collect()
    assert [(r.platform, r.page_no) for r in kept] == [("newsource", 0), ("x", 0), ("x", 2)]
    assert [r.ad_id for r in admosaic.get_all(pages, "x").orderBy("ad_id").collect()] == ["1", "2"]
    assert [r.page_no for r in unreadable_pages(pages).collect()] == [1]
    generic = admosaic.normalize_ads(pages).filter("platform = 'newsource'").collect()
    assert [(r.ad_id, r.extra_json) for r in generic] == [(None, '{"ads": 1}')]


def test_usage_of_several_accounts(spark):
    header = '{"a": [{"call_count": 10, "total_cputime": 1, "total_time": 2}, {"call_count": 99}], "b": [{"total_time": 20}]}'
    log = spark.createDataFrame([(datetime.datetime(2024, 1, 1), "meta", "e", 200, None, header, None)], FETCH_LOG)
    row = admosaic.usage_tier(log).first()
    assert (row.max_usage, row.wait_seconds) == (99.0, 90)


def test_coverage_parses_items_once_and_counts_as_by_path(spark):
    """Null, empty, nested and repeated values, items that are no JSON or cut short; each item is parsed by one expression."""
    texts = [
        '{"id":"1","page_id":2,"spend":{"lower_bound":"1"},"target_ages":[],"beneficiary_payers":{"payer":"a","beneficiary":null}}',
        '{"id":null,"page_name":"","impressions":{},"beneficiary_payers":[{"payer":"a"}],"eu_total_reach":0}',
        '{"id":"1","id":"2","spend":null}', '{"id":"1","page_id":"2', "no json", "", None, "[]", '{"media_type":false}',
    ]
    items = spark.createDataFrame([(t,) for t in texts], "item string")
    found = registry.field_coverage(items, "meta")
    for row in found.collect():
        assert row["items"] == items.where(F.get_json_object("item", f"$.{row['path']}").isNotNull()).count(), row
    assert "try_variant_get" in found._jdf.queryExecution().analyzed().toString()
    tiktok = spark.createDataFrame([('{"ad":{"videos":[{"url":"u"}]}}',)], "item string")
    assert sum(r["items"] for r in registry.field_coverage(tiktok, "tiktok").collect()) == 1


def star(spark, folder, orders=60):
    """Tables of a few orders, some lines and documents and one customer for each ten orders."""
    k = F.col("id")
    rows = spark.range(orders)
    rows.selectExpr(
        "id o_orderkey", "id DIV 10 o_custkey", "'O' o_orderstatus", "id * 900.0D o_totalprice",
        "timestamp '1996-01-01 00:00:00' + make_dt_interval(id) o_orderdate", "'1-URGENT' o_orderpriority",
    ).write.parquet(f"{folder}/orders.parquet")
    rows.selectExpr("id c_custkey", "'n' || id c_name", "cast(id % 25 as int) c_nationkey", "1.0D c_acctbal", "'S' c_mktsegment").write.parquet(
        f"{folder}/customer.parquet"
    )
    rows.where(k % 3 > 0).selectExpr(
        "id l_orderkey", "id l_partkey", "id l_suppkey", "1 l_linenumber", "1.0D l_quantity", "1.0D l_extendedprice", "0.0D l_discount",
        "0.0D l_tax", "'A' l_returnflag", "'O' l_linestatus", "timestamp '1996-09-01 00:00:00' l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    rows.where(k % 4 == 0).selectExpr("id doc_id", "'text ' || id text", "'en' lang", "'s' source", "id n_chars").write.parquet(
        f"{folder}/documents.parquet"
    )


def test_items_are_not_shuffled_into_pages(spark, tmp_path):
    """Rows are spread by page while they are narrow; pages hold the items of all their orders."""
    star(spark, str(tmp_path))
    pages = derived.pages_of(spark, str(tmp_path), "x")
    plan = pages._jdf.queryExecution().sparkPlan().toString() + pages._jdf.queryExecution().executedPlan().toString()
    between = plan[plan.rindex("[collect_list") : plan.rindex("partial_collect_list")]
    assert "Exchange" not in between
    rows = {r["page_no"]: json.loads(r["body"])["data"] for r in pages.collect()}
    assert {n: len(items) for n, items in rows.items()} == {0: 25, 1: 25, 2: 10}
    assert sorted(int(i["tweet_id"]) for items in rows.values() for i in items) == list(range(60))
    assert sum(i["tweet_text"].startswith("text ") for items in rows.values() for i in items) == 15


def test_streams_and_steps_are_written_small(spark, tmp_path):
    star(spark, str(tmp_path / "in"))
    landing, out, state = (str(tmp_path / name) for name in ("landing", "ads", "state"))
    derived.pages_of(spark, str(tmp_path / "in"), "x").write.parquet(landing)
    ingest_pages_stream(stream_pages(spark, landing, "parquet"), out, state, platforms=["x"]).awaitTermination()
    assert spark.read.parquet(out).count() == 60
    assert list((tmp_path / "ads").rglob("*.zstd.parquet")) and not list((tmp_path / "ads").rglob("*.snappy.parquet"))
