"""Search against brute force: batch equals single requests, each pair once, lookups and paging."""

import datetime
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import admosaic
from admosaic.operators import matching, ranking, search
from admosaic.operators.ranking import cut_by_histogram, number_rows, top_per_group
from admosaic.operators.requests import REQUESTS
from admosaic.schema import ads_columns
from admosaic.sources.registry import platform_names

WORDS = ["solar", "wind", "of_the", "offer", "Vote"]
CODES = ["US", "DE", "FR", "GB"]


@pytest.fixture(scope="module")
def ads(spark):
    """A small table in which a third of the ads has one advertiser, and some dates are open."""
    k = F.col("id")

    def pick(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))

    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")).cast("timestamp")
    values = {
        "ad_id": k.cast("string"),
        "platform": pick(platform_names(), k),
        "advertiser_id": F.when(k % 3 == 0, F.lit("1")).otherwise((k % 20).cast("string")),
        "advertiser_name": F.concat(F.lit("Company "), (k % 20).cast("string")),
        "first_seen": day,
        "last_seen": F.when(k % 7 != 0, day + F.expr("INTERVAL 40 DAYS")),
        "ad_text": F.when(k % 13 != 0, F.concat_ws(" ", pick(WORDS, k), pick(WORDS, k + F.floor(k / 5)))),
        "media_type": pick(["image", "video"], k),
        "countries": F.array_distinct(F.array(pick(CODES, k), pick(CODES, F.floor(k / 4)))),
        "languages": F.array(pick(["en", "de"], k)),
        "extra_json": F.to_json(F.struct(pick(["HOUSING_ADS", "OTHER"], k).alias("ad_type"))),
    }
    table = spark.range(1500).select(*ads_columns(values)).cache()
    table.count()
    return table


def requests_table(spark, rows):
    return spark.createDataFrame(rows, REQUESTS)


def test_batch_equals_single_searches(spark, ads):
    shapes = [
        {},
        {"q": "SOLAR"},
        {"q": "of_the"},
        {"q": "wind vote"},
        {"countries": ["us"]},
        {"countries": ["US", "US", "DE"]},
        {"countries": ["FR"], "q": "offer"},
        {"advertisers": ["1"]},
        {"advertisers": ["1", "1"], "countries": ["GB", "US"]},
        {"advertisers": ["company 1", "7"]},
        {"date_from": "2024-02-01", "date_to": "2024-03-15"},
        {"date_from": "2024-06-01"},
        {"date_to": "2024-02-01"},
        {"types": ["HOUSING_ADS"]},
        {"types": ["OTHER"], "media": "IMAGE"},
        {"languages": ["DE"]},
    ]
    rows, expected = [], set()
    collected = None
    for platform in ("amazon", "google", "linkedin", "meta", "x"):
        for i, shape in enumerate(shapes):
            request = f"{platform}{i}"
            rows.append(
                (
                    request, platform, "search_ads", shape.get("q"), shape.get("advertisers"), shape.get("countries"),
                    shape.get("date_from"), shape.get("date_to"), shape.get("types"), shape.get("languages"),
                    shape.get("media"), 1000, None,
                )
            )
            found = admosaic.find_ads(ads, platform, **shape).select(F.lit(request).alias("r"), "ad_id")
            collected = found if collected is None else collected.unionByName(found)
    expected = sorted((r.r, r.ad_id) for r in collected.collect())
    pairs = admosaic.matching_pairs(ads, requests_table(spark, rows))
    assert sorted((r.request_id, r.ad_id) for r in pairs.collect()) == expected
    assert len(expected) > 1000


@pytest.mark.parametrize("few_grams", [0, 64])
def test_patterns_open_their_rarest_gram(spark, monkeypatch, few_grams):
    monkeypatch.setattr(matching, "FEW_GRAMS", few_grams)
    monkeypatch.setattr(matching, "BROADCAST_PATTERNS", few_grams)
    texts = ["solar panels", "the sun", "", "100% of_the x", "a\\b c", "😀 smile 😀", "e f", None, "of the", "öffentlich 日本語文"]
    words = ["solar", "s", "", "%", "0% o", "of_the", "a\\b", "😀 s", "missing word", "日本語", "f e", "the of", "öff"]
    modes = ["contains", "like", "all_terms"]
    rows = [(k + 100 * (p == "y"), p, t) for k, t in enumerate(texts) for p in ("x", "y")]
    table = spark.createDataFrame(rows, "_ad long, platform string, text string")
    patterns = [("x", f"{m}:{w}", m, w) for m in modes for w in words]
    found = matching.pattern_matches(table, spark.createDataFrame(patterns, "platform string, token string, mode string, word string"))

    def has(mode, word, text):
        if mode == "contains":
            return word in text
        if mode == "all_terms":
            return all(t in text for t in word.split())
        return re.search(".*".join(".".join(map(re.escape, part.split("_"))) for part in word.split("%")), text, re.S) is not None

    wanted = [(k, "x", f"{m}:{w}") for k, t in enumerate(texts) if t is not None for m in modes for w in words if has(m, w, t)]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_batch_of_dates_only_without_broadcasts(spark, ads, monkeypatch):
    """Windows before, inside, around and after the ads' dates, open ones, inverted ones, through bins of days."""
    monkeypatch.setattr(matching, "PAIRS_A_TASK", 50)
    monkeypatch.setattr(matching, "NARROW_BINS", 2)
    odd = ads.withColumns({
        "first_seen": F.when(F.col("ad_id").cast("int") % 17 != 0, F.col("first_seen")),
        "last_seen": F.when(F.col("ad_id").cast("int") % 5 == 0, F.col("first_seen") + F.expr("INTERVAL 900 DAYS")).otherwise(F.col("last_seen")),
    }).cache()
    windows = [("2024-01-10", "2024-01-20"), (None, "2024-02-01"), ("2024-06-01", None), ("2020-01-01", "2030-01-01"), ("2024-03-05", "2024-03-05")]
    windows += [("1999-01-01", "1999-02-01"), ("2040-01-01", None), ("2024-05-01", "2024-04-20")]
    platforms = ["x", "google", "linkedin"]
    rows = [(f"{p}{k}", p, "search_ads", None, None, None, a, b, None, None, None, 1000, None) for p in platforms for k, (a, b) in enumerate(windows)]
    wanted = sorted(
        (f"{p}{k}", r["ad_id"]) for p in platforms for k, (a, b) in enumerate(windows)
        for r in admosaic.find_ads(odd, p, date_from=a, date_to=b).select("ad_id").collect()
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = admosaic.matching_pairs(odd, requests_table(spark, rows))
        assert sorted((r["request_id"], r["ad_id"]) for r in pairs.collect()) == wanted
        counts = admosaic.match_counts(odd, requests_table(spark, rows))
        assert {r["request_id"]: r["n"] for r in counts.collect()} == Counter(r for r, _ in wanted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("dense", "group"), [(0, 3), (16, 1 << 13), (10**6, 1 << 13)])
def test_requests_of_one_condition_match_its_ads_once(spark, ads, monkeypatch, dense, group):
    """Forty windows, open and inverted ones too, of one platform: as many pairs as ads, and the pages and counts of single
    searches; some ads have no start, some end before they start, many start on one day."""
    monkeypatch.setattr(matching, "DENSE_DAY", dense)
    monkeypatch.setattr(matching, "REQUESTS_A_GROUP", group)
    k = F.col("ad_id").cast("int")
    odd = ads.withColumns({
        "platform": F.element_at(F.array(*[F.lit(p) for p in ("x", "google", "linkedin")]), (k % 3 + 1).cast("int")),
        "first_seen": F.when(k % 4 == 1, F.lit("2024-04-02 23:59:59.5").cast("timestamp")).when(k % 17 != 0, F.col("first_seen")),
        "last_seen": F.when(k % 5 == 0, F.col("first_seen") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("last_seen")),
    }).cache()
    days = [None, "2023-12-20", "2024-02-01", "2024-04-02", "2024-04-03", "2024-09-09", "2031-01-01"]
    windows = [(a, b) for a in days for b in days][:40]
    shapes = [(f"{p}{n}", p, a, b, n % 9 * 30, n % 4 * 10) for p in ("x", "google", "linkedin") for n, (a, b) in enumerate(windows)]
    rows = [(r, p, "search_ads", None, None, None, a, b, None, None, None, limit, str(skip)) for r, p, a, b, limit, skip in shapes]
    asked, conditions = matching.by_condition(matching.request_rows(search.resolve_requests(requests_table(spark, rows))))
    assert asked.count() == 120 and conditions.count() == 3
    assert matching.condition_pairs(matching.numbered(odd), conditions).count() == 1500
    counts = {r["request_id"]: r["n"] for r in admosaic.match_counts(odd, requests_table(spark, rows)).collect()}
    pages = {}
    for r in admosaic.search_ads_batch(odd, requests_table(spark, rows)).collect():
        pages.setdefault(r["request_id"], []).append(r["ad_id"])
    ends = {p: odd.filter(F.col("platform") == p).select("ad_id", "first_seen", "last_seen").collect() for p in ("x", "google", "linkedin")}

    def matches(ad, platform, a, b):
        first, last = ad["first_seen"], ad["last_seen"]
        start, end = (v and datetime.datetime.fromisoformat(v) for v in (a, b))
        day = datetime.timedelta(days=1)
        running = start is None or last is None or last >= start
        if platform == "google":
            return (start is None or (first is not None and first >= start)) and (end is None or (last is not None and last < end + day))
        if platform == "linkedin":
            return start is None or end is None or (first is not None and first < end and running)
        return (end is None or (first is not None and first < end + day)) and running

    for r, p, a, b, limit, skip in shapes:
        found = [ad for ad in ends[p] if matches(ad, p, a, b)]
        found.sort(key=lambda ad: (ad["first_seen"] is None, -(ad["first_seen"] or datetime.datetime(2030, 1, 1)).timestamp(), ad["ad_id"]))
        assert counts.get(r, 0) == len(found)
        assert sorted(pages.get(r, [])) == sorted(ad["ad_id"] for ad in found[skip : skip + limit])


def test_histogram_keeps_every_row_that_can_be_first(spark):
    rows = [(g, None if k % 9 == 0 else (k * 7) % 23, k, n) for g, n in (("a", 5), ("b", 40), ("c", 0), ("d", 1000)) for k in range(60)]
    table = spark.createDataFrame(rows, "g string, bin int, k int, n int")
    kept = cut_by_histogram(table.drop("n"), "g", F.col("bin"), table.select("g", "n").distinct()).collect()
    for g, n in (("a", 5), ("b", 40), ("c", 0), ("d", 1000)):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        have = {r["k"] for r in kept if r["g"] == g}
        assert {r[2] for r in order[:n]} <= have
        assert len(have) <= n + 6


def test_batch_limit_is_the_first_page(spark, ads):
    rows = [("a", "x", "search_ads", None, None, None, None, None, None, None, None, 5, None)]
    rows += [("b", "meta", "search_ads", None, None, None, None, None, None, None, None, 1000, None)]
    batch = admosaic.search_ads_batch(ads, requests_table(spark, rows)).collect()
    single = admosaic.search_ads(ads, "x", limit=5).collect()
    assert [r.ad_id for r in batch if r.request_id == "a"] == [r.ad_id for r in single]
    assert sum(r.request_id == "b" for r in batch) == admosaic.find_ads(ads, "meta").count() > 25


def test_no_limit_of_a_remote_service_cuts_a_search(spark, ads):
    meta = admosaic.find_ads(ads, "meta").count()
    assert admosaic.search_ads(ads, "meta", limit=500).count() == meta > 25
    google = ads.filter("platform = 'google'")
    many = google.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("_copy")
    assert admosaic.search_ads(many, "google", limit=5_000).count() == min(5_000, many.count()) > 1_000
    assert admosaic.search_ads(many, "google").count() == 100
    assert admosaic.search_ads(ads.withColumn("platform", F.lit("linkedin")), "linkedin").count() == 100
    rows = [("m", "meta", "search_ads", *[None] * 10), ("l", "linkedin", "search_ads", *[None] * 10)]
    both = [ads.withColumn("platform", F.lit(p)) for p in ("meta", "linkedin")]
    batch = admosaic.search_ads_batch(both[0].unionByName(both[1]), requests_table(spark, rows))
    assert {r["request_id"]: r["count"] for r in batch.groupBy("request_id").count().collect()} == {"m": 100, "l": 100}


def test_batch_pages_status_and_faults_as_in_the_single_search(spark, ads):
    rows = [
        ("page", "x", "search_ads", None, None, None, None, None, None, None, None, 5, "10"),
        ("status", "snapchat", "search_ads", None, None, None, None, None, None, None, None, 1000, None),
        ("country", "x", "search_ads", None, None, ["Germany"], None, None, None, None, None, 1000, None),
        ("date", "x", "search_ads", None, None, None, "soon", None, None, None, None, 1000, None),
        ("token", "x", "search_ads", *[None] * 8, 1000, "abc"),
        ("far", "x", "search_ads", *[None] * 8, 1000, "3000000000"),
    ]
    batch = admosaic.search_ads_batch(ads, requests_table(spark, rows), platform_defaults=True).collect()
    got = {name: [r.ad_id for r in batch if r.request_id == name] for name, *_ in rows}
    page = admosaic.search_ads(ads, "x", limit=5, page_token="10", platform_defaults=True).collect()
    status = admosaic.search_ads(ads, "snapchat", limit=1000, platform_defaults=True).collect()
    assert got["page"] == [r.ad_id for r in page] and len(page) == 5
    assert sorted(got["status"]) == sorted(r.ad_id for r in status) and status
    assert got["country"] == got["date"] == got["token"] == got["far"] == []
    errors = {r.request_id: r.errors for r in admosaic.validate_requests(requests_table(spark, rows)).collect()}
    assert errors["token"] == ["page_token must be a number of rows to skip"] and errors["far"] == errors["page"] == []
    with pytest.raises(ValueError, match="page_token"):
        admosaic.search_ads(ads, "x", page_token="abc")
    with pytest.raises(ValueError):
        admosaic.find_ads(ads, "x", countries=["Germany"])
    missing = admosaic.validate_requests(requests_table(spark, [("n", "x", *[None] * 11)])).first()
    assert missing.errors == ["Operation must not be missing"]


def test_date_modes(spark, ads):
    def ids(**request):
        return {int(r.ad_id) for r in admosaic.find_ads(ads, **request).collect()}

    rows = {r.ad_id: r for r in ads.collect()}
    start, end = datetime.datetime(2024, 3, 1), datetime.datetime(2024, 4, 1)

    def expect(platform, test):
        return {int(i) for i, r in rows.items() if r.platform == platform and test(r)}

    window = {"date_from": "2024-03-01", "date_to": "2024-04-01"}
    assert ids(platform="google", **window) == expect(
        "google", lambda r: r.last_seen is not None and r.first_seen >= start and r.last_seen <= end
    )
    assert ids(platform="linkedin", **window) == expect(
        "linkedin", lambda r: r.first_seen < end and (r.last_seen is None or r.last_seen >= start)
    )
    assert ids(platform="x", **window) == expect(
        "x", lambda r: r.first_seen <= end and (r.last_seen is None or r.last_seen >= start)
    )
    assert ids(platform="linkedin", date_from="2024-03-01") == expect("linkedin", lambda r: True)


def test_faults_are_reported_together(ads):
    with pytest.raises(ValueError) as fault:
        admosaic.search_ads(ads, "meta", countries=["USA"], date_from="2024-02-01", date_to="2024-01-01", limit=0)
    assert "USA" in str(fault.value) and "date_from" in str(fault.value) and "limit" in str(fault.value)
    with pytest.raises(ValueError):
        admosaic.search_ads(ads, "myspace")
    with pytest.raises(ValueError):
        admosaic.search_advertisers(ads, limit=1001)
    with pytest.raises(ValueError):
        admosaic.ad_details(ads, [])


def test_fields_and_paging(ads):
    first = admosaic.search_ads(ads, "x", limit=10, fields=["ad_id", "first_seen"])
    second = admosaic.search_ads(ads, "x", limit=10, page_token="10", fields=["ad_id", "first_seen"])
    assert first.columns == ["ad_id", "first_seen"]
    last = first.collect()[-1]
    x = ads.filter("platform = 'x'")
    assert admosaic.page_after(x, 10, last.first_seen, last.ad_id).select("ad_id").collect() == second.select("ad_id").collect()


@pytest.mark.parametrize("rows_sorted", [0, 30])
def test_deep_pages_are_found_by_counts(spark, ads, monkeypatch, rows_sorted):
    """A third of the ads starts at one moment, some never; ids of different lengths."""
    monkeypatch.setattr(search, "SHALLOW", -1)
    monkeypatch.setattr(ranking, "PAGE_ROWS", rows_sorted)
    k = F.col("ad_id").cast("int")
    same = F.when(k % 3 == 0, F.lit("2024-02-02 03:04:05").cast("timestamp")).when(k % 41 != 0, F.col("first_seen"))
    table = ads.withColumn("first_seen", same).select("ad_id", "first_seen").cache()
    rows = table.collect()
    order = sorted(rows, key=lambda r: (r.first_seen is None, -(r.first_seen or datetime.datetime(2030, 1, 1)).timestamp(), r.ad_id))
    for offset, size in ((0, 5), (700, 40), (777, 1), (1480, 100), (1500, 3)):
        page = admosaic.page_of_results(table, size, offset).collect()
        assert [r.ad_id for r in page] == [r.ad_id for r in order[offset : offset + size]]


def test_details(ads):
    got = admosaic.ad_details(ads, ["7", "nope", "3", "7"]).collect()
    assert [r.ad_id for r in got] == ["7", "3", "7"]
    assert [r.ad_id for r in admosaic.missing_ids(ads, ["7", "nope"]).collect()] == ["nope"]


def test_filters_reach_the_scan(spark, ads, tmp_path):
    admosaic.write_ads(ads, str(tmp_path / "ads"), files_per_platform=2)
    stored = spark.read.parquet(str(tmp_path / "ads"))
    assert stored.count() == 1500
    found = admosaic.search_ads(stored, "google", date_from="2024-05-01", fields=["ad_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan and "GreaterThanOrEqual(first_seen" in plan
    assert "ad_text" not in plan.split("ReadSchema")[1]
    admosaic.write_ads(ads, str(tmp_path / "csv"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1500


def test_row_numbers_of_a_large_group(spark):
    """One group holds most rows; numbers are those of the plain order, over several tasks."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), (F.col("id") * 7919 % 3001).alias("v")
    )
    got = number_rows(rows, "g", ["v"], "n").collect()
    for group in ("a", "b"):
        ordered = sorted((r.v, r.n) for r in got if r.g == group)
        assert [n for _, n in ordered] == list(range(1, len(ordered) + 1))


def test_top_per_group_beyond_the_engine_limit(spark):
    rows = spark.range(5000).select(F.lit("g").alias("g"), "id", F.lit(1500).alias("n"))
    got = top_per_group(rows, "g", [F.col("id").desc()], F.col("n"), ["id"])
    assert sorted(r.id for r in got.collect()) == list(range(3500, 5000))


def test_missing_ids_are_numbered(spark, ads):
    some = ads.withColumn("ad_id", F.when(F.col("ad_id").cast("int") % 5 != 0, F.col("ad_id")))
    filled = admosaic.fill_missing_ids(some)
    assert filled.count() == 1500 and filled.filter("ad_id IS NULL").count() == 0
    assert filled.filter("ad_id LIKE 'meta\\_%'").count() == some.filter("platform = 'meta' AND ad_id IS NULL").count()


def test_latest_copy_wins(spark):
    rows = spark.range(900).select(
        F.lit("x").alias("platform"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("ad_id"),
        F.timestamp_seconds("id").alias("fetched_at"),
    )
    latest = admosaic.latest_ads(admosaic.conform_ads(rows)).collect()
    assert len(latest) == 51
    assert {r.ad_id: r.fetched_at for r in latest}["hot"] == datetime.datetime(1970, 1, 1, 0, 14, 57)


def test_requests_of_a_condition_are_answered_in_one_pass_over_its_days():
    """Counts, lowest days and bins as one look at every count for every request gives them."""
    pick = np.random.default_rng(7)
    for span, size in [(4, 0), (4, 30), (60, 300), (900, 300)]:
        days = {(int(a), int(b)) for a, b in pick.integers(-span, span, (size, 2))}
        days |= {(matching.NEVER, 1), (2, matching.RUNNING), (matching.NEVER, matching.RUNNING)} if size else set()
        cells = [(a, b, int(n)) for (a, b), n in zip(sorted(days), pick.integers(1, 30, len(days)), strict=True)]
        asked = [tuple(None if pick.random() < 0.4 else int(v) for v in pick.integers(-span, span, 4)) for _ in range(60)]
        wanted = [None if pick.random() < 0.2 else int(v) for v in pick.integers(0, 400, 60)]
        ints, longs = pa.int32(), pa.int64()
        requests = {"_request": pa.array(range(60), longs), "_condition": pa.array([1] * 60, longs), "wanted": pa.array(wanted, longs)}
        requests |= {name: pa.array(values, ints) for name, values in zip(matching.DAYS, zip(*asked, strict=True), strict=True)}
        columns = [pa.array(values, kind) for values, kind in zip(zip(*cells, strict=True) if cells else ([], [], []), (ints, ints, longs), strict=True)]
        got = matching._answer(pa.table(requests), pa.table(columns, names=["first_day", "last_day", "ads"])).to_pylist()
        none = pa.table(requests).slice(0, 0), pa.table(columns, names=["first_day", "last_day", "ads"])
        assert matching._answer(*none).num_rows == 0
        for answer, (low, high, last_low, last_high), most in zip(got, asked, wanted, strict=True):
            fits = sorted((-a, n) for a, b, n in cells if (low is None and high is None or a != matching.NEVER)
                          and (low is None or a >= low) and (high is None or a <= high)
                          and (last_low is None or b >= last_low) and (last_high is None or b <= last_high))
            assert answer["n"] == sum(n for _, n in fits)
            if fits and most:
                first = [-a for k, (a, _) in enumerate(fits) if sum(n for _, n in fits[:k]) < most]
                assert answer["lowest"] == min(first)
                assert answer["bins"] == sorted(set(first if answer["fine"] else [a // matching.NARROW_DAYS for a in first]))


def test_only_tokens_that_requests_ask_for_are_indexed(spark, monkeypatch):
    """Requests with dates only leave one token an ad, and many tokens of a kind are joined, with the same pairs."""
    k = F.col("id")
    ads = spark.range(300).select(
        k.cast("string").alias("ad_id"), F.lit("x").alias("platform"), (k % 50).cast("string").alias("advertiser_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 90).cast("int")).cast("timestamp").alias("first_seen"),
    ).select(*ads_columns({name: F.col(name) for name in ("ad_id", "platform", "advertiser_id", "first_seen")}))
    rows = [(f"r{i}", "x", [str(i)] if i % 2 else None, f"2024-0{i % 3 + 1}-01") for i in range(40)]
    asked = spark.createDataFrame(rows, "request_id string, platform string, advertisers array<string>, date_to string")
    others = [F.lit(None).cast(field.dataType).alias(field.name) for field in spark.createDataFrame([], REQUESTS).schema if field.name not in asked.columns]
    asked = asked.select("*", *others)
    counted = []
    real = matching.held_tokens
    monkeypatch.setattr(matching, "held_tokens", lambda *a: counted.append(real(*a)) or counted[-1])
    dates = {r.request_id: r.n for r in search.match_counts(ads, asked.withColumn("advertisers", F.lit(None).cast("array<string>"))).collect()}
    assert counted[-1].count() == 300
    one = {r.request_id: r.n for r in search.match_counts(ads, asked).collect()}
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 5)
    assert {r.request_id: r.n for r in search.match_counts(ads, asked).collect()} == one
    starts = [i % 90 for i in range(300)]
    upto = {i: [0, 31, 60][i % 3] for i in range(40)}
    assert dates == {f"r{i}": sum(s <= upto[i] for s in starts) for i in range(40)}
    wanted = {f"r{i}": sum(s <= upto[i] and (i % 2 == 0 or k % 50 == i) for k, s in enumerate(starts)) for i in range(40)}
    assert one == {name: n for name, n in wanted.items() if n}
