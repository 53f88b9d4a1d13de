"""Tables that streams keep up to date: ads by key, and quota counts that add up."""

import datetime
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import admosaic
from admosaic.operators.fetchlog import FETCH_LOG, PERIODS
from admosaic.sources.pages import RAW_PAGES
from admosaic.streaming import upsert

AT = datetime.datetime(2024, 5, 1)


def pages(spark, rows):
    """Pages of x: (request, number, minutes, ads as id and text)."""
    out = [
        ("x", "search_ads", r, n, AT + datetime.timedelta(minutes=m), json.dumps({"data": [{"id": i, "text": t} for i, t in ads]}))
        for r, n, m, ads in rows
    ]
    return spark.createDataFrame(out, RAW_PAGES)


def texts(ads):
    return sorted(((r.ad_id, r.ad_text) for r in ads.select("ad_id", "ad_text").collect()), key=str)


def test_streamed_table_equals_the_batch_form(spark, tmp_path):
    """Three runs: repeats, an older copy that comes late, ads without an id."""
    landing, out, state = (str(tmp_path / name) for name in ("landing", "ads", "state"))
    runs = [
        [("r1", 0, 10, [("1", "a"), ("2", "b"), (None, "none")]), ("r1", 1, 11, [("3", "c"), ("1", "a2")])],
        [("r2", 0, 5, [("1", "old"), ("4", "d")]), ("r2", 1, 30, [("2", "b2"), (None, "none")])],
        [("r3", 0, 40, [("5", "e"), ("3", "c2")])],
    ]
    for rows in runs:
        pages(spark, rows).write.mode("append").parquet(landing)
        stream = admosaic.stream_pages(spark, landing, "parquet")
        admosaic.upsert_pages_stream(stream, out, state, ["x"], buckets=3).awaitTermination()
    all_pages = pages(spark, [row for rows in runs for row in rows])
    wanted = texts(admosaic.latest_ads(admosaic.normalize_ads(all_pages, platforms=["x"])))
    assert texts(admosaic.read_upserted(spark, out)) == wanted
    assert ("1", "a2") in wanted and wanted.count((None, "none")) == 2


def test_a_batch_that_failed_or_is_repeated_counts_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "ads")

    def ads(*rows):
        return admosaic.normalize_ads(pages(spark, rows), platforms=["x"])

    first, second = ads(("r", 0, 1, [("1", "a"), (None, "n")])), ads(("r", 1, 2, [("1", "b"), ("2", "c"), (None, "m")]))
    admosaic.merge_batch(first, 0, out, 4)
    read = upsert.read_upserted

    def broken(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(upsert, "latest_ads", broken)
    with pytest.raises(RuntimeError):
        admosaic.merge_batch(second, 1, out, 4)
    assert texts(read(spark, out)) == [("1", "a"), (None, "n")]
    monkeypatch.undo()
    # Written, but the list of its buckets never came.
    merged = admosaic.latest_ads(second).withColumn("bucket", upsert.bucket_of(4))
    merged.write.partitionBy("bucket").parquet(f"{out}/ads/batch=1")
    assert texts(read(spark, out)) == [("1", "a"), (None, "n")]
    for _ in range(2):
        admosaic.merge_batch(second, 1, out, 4)
        assert texts(read(spark, out)) == [("1", "b"), ("2", "c"), (None, "m"), (None, "n")]
    admosaic.merge_batch(first.limit(0), 2, out, 4)
    assert len(texts(read(spark, out))) == 4


def test_only_touched_buckets_are_written(spark, tmp_path):
    out = tmp_path / "ads"
    many = [("r", 0, 1, [(str(k), "a") for k in range(200)])]
    admosaic.merge_batch(admosaic.normalize_ads(pages(spark, many), platforms=["x"]), 0, str(out), 16)
    admosaic.merge_batch(admosaic.normalize_ads(pages(spark, [("r", 1, 2, [("7", "b")])]), platforms=["x"]), 1, str(out), 16)
    assert len(list((out / "ads" / "batch=0").glob("bucket=*"))) == 16
    assert len(list((out / "ads" / "batch=1").glob("bucket=*"))) == 1
    assert Counter(t for _, t in texts(admosaic.read_upserted(spark, str(out)))) == {"a": 199, "b": 1}


def log(spark, seconds, platform="linkedin"):
    rows = [(None if s is None else AT + datetime.timedelta(seconds=s), platform, "e", 200, None, None, None) for s in seconds]
    return spark.createDataFrame(rows, FETCH_LOG)


def brute(seconds, sliding):
    counts = Counter()
    for s in seconds:
        for period, (length, step) in PERIODS.items():
            step = step if sliding else length
            last = s // step * step
            counts.update((period, start) for start in range(last - length + step, last + 1, step))
    return dict(counts)


@pytest.mark.parametrize("sliding", [True, False])
def test_windows_of_several_limits(spark, sliding):
    rng = random.Random(1)
    seconds = [rng.randrange(4000) for _ in range(300)] + [500] * 70 + [100_000]
    rows = admosaic.quota_windows(log(spark, [*seconds, None]), sliding=sliding).collect()
    got = {(r.period, int((r.period_start - AT).total_seconds())): r for r in rows}
    assert {k: r.requests for k, r in got.items()} == brute(seconds, sliding)
    assert {r.allowed for r in rows if r.period == "minute"} == {60}
    assert any(r.over_limit for r in rows if r.period == "minute")
    usage = admosaic.quota_usage(log(spark, seconds), "hour").collect()
    if not sliding:
        assert {r.period_start: r.requests for r in usage} == {r.period_start: r.requests for r in rows if r.period == "hour"}
    other = admosaic.quota_windows(log(spark, [1], "new"), sliding=False).collect()
    assert sorted((r.period, r.allowed) for r in other) == [("day", 1000), ("hour", 100)]


def test_counts_of_a_stream_add_up_and_late_fetches_are_set_aside(spark, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("landing", "quota", "state"))
    runs = [[10, 20, 5000], [30, 4900, 6000], [6100, 5]]
    for seconds in runs:
        log(spark, seconds).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(FETCH_LOG).parquet(landing)
        admosaic.ingest_quota_stream(stream, out, state).awaitTermination()
    rows = admosaic.read_quota(spark, out).collect()
    got = {(r.period, int((r.period_start - AT).total_seconds())): r.requests for r in rows}
    assert got == brute([s for run in runs for s in run], True)
    late = admosaic.read_late(spark, out).select(F.unix_timestamp("ts").alias("t"), "batch").collect()
    start = spark.range(1).select(F.unix_timestamp(F.lit(AT)).alias("t")).first().t
    assert sorted((r.t - start, r.batch) for r in late) == [(5, 2), (30, 1)]


def test_reports_of_parts_are_reports_of_all(spark, tmp_path):
    path = str(tmp_path / "reports")
    rows = [(str(k), p, a, f"name {a}", "$10 - $20" if k % 3 else None, str(k) if k % 4 else None) for k in range(60) for p in ("x", "meta") for a in ("A", None, f"b{k % 5}")]
    schema = "ad_id string, platform string, advertiser_id string, advertiser_name string, spend_range string, eu_reach string"
    ads = admosaic.conform_ads(spark.createDataFrame(rows, schema)).withColumn("first_seen", F.lit(AT))
    for batch in (0, 1, 2, 1):
        admosaic.add_to_reports(ads.where(F.col("ad_id").cast("int") % 4 >= 3) if batch == 2 else ads.where(F.col("ad_id").cast("int") % 4 == batch), batch, path)
    admosaic.add_to_reports(ads.where(F.col("ad_id").cast("int") % 4 == 2), 3, path)
    for kind in ("summary", "spending", "reach", "advertisers"):
        whole, parts = admosaic.platform_report(ads, kind), admosaic.stored_report(spark, path, kind)
        assert sorted(map(str, parts.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_lookups_in_a_bucketed_table_do_not_move_the_ads(spark, tmp_path):
    ads = admosaic.conform_ads(spark.range(500).select(F.col("id").cast("string").alias("ad_id"), F.lit("x").alias("platform")))
    admosaic.save_ads_by_id(ads, "ads_by_id", 4, str(tmp_path / "ads"))
    wanted = spark.createDataFrame([(str(k * 7), k) for k in range(100)], "ad_id string, position bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = admosaic.ad_details(spark.table("ads_by_id"), wanted)
        assert [r.ad_id for r in found.collect()] == [str(k * 7) for k in range(72)]
        plan = found._jdf.queryExecution().sparkPlan().toString()
        executed = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        # One exchange for the ids, one for the order of the result; none between the ads' scan and the join.
        assert executed.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE ads_by_id")
