"""One hand-written page per source: envelope, mapping and counters."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

import admosaic
from admosaic.operators.normalize import normalize_creatives
from admosaic.schema import ADS
from admosaic.sources.pages import RAW_PAGES
from admosaic.sources.tables import CREATIVES

AT = datetime.datetime(2024, 5, 1)


def page(spark, platform, body, operation="search_ads", page_no=0):
    text = body if isinstance(body, str) else json.dumps(body)
    return spark.createDataFrame([(platform, operation, "r", page_no, AT, text)], RAW_PAGES)


def normalized(spark, platform, body, operation="search_ads"):
    ads = admosaic.normalize_ads(page(spark, platform, body, operation), platforms=[platform])
    assert ads.schema.names == ADS.names
    assert [f.dataType for f in ads.schema] == [f.dataType for f in ADS]
    return [r.asDict(recursive=True) for r in ads.collect()]


def counters(spark, platform, body, operation="search_ads"):
    return admosaic.page_counters(page(spark, platform, body, operation)).first()


def test_meta(spark):
    item = {
        "id": "1", "page_id": "p", "page_name": "P", "ad_delivery_start_time": "2024-01-01T00:00:00+0000",
        "ad_delivery_stop_time": "1704153600", "ad_creative_bodies": ["one", "two"],
        "spend": {"lower_bound": "100", "upper_bound": "499"}, "impressions": {"lower_bound": "1000"},
        "target_gender": "All", "target_ages": ["18", "65+"], "impressions_by_country": [{"country": "DE"}],
        "beneficiary_payers": {"payer": "x", "beneficiary": "y"},
    }
    body = {"data": [item, {"id": "2", "spend": "$5", "page_verification": "verified"}], "paging": {"next": "n"}}
    first, second = normalized(spark, "meta", body)
    assert first["spend_range"] == "$100 - $499" and (first["spend_low"], first["spend_high"]) == (100, 499)
    assert first["impressions_range"] == "1,000+" and first["impressions_high"] is None
    assert first["ad_text"] == "one, two" and first["countries"] == ["DE"]
    assert first["targeting_gender"] == ["All"] and first["targeting_age"] == ["18", "65+"]
    assert first["first_seen"] == datetime.datetime(2024, 1, 1) and first["last_seen"] == datetime.datetime(2024, 1, 2)
    assert first["advertiser_verified"] is False and second["advertiser_verified"] is True
    assert second["spend_range"] == "$5" and second["spend_low"] == 5
    assert json.loads(first["extra_json"])["page_name"] == "P" and first["fetched_at"] == AT
    assert counters(spark, "meta", body).next_position == "n"


def test_tiktok_shapes(spark):
    flat = {"id": "7", "brand_name": "B", "start_date": "2024-01-01", "industry": "I", "targeting": {"interests": ["a"]}}
    nested = {
        "ad": {"id": 9, "status": "ACTIVE", "videos": [{"url": "v"}], "image_urls": ["i"]},
        "advertiser": {"business_name": "N"}, "reach": {"unique_users_seen": "1K-10K"},
    }
    a, b = normalized(spark, "tiktok", {"data": {"ads": [flat, nested], "total_count": 40, "pagination": {"next_page_token": "t"}}})
    assert (a["ad_id"], a["advertiser_name"], a["advertiser_verified"], a["media_type"]) == ("7", "B", False, "video")
    assert a["targeting_interests"] == ["a", "I"]
    assert (b["ad_id"], b["status"], b["media_urls"], b["impressions_range"]) == ("9", "ACTIVE", ["v", "i"], "1K-10K")
    assert [r["ad_id"] for r in normalized(spark, "tiktok", {"data": [{"id": "1"}]})] == ["1"]
    assert [r["ad_id"] for r in normalized(spark, "tiktok", {"data": {"id": "5"}}, "details")] == ["5"]
    got = counters(spark, "tiktok", {"data": {"ads": [flat], "total_count": 40, "pagination": {"next_page_token": "t"}}})
    assert (got.items, got.total_count, got.next_position) == (1, 40, "t")


def test_tiktok_error_page(spark):
    body = {"error": {"message": "quota"}, "data": [{"id": "1"}]}
    assert normalized(spark, "tiktok", body) == []
    assert admosaic.page_errors(page(spark, "tiktok", body)).first().error == "quota"


def test_microsoft(spark):
    assets = json.dumps([{"AssetUrl": "u", "AssetType": "ImageAsset"}, {"AssetUrl": ""}])
    item = {"AdId": 4, "Title": "T", "Description": None, "AssetJson": assets, "TargetTypes": "Age", "DisplayUrl": "d"}
    body = {"value": [item], "@odata.count": 99, "@odata.nextLink": "https://x?$top=1&$skip=24"}
    (ad,) = normalized(spark, "microsoft", body)
    assert (ad["ad_id"], ad["ad_text"], ad["media_type"], ad["media_urls"]) == ("4", "T", "image", ["u"])
    assert ad["targeting_other"] == ["Age"] and ad["advertiser_url"] == "d"
    assert normalized(spark, "microsoft", item, "details")[0]["ad_id"] == "4"
    got = counters(spark, "microsoft", body)
    assert (got.total_count, got.next_position) == (99, "24")


def test_apple(spark):
    one = {
        "adId": "1", "adBanner": {"subtitle": "S", "promotionalText": "P"}, "countryOrRegion": "DE", "appCategory": "Games",
        "adAssets": [{"pictureUrl": "p", "videoUrl": ""}], "firstImpressionDate": "2024-01-01T09:00:00Z",
    }
    two = {"adId": "2", "shortDescription": "D", "adAssets": {"videoUrl": "v"}, "countryOrRegion": ["FR", "IT"]}
    a, b = normalized(spark, "apple", {"data": [one, two]})
    assert (a["ad_text"], a["media_type"], a["countries"]) == ("S P", "image", ["DE"])
    assert a["first_seen"] == datetime.datetime(2024, 1, 1) and a["targeting_interests"] == ["Games"]
    assert (b["ad_text"], b["media_type"], b["media_urls"], b["countries"]) == ("D", "video", ["v"], ["FR", "IT"])
    end = counters(spark, "apple", {"data": [], "pagination": {"offset": 100, "limit": 100, "total": 200}})
    more = counters(spark, "apple", {"data": [], "pagination": {"offset": 0, "limit": 100, "total": 101}})
    assert end.next_position is None and more.next_position == "100"
    countries = admosaic.sources.pages.apple_countries(
        page(spark, "apple", {"data": [{"code": "DE", "name": "Germany"}]}, "countries")
    )
    assert countries.first().asDict() == {"country_code": "DE", "country_name": "Germany", "platform": "apple"}


def test_amazon_and_booking(spark):
    (ad,) = normalized(spark, "amazon", {"ads": [{"ad_id": "3", "advertiser": "A", "creative_type": "Video", "country": "DE"}]})
    assert (ad["ad_id"], ad["advertiser_name"], ad["media_type"], ad["countries"]) == ("3", "A", "video", ["DE"])
    assert counters(spark, "amazon", {"data": [{}], "total": 7}).total_count == 7
    (ad,) = normalized(spark, "booking", {"data": [{"id": "3", "description": "D", "target_countries": "NL"}]})
    assert (ad["advertiser_name"], ad["advertiser_type"]) == ("Booking.com", "travel_platform")
    assert (ad["ad_text"], ad["media_type"], ad["countries"]) == ("D", "unknown", ["NL"])


def test_pinterest_and_x(spark):
    body = {"items": [{"pin_id": "1", "title": "T", "targeting": {"geo": ["US"]}, "keywords": "k"}], "bookmark": "b"}
    (ad,) = normalized(spark, "pinterest", body)
    assert (ad["ad_id"], ad["ad_text"], ad["targeting_locations"], ad["targeting_behaviors"]) == ("1", "T", ["US"], ["k"])
    assert counters(spark, "pinterest", body).next_position == "b"
    item = {
        "tweet_id": "1", "media": [{"type": "photo", "url": "u"}, {"type": "photo", "url": ""}],
        "entities": {"urls": [{"expanded_url": "l"}], "hashtags": [{"text": "h"}, {"text": ""}]},
    }
    (ad,) = normalized(spark, "x", {"data": [item], "meta": {"next_token": "t", "result_count": 50}})
    assert (ad["media_type"], ad["media_urls"], ad["landing_url"], ad["targeting_interests"]) == ("image", ["u"], "l", ["h"])
    assert ad["advertiser_verified"] is False


def test_snapchat(spark):
    good = {"sub_request_status": "SUCCESS", "ad_preview": {"Id": "1", "CandidateBallotInformation": {"CandidateName": "C"}, "Spend": 5}}
    bad = {"sub_request_status": "ERROR", "ad_preview": {"Id": "2"}}
    body = {"ad_previews": [good, bad], "paging": {"next_link": "https://x?cursor=abc&limit=1"}}
    (ad,) = normalized(spark, "snapchat", body)
    assert (ad["ad_id"], ad["advertiser_type"], ad["beneficiary"], ad["spend_range"]) == ("1", "political", "C", "5")
    got = counters(spark, "snapchat", body)
    assert (got.items, got.next_position) == (1, "abc")
    (ad,) = normalized(spark, "snapchat", {"ad_preview": {"AdID": "4"}}, "details")
    assert (ad["ad_id"], ad["advertiser_type"]) == ("4", "advocacy")


LINKEDIN = {
    "adUrl": "https://l/detail/12",
    "details": {
        "type": "SPONSORED_VIDEO",
        "advertiser": {"advertiserName": "N", "advertiserUrl": "https://l/company/77"},
        "adStatistics": {
            "firstImpressionAt": 1704070800000, "totalImpressions": {"from": 1000, "to": 4999},
            "impressionsDistributionByCountry": [{"country": "urn:li:country:US", "impressionPercentage": 25.0}],
        },
        "adTargeting": [
            {"facetName": "Language", "isIncluded": True, "includedSegments": ["English"], "isExcluded": False, "excludedSegments": []},
            {"facetName": "Job Skills", "isIncluded": True, "includedSegments": ["Spark", None]},
        ],
    },
}


def test_linkedin(spark):
    (ad,) = normalized(spark, "linkedin", {"elements": [LINKEDIN]})
    assert (ad["ad_id"], ad["advertiser_id"], ad["media_type"]) == ("12", "77", "video")
    assert (ad["impressions_range"], ad["countries"]) == ("1,000 - 4,999", ["US"])
    assert ad["first_seen"] == datetime.datetime(2024, 1, 1) and ad["targeting_interests"] == ["Spark"]
    got = counters(spark, "linkedin", {"elements": [LINKEDIN], "paging": {"start": 25, "count": 25, "total": 51}})
    assert (got.total_count, got.next_position) == (51, "50")


def test_linkedin_flat(spark):
    items = admosaic.unwrap_pages(page(spark, "linkedin", {"elements": [LINKEDIN, {"adUrl": "u"}]}), ["linkedin"])
    flat = admosaic.linkedin_flat(items)
    assert len(flat.columns) == 13 and all(c.replace("_", "").islower() for c in flat.columns)
    full, empty = flat.collect()
    assert [i.asDict() for i in full.impressions_by_country] == [{"country": "urn:li:country:US", "impression_percentage": 25.0}]
    assert full.ad_targeting[0].facet_name == "Language" and full.ad_targeting[0].excluded_segments == []
    assert empty.impressions_by_country == [] and empty.ad_targeting == []
    wide = admosaic.clean_wide(flat)
    assert wide.first().impression_pct_US == 25.0 and wide.first().impressions_mid == 2999.5
    assert wide.first().targeting_facets == "Job Skills, Language"
    assert admosaic.clean_long(flat).count() == 3


def test_google(spark):
    row = (
        None, "u", "t", "a", "A", datetime.date(2024, 1, 1), None, ["Texas", "Bavaria"], [], ["Male"], 100, None, 1000, 4999,
    )
    ad = normalize_creatives(spark.createDataFrame([row], CREATIVES)).first()
    assert (ad.spend_range, ad.impressions_range, ad.countries) == ("$100+", "1,000 - 4,999", ["US", "Bavaria"])
    assert ad.ad_id is None and ad.advertiser_type == "political"


def test_broken_and_generic_pages(spark):
    assert normalized(spark, "meta", "not json") == []
    items = spark.createDataFrame([('{"a":1}',)], "item string")
    ad = admosaic.normalize_items(items, "elsewhere").first()
    assert (ad.platform, ad.media_type, ad.ad_id, ad.extra_json) == ("elsewhere", "unknown", None, '{"a":1}')


def test_advertisers(spark):
    pages = page(spark, "tiktok", {"data": {"advertisers": [{"advertiser_id": "1", "advertiser_name": "A"}]}}, "advertisers")
    got = admosaic.advertiser_items(pages, "tiktok").first()
    assert (got.advertiser_id, got.verified, got.platform) == ("1", False, "tiktok")
    with pytest.raises(ValueError):
        admosaic.advertiser_items(pages, "meta")


def test_text_files_as_pages(spark, tmp_path):
    folder = tmp_path / "platform=x" / "operation=search_ads" / "request_id=r1"
    folder.mkdir(parents=True)
    for n in range(3):
        (folder / f"page_{n:04d}.json").write_text(json.dumps({"data": [{"id": str(n)}]}, indent=2))
    pages = admosaic.read_raw_pages(spark, str(tmp_path))
    assert [r.page_no for r in pages.orderBy("page_no").collect()] == [0, 1, 2]
    assert pages.select("platform", "operation", "request_id").distinct().first() == ("x", "search_ads", "r1")
    ads = admosaic.normalize_ads(pages, platforms=["x"])
    assert sorted(r.ad_id for r in ads.collect()) == ["0", "1", "2"]
    plan = pages.filter(F.col("platform") == "x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan


def test_counters_parse_a_page_once(spark):
    counters = admosaic.page_counters(page(spark, "tiktok", '{"data":{"ads":[{"ad_id":"1"}],"total_count":7}}'), ["tiktok"])
    assert counters._jdf.queryExecution().analyzed().toString().count("StructField(total_count") == 1
    row = counters.first()
    assert (row["items"], row["total_count"], row["readable"]) == (1, 7, True)


def test_texts_that_are_no_json_are_not_parsed(spark):
    for body, items, readable in [
        ("<html>busy</html>", 0, False), ("  Busy", 0, False), ("true", 0, True), (" null", 0, True), ("", 0, False),
        ('\n{"data":[{"id":"1"}]}', 1, True), ('{"data":[{"id"', 0, False),
    ]:
        row = admosaic.page_counters(page(spark, "meta", body)).first()
        assert (row["items"], row["total_count"], row["readable"]) == (items, items, readable), body
    assert [r["items"] for r in admosaic.page_counters(page(spark, "other", "Busy")).collect()] == [0]


def test_shares_spread_lines_once(spark, tmp_path):
    from admosaic.plans import derived

    lines = [(1, 1, 7, 1, 3.0), (1, 2, 7, 2, 1.0), (1, 1, 8, 3, None), (2, 3, 9, 1, 5.0), (2, 3, 6, 2, 5.0)]
    columns = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    suppliers = [(7, "a", 0), (8, "b", 1), (9, "c", 2)]
    spark.createDataFrame(suppliers, "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    shares = derived.order_shares(spark, str(tmp_path))
    assert shares._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(l_orderkey") == 1
    found = {r["l_orderkey"]: {s["country"]: s["percentage"] for s in r["shares"]} for r in shares.collect()}
    assert found == {1: {"US": 100.0, "GB": None}, 2: {"CA": 100.0}}
