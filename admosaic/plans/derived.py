"""Ad-shaped tables and response pages derived from the star schema the queries run on.

Every order is an ad of its customer; its line items give impressions, targeting and end date, and the
document with the order's number gives the text. All rows of all tables take part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.countries import REGION_TO_COUNTRY
from ..functions.literals import string_lists, strings
from ..functions.ranges import impressions_range_text, spend_range_text
from ..schema import ads_columns
from ..sources.registry import platform_names

PLATFORMS = platform_names()
NATION_CODES = "US GB CA AU DE FR IT ES NL BE SE DK NO FI PL CZ HU RO BG HR SI SK LT LV EE".split()
REGIONS = [*REGION_TO_COUNTRY, "Bavaria", "Ontario"]
AGES = [[], ["18-24"], ["18-24", "25-34"], ["35-44", "65+"]]
GENDERS = [[], ["male"], ["female", "male"]]
MEDIA = ["image", "video", "text", "unknown"]
AD_TYPES = ["POLITICAL_AND_ISSUE_ADS", "HOUSING_ADS", "EMPLOYMENT_ADS", "OTHER_ADS", "FINANCIAL_PRODUCTS_AND_SERVICES_ADS"]
FACETS = {"A": "Age", "N": "Gender", "R": "Location"}
PAGE_SIZE = 25
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp"
    ),
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema. Its declared columns spare a look into the files; times are UTC."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows hashed by a key over the session's shuffle partitions.

    The number is given so that narrow rows, which grow in what follows, are not put together again.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def pick(values: list, index: Column) -> Column:
    """The value at a 0-based position of a fixed list of strings or of string lists."""
    options = string_lists(values) if isinstance(values[0], list) else strings(values)
    return F.element_at(options, (index + 1).cast("int"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: number of lines, last shipping date and the targeting facets of its lines."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.max("l_shipdate").alias("last_ship"),
            F.collect_set(F.struct("l_returnflag", "l_linestatus")).alias("flags"),
        )
    )


def order_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: supplier countries with their share of the quantity, in hundredths of a percent.

    Lines are spread by their order once, on which both aggregates and the join with the orders work.
    """
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    lines = spread(lines.select("l_orderkey", "s_nationkey", "l_quantity"), "l_orderkey")
    per_nation = lines.groupBy("l_orderkey", "s_nationkey").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    per_order = per_nation.groupBy("l_orderkey").agg(
        F.collect_list(F.struct("s_nationkey", "q")).alias("nations"), F.sum("q").alias("total")
    )
    shares = F.transform(
        "nations",
        lambda n: F.struct(
            pick(NATION_CODES, n["s_nationkey"]).alias("country"),
            (F.floor(n["q"] * 10000 / F.col("total")) / 100.0).alias("percentage"),
        ),
    )
    return per_order.select("l_orderkey", shares.alias("shares"))


def base(
    spark: SparkSession, sf_dir: str, lines: bool = True, shares: bool = False, text: bool = False, pages: bool = False
) -> DataFrame:
    """One row per order with everything the ad shapes are made of; with ``pages`` also the page it comes on.

    Orders get their customer while they are narrow and are spread by their key once; lines, shares and documents join on
    that partitioning. With ``pages`` the rows are then spread by page, before they grow into items.
    """
    c = F.col
    out = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
    out = spread(out, "o_orderkey")
    if lines:
        out = out.join(order_lines(spark, sf_dir), c("o_orderkey") == c("l_orderkey"), "left").drop("l_orderkey")
    if shares:
        out = out.join(order_shares(spark, sf_dir), c("o_orderkey") == c("l_orderkey"), "left").drop("l_orderkey")
    if text:
        documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
        out = out.join(documents, c("o_orderkey") == c("doc_id"), "left")
    if pages:
        out = spread(out.withColumn("page", F.floor(c("o_orderkey") / PAGE_SIZE)), "page")
    low_known = c("o_orderpriority") != "4-NOT SPECIFIED"
    high_known = low_known & (c("o_orderpriority") != "5-LOW")
    spend = (F.floor(c("o_totalprice") / 1000) * 100).cast("bigint")
    columns = {
        "k": c("o_orderkey"),
        "ad_id": c("o_orderkey").cast("string"),
        "platform": pick(PLATFORMS, c("o_orderkey") % 11),
        "cust": c("o_custkey").cast("string"),
        "name": c("c_name"),
        "segment": c("c_mktsegment"),
        "prio": c("o_orderpriority"),
        "d1": c("o_orderdate"),
        "status": F.when(c("o_orderstatus") == "O", "ACTIVE")
        .when(c("o_orderstatus") == "F", "INACTIVE")
        .otherwise("PENDING"),
        "c1": pick(NATION_CODES, c("c_nationkey")),
        "c2": pick(NATION_CODES, c("o_orderkey") % 25),
        "regions": F.array(pick(REGIONS, c("c_nationkey")), pick(REGIONS, c("o_orderkey") % len(REGIONS))),
        "ages": pick(AGES, c("o_orderkey") % 4),
        "genders": pick(GENDERS, c("o_orderkey") % 3),
        "spend_min": F.when(low_known, spend),
        "spend_max": F.when(high_known, spend + 99),
    }
    if lines:
        n = F.coalesce(c("n_lines"), F.lit(0))
        columns |= {
            "d2": F.greatest(c("o_orderdate"), F.coalesce(c("last_ship"), c("o_orderdate"))),
            "n_lines": n,
            "imp_min": F.when(low_known, n * 1000),
            "imp_max": F.when(high_known, n * 1000 + 999),
            "flags": c("flags"),
        }
    if shares:
        columns["shares"] = c("shares")
    if text:
        columns["ad_text"] = F.coalesce(
            c("text"), F.concat_ws(" ", "c_mktsegment", F.lit("offer"), "o_orderpriority")
        )
        columns["lang"] = c("lang")
    if pages:
        columns["page"] = c("page")
    return out.select(*[v.alias(k) for k, v in columns.items()])


def stored_ads(spark: SparkSession, sf_dir: str, text: bool = False, lines: bool = True) -> DataFrame:
    """The ad table as it would lie in storage: all sources, one ad per order."""
    c = F.col
    b = base(spark, sf_dir, lines=lines, text=text)
    values = {
        "ad_id": c("ad_id"),
        "platform": c("platform"),
        "advertiser_id": c("cust"),
        "advertiser_name": c("name"),
        "status": c("status"),
        "first_seen": c("d1"),
        "media_type": pick(MEDIA, c("k") % 4),
        "countries": F.array_distinct(F.array("c1", "c2")),
        "spend_low": c("spend_min"),
        "spend_high": c("spend_max"),
        "targeting_age": c("ages"),
        "targeting_gender": c("genders"),
        "targeting_locations": c("regions"),
        "extra_json": F.to_json(F.struct(c("ad_id").alias("id"), pick(AD_TYPES, c("k") % 5).alias("ad_type"))),
        "fetched_at": F.timestamp_seconds(F.lit(1704067200) + c("k")),
    }
    if lines:
        values |= {
            "last_seen": c("d2"),
            "impressions_low": c("imp_min"),
            "impressions_high": c("imp_max"),
            "spend_range": spend_range_text(c("spend_min"), c("spend_max")),
            "impressions_range": impressions_range_text(c("imp_min"), c("imp_max")),
            "eu_reach": F.when(c("k") % 2 == 0, (c("n_lines") * 100).cast("string")).otherwise(F.lit("unknown")),
        }
    if text:
        values["ad_text"] = c("ad_text")
        values["languages"] = F.array_compact(F.array("lang"))
    return b.select(*ads_columns(values))


def creatives(spark: SparkSession, sf_dir: str, text: bool = True, missing_ids: bool = False) -> DataFrame:
    """Rows of the political-ads table of google; with ``missing_ids`` low-priority ads have no id."""
    c = F.col
    ad_id = F.when(c("prio") != "5-LOW", c("ad_id")) if missing_ids else c("ad_id")
    return base(spark, sf_dir, text=text).select(
        ad_id.alias("ad_id"),
        F.concat(F.lit("https://adstransparency.example.com/ad/"), "ad_id").alias("ad_url"),
        (c("ad_text") if text else F.lit(None).cast("string")).alias("ad_text"),
        c("cust").alias("advertiser_id"),
        c("name").alias("advertiser_name"),
        c("d1").cast("date").alias("date_range_start"),
        c("d2").cast("date").alias("date_range_end"),
        "regions",
        c("ages").alias("age_targeting"),
        c("genders").alias("gender_targeting"),
        c("spend_min").alias("spend_range_min_usd"),
        c("spend_max").alias("spend_range_max_usd"),
        c("imp_min").alias("impressions_min"),
        c("imp_max").alias("impressions_max"),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(c("k") / PAGE_SIZE) * 60).alias("fetched_at"),
    )


# --- items and pages of the other sources -------------------------------------------------------------------


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _every(n: int, value: Column) -> Column:
    """``value`` for every n-th order, NULL for the others."""
    return F.when(F.col("k") % n == 0, value)


def _not_every(n: int, value: Column) -> Column:
    return F.when(F.col("k") % n != 0, value)


def _url(host: str, column: str) -> Column:
    return F.concat(F.lit(f"https://{host}.example.com/"), F.col(column))


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _targets(**names: str) -> Column:
    return _struct(**{name: F.col(column) for name, column in names.items()})


def _meta() -> Column:
    c = F.col
    millis = F.unix_millis("d1").cast("string")
    return _struct(
        id=c("ad_id"), page_id=c("cust"), page_name=c("name"), page_verification=_every(3, F.lit("verified")),
        ad_snapshot_url=_url("ads", "ad_id"),
        ad_delivery_start_time=F.when(c("k") % 2 == 0, _day("d1")).otherwise(millis),
        ad_delivery_stop_time=_day("d2"), ad_creative_bodies=F.array("ad_text", "segment"),
        media_type=_every(4, F.lit("image")),
        spend=_struct(lower_bound=c("spend_min").cast("string"), upper_bound=c("spend_max").cast("string")),
        impressions=_struct(lower_bound=c("imp_min").cast("string"), upper_bound=c("imp_max").cast("string")),
        eu_total_reach=c("n_lines") * 100,
        beneficiary_payers=_struct(payer=c("name"), beneficiary=c("segment")),
        target_ages=c("ages"), target_gender=F.lit("All"), target_locations=c("regions"),
        impressions_by_country=F.array(_struct(country=c("c1")), _struct(country=c("c2"))),
        demographic_distribution=F.transform(
            "ages", lambda a: _struct(percentage=F.lit("0.25"), age=a, gender=F.lit("unknown"))
        ),
        delivery_by_region=F.array(_struct(percentage=F.lit("0.5"), region=F.element_at("regions", 1))),
    )


def _tiktok() -> Column:
    """Flat items for even orders, nested ones for odd."""
    c, flat = F.col, F.col("k") % 2 == 0

    def when_flat(value: Column) -> Column:
        return F.when(flat, value)

    def when_nested(value: Column) -> Column:
        return F.when(~flat, value)

    return _struct(
        ad_id=when_flat(_every(4, c("ad_id"))), id=when_flat(_not_every(4, c("ad_id"))),
        advertiser_id=when_flat(c("cust")), brand_name=when_flat(c("name")),
        advertiser_verified=when_flat(_every(3, F.lit(True))),
        first_shown_date=when_flat(_day("d1")), end_date=when_flat(_day("d2")), caption=when_flat(c("ad_text")),
        click_url=when_flat(_url("land", "ad_id")), industry=when_flat(c("segment")),
        video_url=when_flat(_url("video", "ad_id")), reach_countries=when_flat(F.array("c1", "c2")),
        targeting=when_flat(
            _struct(age_groups=c("ages"), gender=c("genders"), locations=c("regions"), interests=F.array("prio"))
        ),
        ad=when_nested(
            _struct(
                id=c("ad_id"), first_shown_date=_day("d1"), last_shown_date=_day("d2"), status=c("status"),
                videos=F.array(_struct(url=_url("video", "ad_id"))), image_urls=F.array(_url("image", "ad_id")),
            )
        ),
        advertiser=when_nested(_struct(business_id=c("cust"), business_name=c("name"))),
        reach=when_nested(_struct(unique_users_seen=F.concat(c("n_lines").cast("string"), F.lit("K")))),
        ad_group=when_nested(_struct(targeting_info=_struct(age=c("ages"), gender=c("genders"), country=F.array("c1")))),
    )


def _microsoft() -> Column:
    c = F.col
    asset = F.when(c("k") % 3 == 0, "ImageAsset").when(c("k") % 3 == 1, "VideoAsset").otherwise("TextAsset")
    assets = F.to_json(
        F.array(_struct(AssetUrl=_url("image", "ad_id"), AssetType=asset), _struct(AssetUrl=F.lit(""), AssetType=asset))
    )
    return _struct(
        AdId=c("ad_id"), AdvertiserId=c("cust"), AdvertiserName=c("name"), Title=c("segment"),
        Description=c("ad_text"), DisplayUrl=_url("show", "cust"), DestinationUrl=_url("land", "ad_id"),
        AssetJson=assets, TargetTypes=F.array("prio"),
        AdDetails=_struct(
            StartDate=_day("d1"), EndDate=_day("d2"), TotalImpressionsRange=impressions_range_text(c("imp_min"), c("imp_max"))
        ),
        ImpressionsByCountry=F.array(_struct(Country=c("c1")), _struct(Country=c("c2"))),
    )


def _apple() -> Column:
    c = F.col
    return _struct(
        adId=c("ad_id"), developerId=c("cust"), developerName=c("name"), appCategory=c("segment"),
        firstImpressionDate=F.concat(_day("d1"), F.lit("T10:00:00Z")), lastImpressionDate=_day("d2"),
        countryOrRegion=F.array("c1", "c2"),
        adBanner=_every(2, _struct(subtitle=c("segment"), shortDescription=c("ad_text"))),
        shortDescription=_not_every(2, c("ad_text")),
        adAssets=F.array(
            _struct(pictureUrl=_not_every(3, _url("image", "ad_id")), videoUrl=_every(5, _url("video", "ad_id")))
        ),
        audienceRefinement=_targets(ageTarget="ages", genderTarget="genders", locationTarget="regions"),
    )


def _amazon() -> Column:
    c = F.col
    return _struct(
        id=_every(2, c("ad_id")), ad_id=_not_every(2, c("ad_id")), advertiser_id=c("cust"),
        advertiser_name=_every(3, c("name")), advertiser=_not_every(3, c("segment")), first_shown=_every(2, _day("d1")),
        start_date=_day("d1"), end_date=_day("d2"), creative_text=c("ad_text"), creative_type=_every(2, F.lit("VIDEO")),
        media_type=F.lit("Carousel"), country=c("c1"), spend=spend_range_text(c("spend_min"), c("spend_max")),
        age_targeting=c("ages"), gender_targeting=c("genders"), location_targeting=c("regions"),
    )


def _booking() -> Column:
    c = F.col
    return _struct(
        id=_every(2, c("ad_id")), ad_id=c("ad_id"), start_date=_day("d1"), end_date=_day("d2"),
        ad_text=_every(2, c("ad_text")), description=c("segment"), media_type=pick(["Image", "banner"], c("k") % 2),
        target_countries=F.array("c1", "c2"),
    )


def _pinterest() -> Column:
    c = F.col
    return _struct(
        id=_every(2, c("ad_id")), pin_id=c("ad_id"), advertiser_id=c("cust"), advertiser_name=c("name"),
        created_time=_every(2, _day("d1")), start_time=_day("d1"), end_time=_day("d2"),
        pin_description=_every(3, c("ad_text")), title=c("segment"), image_url=_url("image", "ad_id"),
        link=_url("land", "ad_id"),
        targeting=_struct(
            countries=F.array("c1", "c2"), interests=F.array("segment"), age_bucket=c("ages"), genders=c("genders"),
            geo=c("regions"),
        ),
        keywords=F.array("prio"),
    )


def _snapchat() -> Column:
    """Every seventh preview failed."""
    c = F.col
    preview = _struct(
        AdID=c("ad_id"), OrganizationName=_every(2, c("name")), AdvertiserName=c("segment"), CreatedDate=_day("d1"),
        EndDate=_every(2, _day("d2")), LastServedDate=_day("d2"), Spend=c("spend_min"), SpendUSD=F.lit("0"),
        Impressions=c("imp_min"), CountryCode=c("c1"), AgeTargeting=c("ages"), GenderTargeting=c("genders"),
        GeoTargeting=c("regions"), CandidateBallotInformation=_every(3, _struct(CandidateName=c("segment"))),
    )
    status = F.when(c("k") % 7 == 6, "ERROR").otherwise("SUCCESS")
    return _struct(sub_request_status=status, ad_preview=preview)


def _x() -> Column:
    c = F.col
    kind = pick(["photo", "video", "animated_gif"], c("k") % 3)
    return _struct(
        id=_every(2, c("ad_id")), tweet_id=c("ad_id"), advertiser_id=c("cust"), account_name=c("name"),
        verified=_every(3, F.lit(True)), created_at=_day("d1"), end_time=_day("d2"), tweet_text=c("ad_text"),
        promotion_spend=spend_range_text(c("spend_min"), c("spend_max")),
        media=F.array(_struct(type=kind, url=_url("image", "ad_id"))),
        entities=_struct(
            urls=F.array(_struct(expanded_url=_url("land", "ad_id"))),
            hashtags=F.array(_struct(text=c("segment")), _struct(text=F.lit(""))),
        ),
        geo_targeting=_struct(countries=F.array("c1", "c2"), locations=c("regions")),
        age_targeting=c("ages"), gender_targeting=c("genders"),
    )


def _linkedin() -> Column:
    c = F.col
    facets = F.transform(
        F.array_sort("flags"),
        lambda f: _struct(
            facetName=F.when(f["l_returnflag"] == "A", "Age").when(f["l_returnflag"] == "N", "Gender").otherwise("Location"),
            isIncluded=F.lit(True), includedSegments=F.array(f["l_linestatus"]), isExcluded=F.lit(False),
            excludedSegments=F.array().cast("array<string>"),
        ),
    )
    shares = F.transform(
        "shares",
        lambda s: _struct(
            country=F.concat(F.lit("urn:li:country:"), s["country"]), impressionPercentage=s["percentage"]
        ),
    )
    return _struct(
        adUrl=_url("www.linkedin", "ad_id"), isRestricted=F.lit(False),
        details=_struct(
            type=pick(["SINGLE_IMAGE", "SPONSORED_VIDEO", "TEXT_AD"], c("k") % 3),
            advertiser=_struct(
                advertiserName=c("name"), advertiserUrl=F.concat(F.lit("https://www.linkedin.example.com/company/"), "cust"),
                adPayer=c("segment"),
            ),
            adStatistics=_struct(
                firstImpressionAt=F.unix_millis("d1") + 3_600_000, latestImpressionAt=F.unix_millis("d2"),
                totalImpressions=_struct(**{"from": c("imp_min"), "to": c("imp_max")}),
                impressionsDistributionByCountry=shares,
            ),
            adTargeting=facets,
        ),
    )


ITEMS: dict[str, Callable[[], Column]] = {
    "amazon": _amazon, "apple": _apple, "booking": _booking, "linkedin": _linkedin, "meta": _meta,
    "microsoft": _microsoft, "pinterest": _pinterest, "snapchat": _snapchat, "tiktok": _tiktok, "x": _x,
}
#: Opening and closing text of a page around its comma-joined items.
ENVELOPES = {
    "amazon": ('{"ads":[', '],"total":25}'),
    "apple": ('{"data":[', "]}"),
    "booking": ('{"ads":[', "]}"),
    "linkedin": ('{"elements":[', "]}"),
    "meta": ('{"data":[', "]}"),
    "microsoft": ('{"value":[', "]}"),
    "pinterest": ('{"items":[', "]}"),
    "snapchat": ('{"ad_previews":[', "]}"),
    "tiktok": ('{"data":{"ads":[', "]}}"),
    "x": ('{"data":[', "]}"),
}


def items_of(spark: SparkSession, sf_dir: str, platform: str, pages: bool = False) -> DataFrame:
    """All orders as items of one source: order number and item text, with ``pages`` also the page, by which they lie."""
    needs_shares = platform == "linkedin"
    needs_text = platform not in ("linkedin", "snapchat")
    b = base(spark, sf_dir, shares=needs_shares, text=needs_text, pages=pages)
    return b.select("k", "platform", *["page"] * pages, F.to_json(ITEMS[platform]()).alias("item"))


def as_pages(items: DataFrame, platform: str, operation: str = "search_ads", size: int = PAGE_SIZE) -> DataFrame:
    """Items put into pages of consecutive numbers, ``size`` at most, forty pages to a request."""
    start, end = ENVELOPES[platform]
    page = F.col("page") if "page" in items.columns else F.floor(F.col("k") / size)
    grouped = items.groupBy(page.alias("page")).agg(F.array_join(F.collect_list("item"), ",").alias("list"))
    return grouped.select(
        F.lit(platform).alias("platform"),
        F.lit(operation).alias("operation"),
        F.concat(F.lit(f"{platform}-"), F.floor(F.col("page") / 40).cast("string")).alias("request_id"),
        (F.col("page") % 40).cast("int").alias("page_no"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("page") * 60).alias("fetched_at"),
        F.concat(F.lit(start), "list", F.lit(end)).alias("body"),
    )


def pages_of(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    """All orders as landed pages of one source."""
    return as_pages(items_of(spark, sf_dir, platform, pages=True), platform)


def advertiser_page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as landed advertiser pages of the four sources that have such pages."""
    c = F.col
    customer = table(spark, sf_dir, "customer").withColumn("id", c("c_custkey").cast("string"))
    shapes = {
        "apple": _struct(id=c("id"), name=c("c_name"), type=F.lit("DEVELOPER"), countryCode=pick(NATION_CODES, c("c_nationkey"))),
        "linkedin": _struct(urn=F.concat(F.lit("urn:li:company:"), "id"), name=c("c_name"), url=_url("www", "id")),
        "microsoft": _struct(AdvertiserId=c("id"), AdvertiserName=c("c_name"), VerifiedAdvertiserId=_every_customer(3)),
        "tiktok": _struct(
            advertiser_id=c("id"), advertiser_name=c("c_name"), verified=F.when(c("c_custkey") % 2 == 0, True),
            industry=c("c_mktsegment"),
        ),
    }
    envelopes = {**ENVELOPES, "tiktok": ('{"data":{"advertisers":[', "]}}")}
    shape = F.explode(
        F.array(*[_struct(platform=F.lit(p), item=F.to_json(s)) for p, s in shapes.items()])
    ).alias("s")
    listed = (
        customer.select(c("c_custkey").alias("k"), shape)
        .groupBy("s.platform", F.floor(c("k") / PAGE_SIZE).alias("page"))
        .agg(F.array_join(F.collect_list("s.item"), ",").alias("list"))
    )
    body = None
    for platform in shapes:
        start, end = envelopes[platform]
        text = F.concat(F.lit(start), "list", F.lit(end))
        body = F.when(c("platform") == platform, text) if body is None else body.when(c("platform") == platform, text)
    return listed.select(
        "platform",
        F.lit("advertisers").alias("operation"),
        F.concat_ws("-", "platform", F.lit("advertisers")).alias("request_id"),
        c("page").cast("int").alias("page_no"),
        F.timestamp_seconds(F.lit(1704067200) + c("page") * 60).alias("fetched_at"),
        body.alias("body"),
    )


def _every_customer(n: int) -> Column:
    return F.when(F.col("c_custkey") % n == 0, F.concat(F.lit("v"), "id"))


# --- logs and requests -----------------------------------------------------------------------------------------


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one landed page of its order's request.

    Line numbers repeat and leave gaps, so pages do too. A page holds as many items as the line's
    quantity above ten and says where the next starts unless its status is F. Lines are spread before
    they grow into bodies.
    """
    c = F.col
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").withColumn(
        "platform", pick(PLATFORMS, c("l_orderkey") % 11)
    )
    n = F.greatest(c("l_quantity").cast("int") - 10, F.lit(0))

    def repeated(item: str) -> Column:
        """The item ``n`` times, comma-joined."""
        return F.when(n > 0, F.concat(F.repeat(F.lit(f"{item},"), n - 1), F.lit(item))).when(n == 0, "")

    listed = repeated('{"id":"1"}')
    more = c("l_linestatus") == "O"
    offset = ((c("l_linenumber") - 1) * 25).cast("string")
    total = F.when(more, F.lit(1000)).otherwise(F.lit(0)).cast("string")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def if_more(*parts) -> Column:
        return F.when(more, text(*parts)).otherwise(F.lit(""))

    offsets = text(',"pagination":{"offset":', offset, ',"limit":25,"total":', total, "}")
    preview = repeated('{"sub_request_status":"SUCCESS","ad_preview":{"AdID":"1"}}')
    bodies = {
        "amazon": text('{"data":[', listed, "]", offsets, "}"),
        "apple": text('{"data":[', listed, "]", offsets, "}"),
        "booking": text('{"data":[', listed, "]", if_more(',"pagination":{"next":"', offset, '"}'), "}"),
        "google": text('{"creatives":[', listed, "]", if_more(',"paging":{"next_token":"', offset, '"}'), "}"),
        "linkedin": text('{"elements":[', listed, '],"paging":{"start":', offset, ',"count":25,"total":', total, "}}"),
        "meta": text('{"data":[', listed, "]", if_more(',"paging":{"next":"', offset, '"}'), "}"),
        "microsoft": text('{"value":[', listed, "]", if_more(',"@odata.nextLink":"http://x?$skip=', offset, '"'), "}"),
        "pinterest": text('{"items":[', listed, "]", if_more(',"bookmark":"', offset, '"'), "}"),
        "snapchat": text('{"ad_previews":[', preview, "]", if_more(',"paging":{"next_link":"http://x?cursor=', offset, '&a=1"}'), "}"),
        "tiktok": text('{"data":{"ads":[', listed, "]", if_more(',"pagination":{"next_page_token":"', offset, '"}'), "}}"),
        "x": text('{"data":[', listed, '],"meta":{', if_more('"next_token":"', offset, '"'), "}}"),
    }
    body = None
    for platform, value in bodies.items():
        body = F.when(c("platform") == platform, value) if body is None else body.when(c("platform") == platform, value)
    return lines.select(
        "platform",
        F.lit("search_ads").alias("operation"),
        c("l_orderkey").cast("string").alias("request_id"),
        (c("l_linenumber") - 1).cast("int").alias("page_no"),
        c("l_shipdate").alias("fetched_at"),
        body.alias("body"),
    )


def page_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one page of its order's request, with the position it starts at and the next one.

    Some next positions lead five rows too far, some back to the second page, some pages start where the one before does.
    """
    c, line = F.col, F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem")
    own = F.when((c("l_partkey") % 13 == 0) & (line > 2), line - 2).otherwise(line - 1) * 25
    following = F.when(c("l_suppkey") % 7 == 0, line * 25 + 5).when(c("l_suppkey") % 5 == 0, F.lit(25)).otherwise(line * 25)
    return lines.select(
        pick(PLATFORMS, c("l_orderkey") % 11).alias("platform"),
        c("l_orderkey").cast("string").alias("request_id"),
        (line - 1).cast("int").alias("page_no"),
        F.when(line > 1, own.cast("string")).alias("position"),
        F.when(c("l_linestatus") == "O", following.cast("string")).alias("next_position"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one fetch."""
    c = F.col
    status = (
        F.when(c("event_type").isin("view", "click"), 200)
        .when(c("event_type") == "signup", 401)
        .when(c("event_type") == "purchase", 429)
        .otherwise(500)
    )
    calls = F.get_json_object("props", "$.k").cast("double")
    usage = _struct(call_count=calls, total_cputime=F.floor(c("value")) % 100, total_time=F.lit(0))
    wrapped = F.to_json(F.create_map(c("user_id").cast("string"), F.array(usage)))
    header = (
        F.when(c("event_id") % 3 == 0, F.to_json(usage)).when(c("event_id") % 3 == 1, wrapped).otherwise(F.lit("not json"))
    )
    body = (
        F.when(c("event_type") == "signup", F.to_json(_struct(message=c("props"))))
        .when(c("event_type") == "purchase", F.to_json(_struct(debug_message=c("event_type"))))
        .when(c("event_type") == "error", F.lit("oops"))
        .otherwise(F.lit("{}"))
    )
    return table(spark, sf_dir, "events").select(
        "ts",
        pick(PLATFORMS, c("user_id") % 11).alias("platform"),
        c("event_type").alias("endpoint"),
        status.alias("status"),
        F.when(c("event_type") == "purchase", F.floor("value").cast("string")).alias("retry_after"),
        header.alias("usage_header"),
        body.alias("body"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as one request; some are faulty."""
    c, k = F.col, F.col("c_custkey")
    names = [*PLATFORMS, " Meta ", "myspace"]
    day = F.date_add(F.lit("1995-01-01").cast("date"), (k % 2000).cast("int"))
    last = F.date_add(day, F.floor(c("c_acctbal") / 50).cast("int"))
    code = pick(NATION_CODES, c("c_nationkey"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("r"), k.cast("string")).alias("request_id"),
        pick(names, k % 13).alias("platform"),
        pick(["search_ads", "search_ads", "search_ads", "advertisers", "details"], k % 5).alias("operation"),
        pick(["the", "of the", "", "offer", "in"], k % 5).alias("keyword"),
        F.when(k % 4 == 0, F.array(k.cast("string"))).when(k % 4 == 1, F.array(F.lit("Customer#0000001"))).alias("advertisers"),
        F.when(k % 3 == 0, F.array(code))
        .when(k % 3 == 1, F.array(F.lower(code), F.lit("FR")))
        .when(k % 7 == 0, F.array(F.lit("Germany"), code))
        .alias("countries"),
        F.when(k % 11 == 0, F.lit("soon")).when(k % 2 == 0, F.date_format(day, "yyyy-MM-dd")).alias("date_from"),
        F.when(k % 2 == 0, F.date_format(last, "yyyy-MM-dd")).alias("date_to"),
        F.when(k % 6 == 0, F.array(pick(AD_TYPES, k % 5))).alias("types"),
        F.lit(None).cast("array<string>").alias("languages"),
        F.when(k % 8 == 0, F.lit("IMAGE")).alias("media"),
        F.floor(c("c_acctbal") / 8).cast("int").alias("limit"),
        F.when(k % 10 == 0, F.lit("20")).alias("page_token"),
    )
