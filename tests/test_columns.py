"""Golden values of the column jobs."""

from pyspark.sql import functions as F

from admosaic.functions import countries, dates, linkedin, media, ranges, text


def value(spark, column):
    got = spark.range(1).select(column.alias("v")).first().v
    return got


def strings(*values):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def test_countries_param(spark):
    golden = [
        (F.lit(None).cast("array<string>"), None),
        (strings(), None),
        (strings(""), None),
        (strings("   "), None),
        (strings("us"), "(value:List(urn%3Ali%3Acountry%3AUS))"),
        (
            strings("us", "gb", "de"),
            "(value:List(urn%3Ali%3Acountry%3AUS,urn%3Ali%3Acountry%3AGB,urn%3Ali%3Acountry%3ADE))",
        ),
        (strings("us", "GB"), "(value:List(urn%3Ali%3Acountry%3AUS,urn%3Ali%3Acountry%3AGB))"),
    ]
    for column, expected in golden:
        assert value(spark, linkedin.countries_param(column)) == expected


def test_daterange_param(spark):
    golden = [
        (None, "2024-01-01", None),
        ("2024-01-01", None, None),
        ("2024-01-15", "2024-02-20", "(start:(day:15,month:1,year:2024),end:(day:20,month:2,year:2024))"),
        ("2024-03-01", "2024-03-31", "(start:(day:1,month:3,year:2024),end:(day:31,month:3,year:2024))"),
        ("2024-02-29", "2024-03-01", "(start:(day:29,month:2,year:2024),end:(day:1,month:3,year:2024))"),
        ("invalid-date", "2024-01-01", None),
        ("2023-02-29", "2024-01-01", None),
    ]
    for start, end, expected in golden:
        s, e = F.lit(start).cast("string"), F.lit(end).cast("string")
        assert value(spark, linkedin.daterange_param(s, e)) == expected
    bad = linkedin.daterange_error(F.lit("2024-01-01"), F.lit("invalid-date"))
    assert value(spark, bad) == "Invalid date format"
    assert value(spark, linkedin.daterange_error(F.lit("2024-01-01"), F.lit(None).cast("string"))) is None


def test_parse_datetime(spark):
    golden = {
        "1704067200": "2024-01-01 00:00:00",
        "1704067200000": "2024-01-01 00:00:00",
        "2024-01-01": "2024-01-01 00:00:00",
        "2024-01-01T10:30:00+0000": "2024-01-01 10:30:00",
        "2024-01-01T10:30:00.000Z": "2024-01-01 10:30:00",
        "2024-02-30": None,
        "12:30": None,
        "soon": None,
        "": None,
        None: None,
    }
    for written, expected in golden.items():
        got = value(spark, dates.parse_datetime(F.lit(written).cast("string")).cast("string"))
        assert got == expected, written


def test_date_preset(spark):
    def preset(a, b):
        return value(spark, dates.date_preset(F.lit(a).cast("date"), F.lit(b).cast("date")))

    assert preset("2024-01-01", "2024-03-31") == "LAST_90_DAYS"
    assert preset("2024-01-01", "2024-04-01") == "LAST_180_DAYS"
    assert preset("2024-01-01", "2024-06-30") == "LAST_YEAR"
    assert preset("2023-01-01", "2024-06-29") == "LAST_YEAR"
    assert preset(None, "2024-01-01") == "LAST_90_DAYS"


def test_format_day(spark):
    day = F.lit("2024-01-02").cast("date")
    assert value(spark, dates.format_day(day)) == "2024-01-02"
    assert value(spark, dates.format_day(day, "epoch")) == "1704153600000"
    assert value(spark, dates.format_day(day, "custom", "apple")) == "LAST_90_DAYS"
    assert value(spark, dates.format_day(day, "custom", "meta")) == "2024-01-02"


def test_range_round_trip(spark):
    for low, high in [(0, 99), (1000, 4999), (1234567, 7654321), (5, None), (None, None)]:
        a, b = F.lit(low).cast("bigint"), F.lit(high).cast("bigint")
        for written in (ranges.spend_range_text(a, b), ranges.impressions_range_text(a, b)):
            assert value(spark, ranges.range_low(written)) == low
            assert value(spark, ranges.range_high(written)) == high
    assert value(spark, ranges.impressions_range_text(F.lit(1000), F.lit(4999))) == "1,000 - 4,999"
    assert value(spark, ranges.spend_range_text(F.lit(1000), F.lit(None).cast("int"))) == "$1000+"
    assert value(spark, ranges.range_high(F.lit("$1,000 - $5,000"))) == 5000


def test_text(spark):
    assert value(spark, text.clean_text(F.lit(" a\r\n b\t c "))) == "a%20b%20c"
    assert value(spark, text.clean_text(F.lit(" a  b "), encode_spaces=False)) == "a b"
    assert value(spark, text.percent_encode(F.lit("a b*~&é"))) == "a%20b%2A~%26%C3%A9"
    assert value(spark, text.id_from_url(F.lit("https://x/ad/123"))) == "123"
    assert value(spark, text.id_from_url(F.lit("https://x/ad/123/"))) is None
    assert value(spark, text.collapse_list(strings("a", "", None, "b"))) == "a, b"
    assert value(spark, text.collapse_list(strings(*"abcdefg"))) == "a, b, c, d, e, ..."
    assert value(spark, text.collapse_list(strings())) is None
    assert value(spark, text.join_text_parts([F.lit(None).cast("string"), F.lit("b ")])) == "b"


def test_string_list(spark):
    golden = {None: [], "All": ["All"], '["a","b"]': ["a", "b"], "[]": [], '["a",null]': ["a"], "[broken": ["[broken"]}
    for written, expected in golden.items():
        assert value(spark, text.string_list(F.lit(written).cast("string"))) == expected


def test_countries(spark):
    codes = strings(" us", "DE", "", "Germany", None)
    assert value(spark, countries.clean_country_codes(codes)) == ["US", "DE"]
    assert value(spark, countries.rejected_country_codes(codes)) == ["GERMANY"]
    regions = strings("California", "Bavaria", "United States", "Germany")
    assert value(spark, countries.regions_to_countries(regions)) == ["US", "Bavaria", "DE"]
    assert value(spark, countries.countries_to_numbers(strings("US", "JP", "LU"))) == [84, 46]
    assert value(spark, countries.number_to_country(F.lit(31))) == "DE"
    assert value(spark, countries.number_to_country(F.lit(1))) == "1"
    assert len(countries.COUNTRY_TO_NUMBER) == 30 and len(countries.EU_COUNTRIES) == 27


def test_media_types(spark):
    assert value(spark, media.media_type_by_name(F.lit(None).cast("string"), F.lit("VIDEO"))) == "video"
    assert value(spark, media.media_type_by_name(F.lit("banner"))) == "unknown"
    assert value(spark, media.media_type_from_media(strings("photo", "video"))) == "video"
    assert value(spark, media.media_type_from_media(F.lit(None).cast("array<string>"))) == "text"
    assert value(spark, media.media_type_from_urls(strings(""), strings("i"))) == "image"
    assert value(spark, media.collect_urls(strings("a", ""), strings("b"))) == ["a", "b"]


def test_number_suffixes_and_asset_names(spark):
    cases = {"13K": (13_000, None), "1.5M - 2M": (1_500_000, 2_000_000), "10 K-100 K": (10_000, 100_000), "1,200 - 3,400": (1_200, 3_400)}
    for written, wanted in cases.items():
        assert (value(spark, ranges.range_low(F.lit(written))), value(spark, ranges.range_high(F.lit(written)))) == wanted
    assert value(spark, media.media_type_from_assets(strings("ImageAsset", "x"))) == "image"
    assert value(spark, media.media_type_from_assets(strings("VIDEO"))) == "video"
    assert value(spark, text.collapse_list(strings(*"abcdefg"), max_items=None)) == "a, b, c, d, e, f, g"
    assert str(value(spark, dates.day_end(F.lit("2024-05-01").cast("date")))) == "2024-05-01 23:59:59.999999"
