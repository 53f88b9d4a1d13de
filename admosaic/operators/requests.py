"""Tables of requests: validation, and translation into each source's own parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.countries import (
    EU_COUNTRIES,
    clean_country_codes,
    countries_to_numbers,
)
from ..functions.dates import date_preset, format_day, parse_day
from ..functions.linkedin import daterange_param
from ..functions.literals import lookup, strings
from ..functions.text import clean_text, percent_encode
from ..sources.registry import platform_names, supports
from ..sources.registry_values import PLATFORMS
from .normalize import META_FIELDS
from .search import META_AD_TYPES, page_token_readable

REQUESTS = (
    "request_id string, platform string, operation string, keyword string, advertisers array<string>, "
    "countries array<string>, date_from string, date_to string, types array<string>, "
    "languages array<string>, media string, limit int, page_token string"
)
OPERATIONS = ("search_ads", "advertisers", "details")
#: Sources whose own page tokens are texts instead of positions.
OPAQUE_TOKENS = ("tiktok",)


def validate_requests(requests: DataFrame) -> DataFrame:
    """Requests with the list of everything that is wrong with each in ``errors``."""
    c = F.col
    platform = F.lower(F.trim("platform"))
    known = platform.isin(*platform_names())
    able = [f"{p}:{op}" for p in platform_names() for op in OPERATIONS if supports(p, op)]
    can = F.concat_ws(":", platform, "operation").isin(*able)
    first, last = parse_day(c("date_from")), parse_day(c("date_to"))
    bad = F.filter("countries", lambda x: ~x.rlike("^[A-Za-z]{2}$"))
    searching = c("operation") == "advertisers"
    opaque = F.coalesce(platform.isin(*OPAQUE_TOKENS), F.lit(False))
    rules = [
        (~F.coalesce(known, F.lit(False)), F.concat(F.lit("Unknown platform: "), F.coalesce(platform, F.lit("")))),
        (c("operation").isNull(), F.lit("Operation must not be missing")),
        (known & ~can & c("operation").isNotNull(), F.concat(platform, F.lit(" does not support "), c("operation"))),
        (F.exists("countries", lambda x: x.isNull()), F.lit("Countries must not be missing")),
        (F.size(bad) > 0, F.concat(F.lit("Invalid country codes: "), F.array_join(bad, ", "))),
        (c("date_from").isNotNull() & first.isNull(), F.lit("Invalid date_from format")),
        (c("date_to").isNotNull() & last.isNull(), F.lit("Invalid date_to format")),
        (first > last, F.lit("date_from must be before or equal to date_to")),
        (c("limit") < 1, F.lit("limit must be a positive integer")),
        (c("limit") > 1000, F.lit("limit cannot exceed 1000")),
        (~opaque & ~page_token_readable(c("page_token")), F.lit("page_token must be a number of rows to skip")),
        (
            searching & (F.trim(F.coalesce(c("keyword"), F.lit(""))) == ""),
            F.lit("Search query is required for advertiser search"),
        ),
    ]
    if "ad_ids" in requests.columns:
        none = F.size(F.filter(F.coalesce(c("ad_ids"), F.array().cast("array<string>")), lambda x: F.trim(x) != "")) == 0
        rules.append(((c("operation") == "details") & none, F.lit("At least one ad_id is required")))
    messages = [F.when(F.coalesce(test, F.lit(False)), F.coalesce(message, F.lit("Invalid request"))) for test, message in rules]
    errors = F.array_compact(F.array(*messages))
    return requests.withColumn("errors", errors)


def valid_requests(requests: DataFrame) -> DataFrame:
    """The requests without a fault, platform names cleaned."""
    checked = validate_requests(requests).filter(F.size("errors") == 0).drop("errors")
    return checked.withColumn("platform", F.lower(F.trim("platform")))


def drop_absent(params: Column) -> Column:
    """A map without its NULL values."""
    return F.map_filter(params, lambda k, v: v.isNotNull())


def _native(platform_defaults: bool) -> dict[str, dict[str, dict[str, Column]]]:
    """Native parameters by source and operation, as expressions over a request row."""
    c = F.col

    def text(name: str) -> Column:
        return clean_text(c(name))

    def first_country(default: str | None = None, allowed: list[str] | None = None) -> Column:
        codes = clean_country_codes(c("countries"))
        if allowed:
            codes = F.array_intersect(codes, strings(allowed))
        found = F.try_element_at(codes, F.lit(1))
        return F.coalesce(found, F.lit(default)) if default and platform_defaults else found

    def listed(codes: Column, sep: str = ",") -> Column:
        return F.when(F.size(codes) > 0, F.array_join(codes, sep))

    def at_most(cap: int) -> Column:
        return F.least(F.coalesce(c("limit"), F.lit(cap)), F.lit(cap)).cast("string")

    def skip() -> Column:
        return F.coalesce(F.trim("page_token").try_cast("bigint"), F.lit(0)).cast("string")

    who = F.try_element_at("advertisers", F.lit(1))
    is_id = who.rlike("^[0-9]+$")
    start, end = format_day(parse_day(c("date_from"))), format_day(parse_day(c("date_to")))
    kind = F.try_element_at("types", F.lit(1))
    token = c("page_token")
    codes = clean_country_codes(c("countries"))
    meta_countries = listed(codes)
    if platform_defaults:
        meta_countries = F.coalesce(meta_countries, F.lit("US"))
    urns = F.transform(codes, lambda x: F.concat(F.lit("urn%3Ali%3Acountry%3A"), x))
    preset = date_preset(parse_day(c("date_from")), parse_day(c("date_to")))
    return {
        "amazon": {
            "search_ads": {
                "advertiser": clean_text(who), "country": first_country("DE", EU_COUNTRIES), "start_date": start,
                "end_date": end, "limit": at_most(100), "offset": skip(),
            },
            "advertisers": {
                "name": text("keyword"), "country": first_country("DE"), "limit": at_most(100), "offset": skip(),
            },
        },
        "apple": {
            "search_ads": {
                name: F.when(who.isNotNull(), value)
                for name, value in {
                    "type": F.lit("DEVELOPER"), "id": who, "countryOrRegion": first_country(),
                    "datePreset": preset, "limit": at_most(100), "offset": skip(),
                }.items()
            },
            "advertisers": {
                "name": text("keyword"), "types": F.lit("APP,DEVELOPER"), "limit": at_most(100), "offset": skip(),
            },
        },
        "booking": {
            "search_ads": {
                "country": first_country(), "search_term": text("keyword"), "start_date": start, "end_date": end,
                "limit": at_most(100), "offset": skip(),
            },
        },
        "google": {
            "search_ads": {
                "creative_text_filter": c("keyword"), "advertiser_name": who, "country_code": listed(codes),
                "date_range_start": start, "date_range_end": end, "LIMIT": at_most(10_000), "OFFSET": skip(),
            },
            "advertisers": {
                "advertiser_name": c("keyword"), "date_range_start": start, "LIMIT": at_most(1000),
            },
        },
        "linkedin": {
            "search_ads": {
                "keyword": text("keyword"), "advertiser": clean_text(who),
                "countries": F.when(
                    F.size(codes) > 0, F.concat(F.lit("(value:List("), F.array_join(urns, ","), F.lit("))"))
                ),
                "dateRange": daterange_param(c("date_from"), c("date_to")), "count": at_most(25), "start": skip(),
            },
            "advertisers": {"name": text("keyword"), "count": at_most(25), "start": skip()},
        },
        "meta": {
            "search_ads": {
                "ad_reached_countries": meta_countries, "search_terms": text("keyword"),
                "ad_type": F.when(kind.isin(*META_AD_TYPES), kind), "ad_delivery_date_min": start,
                "ad_delivery_date_max": end, "languages": listed(c("languages")), "media_type": c("media"),
                "limit": at_most(25), "after": token, "fields": F.lit(",".join(META_FIELDS)),
            },
        },
        "microsoft": {
            "search_ads": {
                "searchText": text("keyword"), "top": at_most(100), "skip": skip(), "advertiserId": who,
                "startDate": start, "endDate": end, "countryCodes": listed(countries_to_numbers(c("countries"))),
            },
            "advertisers": {"searchText": text("keyword"), "top": at_most(100), "skip": skip()},
        },
        "pinterest": {
            "search_ads": {
                "country": first_country("US"), "search_terms": text("keyword"), "advertiser_name": clean_text(who),
                "start_date": start, "end_date": end, "page_size": at_most(100), "bookmark": token,
            },
            "advertisers": {"name": text("keyword"), "page_size": at_most(100), "bookmark": token},
        },
        "snapchat": {
            "search_ads": {
                "CountryCode": first_country("US", ["US", "CA", "GB", "UK"]), "AdvertiserName": clean_text(who),
                "OrganizationName": text("keyword"), "StartDate": start, "EndDate": end, "limit": at_most(100),
                "offset": skip(),
            },
            "advertisers": {
                "OrganizationName": text("keyword"), "CountryCode": first_country("US"), "limit": at_most(100),
                "offset": skip(),
            },
        },
        "tiktok": {
            "search_ads": {
                "country_code": first_country("US"), "search_term": text("keyword"),
                "advertiser_id": F.when(is_id, who), "advertiser_name": F.when(~is_id, clean_text(who)),
                "start_date": start, "end_date": end, "page_size": at_most(100), "page_token": token,
            },
            "advertisers": {
                "country_code": first_country("US"), "advertiser_name": text("keyword"), "page_size": at_most(100),
                "page_token": token,
            },
        },
        "x": {
            "search_ads": {
                "country": first_country("US"), "advertiser_name": clean_text(who), "search_term": text("keyword"),
                "start_date": start, "end_date": end, "count": at_most(100), "next_token": token,
            },
            "advertisers": {
                "name": text("keyword"), "country": first_country("US"), "count": at_most(100), "next_token": token,
            },
        },
    }


def native_params(requests: DataFrame, platform_defaults: bool = False) -> DataFrame:
    """Requests with the parameters their source takes in the map column ``params``."""
    c = F.col
    params = None
    for platform, operations in _native(platform_defaults).items():
        for operation, values in operations.items():
            pairs = []
            for name, value in values.items():
                pairs += [F.lit(name), value.cast("string")]
            here = (c("platform") == platform) & (c("operation") == operation)
            built = drop_absent(F.create_map(*pairs))
            params = F.when(here, built) if params is None else params.when(here, built)
    return requests.withColumn("params", params)


# What sources call the id of the one ad that a details request is for; others have it in their path.
_DETAIL_IDS = {"apple": "ad_id", "booking": "ad_id", "google": "ad_id", "meta": "id", "tiktok": "ad_id"}


def detail_requests(requests: DataFrame, platform_defaults: bool = False) -> DataFrame:
    """One row for each ad that a ``details`` request asks for (list column ``ad_ids``): its source's path and parameters.

    Sources look up one ad at a time. A path that names the ad has its id filled in, percent-encoded; others take the id
    as a parameter. tiktok also takes the first country, by default ``US``. Requests without ids give no rows, repeated and
    missing ids one and none; sources without such lookups give none.
    """
    c = F.col
    endpoints = {p: PLATFORMS[p]["endpoints"]["details"] for p in platform_names() if supports(p, "details")}
    ids = F.array_distinct(F.filter("ad_ids", lambda x: F.trim(x) != ""))
    asked = requests.withColumn("platform", F.lower(F.trim("platform"))).where("operation = 'details'")
    asked = asked.where(c("platform").isin(*endpoints)).withColumn("ad_id", F.explode(ids))
    path = F.regexp_replace(F.try_element_at(lookup(endpoints), c("platform")), F.lit("\\{[A-Za-z_]+\\}"), percent_encode(c("ad_id")))
    country = F.try_element_at(clean_country_codes(c("countries")), F.lit(1))
    country = F.coalesce(country, F.lit("US")) if platform_defaults else country
    name = F.try_element_at(lookup(_DETAIL_IDS), c("platform"))
    own = F.when(name.isNotNull(), F.create_map(F.coalesce(name, F.lit("")), c("ad_id"))).otherwise(F.create_map().cast("map<string,string>"))
    extra = F.when(c("platform") == "tiktok", F.create_map(F.lit("country_code"), country))
    params = F.when(extra.isNotNull(), F.map_concat(own, extra)).otherwise(own)
    return asked.select("request_id", "platform", "operation", "ad_id", path.alias("path"), drop_absent(params).alias("params"))


def request_manifest(
    requests: DataFrame, landed: DataFrame | None = None, platform_defaults: bool = False
) -> DataFrame:
    """What is still to collect: valid requests without a landed page, in native parameters.

    Where requests have ``ad_ids``, those for details come as one row for each ad, with its id; see `detail_requests` for
    their paths.
    """
    backlog = valid_requests(requests)
    if landed is not None:
        backlog = backlog.join(landed.select("request_id"), "request_id", "left_anti")
    columns = ["request_id", "platform", "operation", "params"]
    if "ad_ids" not in requests.columns:
        return native_params(backlog, platform_defaults).select(*columns)
    others = native_params(backlog.where("operation <> 'details'"), platform_defaults)
    single = detail_requests(backlog, platform_defaults).select(*columns, "ad_id")
    return others.select(*columns, F.lit(None).cast("string").alias("ad_id")).unionByName(single)
