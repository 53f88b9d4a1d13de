"""Ad search: one request, many requests, single ads and advertisers."""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.countries import EU_COUNTRIES, clean_country_codes
from ..functions.dates import date_preset, day_end, day_start, parse_day, preset_days
from ..functions.literals import lookup, strings
from ..sources.registry import platform_names
from .matching import AD, SOUGHT, answers, by_condition, condition_pairs, first_matches, like_pattern, matched, numbered, request_rows, terms
from .normalize import select_fields
from .ranking import narrowed_page, top_per_group
from .storage import stored

# Ad types the meta source filters on; others have no effect.
META_AD_TYPES = (
    "ALL", "POLITICAL_AND_ISSUE_ADS", "EMPLOYMENT_ADS", "HOUSING_ADS", "FINANCIAL_PRODUCTS_AND_SERVICES_ADS",
)
#: Rows of a page when a request does not say, whatever the source, and the most it may ask for.
DEFAULT_LIMIT, MAX_LIMIT = 100, 1000


@dataclass(frozen=True)
class Profile:
    """How one source reads a request.

    ``countries``: ``any`` of the countries given, or only the ``first``, taken from ``allowed`` where
    set. ``keyword``: ``contains``, ``like`` (``%`` and ``_`` are wildcards) or ``all_terms``. ``dates``:
    ``overlap``, ``contained`` or ``served`` (end exclusive, both ends needed). ``default_countries`` and
    ``status`` apply only when platform defaults are asked for.
    """

    countries: str = "any"
    allowed: tuple[str, ...] = ()
    default_countries: tuple[str, ...] = ()
    cap: int = 100
    keyword: str = "contains"
    dates: str = "overlap"
    status: str | None = None


# Country rule, default country, cap of rows, keyword and date rule by source.
PROFILES = {
    "amazon": Profile(countries="first", allowed=tuple(EU_COUNTRIES), default_countries=("DE",)),
    "apple": Profile(default_countries=("DE", "FR"), cap=50),
    "booking": Profile(countries="first"),
    "google": Profile(cap=10_000, keyword="like", dates="contained"),
    "linkedin": Profile(cap=25, keyword="all_terms", dates="served"),
    "meta": Profile(default_countries=("US",), cap=25),
    "microsoft": Profile(cap=1000),
    "pinterest": Profile(countries="first", default_countries=("US",)),
    "snapchat": Profile(status="ACTIVE"),
    "tiktok": Profile(countries="first", default_countries=("US",)),
    "x": Profile(countries="first", default_countries=("US",)),
}


def keyword_matches(text: Column, keyword: str, mode: str) -> Column:
    """Keyword test of a text in lower case."""
    word = keyword.lower()
    if mode == "like":
        return F.like(text, like_pattern(F.lit(word)))
    if mode == "all_terms":
        return reduce(lambda a, b: a & b, [F.contains(text, F.lit(term)) for term in word.split()])
    return F.contains(text, F.lit(word))


def dates_match(first: Column, last: Column, start: Column, end: Column, mode: str) -> Column:
    """Date test of an ad; ``start`` and ``end`` are days, NULL when open. A NULL ``last`` is still running."""
    if mode == "contained":
        starts = start.isNull() | (first >= day_start(start))
        ends = end.isNull() | (last <= day_end(end))
        return starts & ends
    running = last.isNull() | (last >= day_start(start))
    if mode == "served":
        return start.isNull() | end.isNull() | ((first < day_start(end)) & running)
    return (end.isNull() | (first <= day_end(end))) & (start.isNull() | running)


def effective_types(types: list[str], platform: str) -> list[str]:
    """The ad types that restrict a request; none when the source does not know them or ``ALL`` is among them."""
    known = [t for t in types if t in META_AD_TYPES] if platform == "meta" else types
    return [] if "ALL" in known else known


def wanted_countries(countries: list[str], profile: Profile, platform_defaults: bool = False) -> list[str]:
    """`effective_countries` of one request; empty when unrestricted. A country that is no code is an error, as
    leaving it out would widen the request."""
    bad = [c for c in countries if c is None or not re.fullmatch("[A-Za-z]{2}", c.strip())]
    if bad:
        raise ValueError(f"Invalid country codes: {', '.join(map(str, bad))}")
    codes = [c.strip().upper() for c in countries]
    if profile.allowed:
        allowed = [c for c in codes if c in profile.allowed]
        codes = allowed if allowed or platform_defaults else codes
    if profile.countries == "first":
        codes = codes[:1]
    return codes or (list(profile.default_countries) if platform_defaults else [])


def effective_countries(countries: Column, profile: Profile, platform_defaults: bool = False) -> Column:
    """The countries a source looks for: cleaned, cut to what it supports, NULL when unrestricted."""
    codes = clean_country_codes(countries)
    if profile.allowed:
        allowed = F.array_intersect(codes, strings(profile.allowed))
        codes = F.when(F.size(allowed) > 0, allowed) if platform_defaults else F.when(
            F.size(allowed) > 0, allowed
        ).otherwise(codes)
    if profile.countries == "first":
        codes = F.slice(codes, 1, 1)
    # Countries of which none is a code match nothing, instead of everything.
    unreadable = (F.size(countries) > 0) & (F.size(clean_country_codes(countries)) == 0)
    codes = F.when((F.size(codes) > 0) | unreadable, codes)
    if platform_defaults and profile.default_countries:
        codes = F.coalesce(codes, strings(profile.default_countries))
    return codes


def _day(value) -> Column:
    day = F.lit(None).cast("date") if value is None else F.lit(str(value)[:10]).cast("date")
    return day


def find_ads(
    ads: DataFrame,
    platform: str,
    q: str | None = None,
    advertisers: list[str] | None = None,
    countries: list[str] | None = None,
    date_from=None,
    date_to=None,
    types: list[str] | None = None,
    languages: list[str] | None = None,
    media: str | None = None,
    status: str | None = None,
    platform_defaults: bool = False,
    use_date_preset: bool = False,
    keyword_mode: str | None = None,
    date_mode: str | None = None,
) -> DataFrame:
    """All ads that match one request, unordered.

    Conditions on platform, dates, status and media type reach the scan; a condition that was not asked
    for is not in the plan.
    """
    platform = platform.strip().lower()
    if platform not in PROFILES:
        raise ValueError(f"unknown platform: {platform}; known: {', '.join(platform_names())}")
    profile = PROFILES[platform]
    out = ads.filter(F.col("platform") == platform)
    if use_date_preset:
        preset = date_preset(_day(date_from), _day(date_to))
        reference = F.current_date() if date_to is None else _day(date_to)
        out = out.filter(F.col("last_seen") >= F.date_sub(reference, preset_days(preset).cast("int")))
    elif date_from is not None or date_to is not None:
        mode = date_mode or profile.dates
        out = out.filter(dates_match(F.col("first_seen"), F.col("last_seen"), _day(date_from), _day(date_to), mode))
    if status is not None:
        out = out.filter(F.col("status") == status)
    elif platform_defaults and profile.status:
        out = out.filter(F.coalesce("status", F.lit(profile.status)) == profile.status)
    if media is not None and media.upper() != "ALL":
        out = out.filter(F.col("media_type") == media.lower())
    codes = wanted_countries(countries or [], profile, platform_defaults)
    if codes:
        out = out.filter(F.arrays_overlap("countries", strings(codes)))
    if languages:
        out = out.filter(F.arrays_overlap("languages", strings(x.lower() for x in languages)))
    if advertisers:
        test = F.lit(False)
        for name in advertisers:
            if re.fullmatch("[0-9]+", name):
                test = test | (F.col("advertiser_id") == name)
            else:
                test = test | keyword_matches(F.lower("advertiser_name"), name, _name_mode(profile))
        out = out.filter(test)
    if q is not None and q.strip():
        out = out.filter(keyword_matches(F.lower("ad_text"), q.strip(), keyword_mode or profile.keyword))
    kinds = effective_types(types or [], platform)
    if kinds:
        out = out.filter(F.get_json_object("extra_json", "$.ad_type").isin(*kinds))
    return out


def _name_mode(profile: Profile) -> str:
    return "like" if profile.keyword == "like" else "contains"


def newest_first() -> list[Column]:
    """Order of results: latest start first, then the id."""
    return [F.col("first_seen").desc_nulls_last(), F.col("ad_id").asc()]


#: Rows skipped up to which a page is cut from its first rows; beyond, histograms find the rows that hold it.
SHALLOW = 10_000


def page_of_results(ads: DataFrame, size: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` of the ads, newest first.

    For deep pages the ads are counted by month, then where needed by day, second and ever longer beginnings of the id,
    and only the part that holds the page is sorted. `page_after` needs no counting where the last ad seen is known.
    """
    if offset > SHALLOW:
        day, moment = F.unix_date(F.to_date("first_seen")), (F.unix_micros("first_seen"), True)
        levels = [[(F.floor(day / 32), True)], [(day, True)], [moment]]
        levels += [[moment, (F.substring("ad_id", 1, k), False)] for k in (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)]
        ads, offset = narrowed_page(ads, levels, offset, size)
    return ads.orderBy(*newest_first()).offset(offset).limit(size)


def page_after(ads: DataFrame, size: int, first_seen, ad_id: str) -> DataFrame:
    """The ``size`` ads that follow the given one, newest first: a filter instead of skipped rows."""
    later = F.col("first_seen").isNull() & (F.col("ad_id") > ad_id)
    if first_seen is not None:
        start = F.lit(first_seen).cast("timestamp")
        later = (
            (F.col("first_seen") < start)
            | ((F.col("first_seen") == start) & (F.col("ad_id") > ad_id))
            | F.col("first_seen").isNull()
        )
    return ads.filter(later).orderBy(*newest_first()).limit(size)


def search_ads(
    ads: DataFrame,
    platform: str,
    q: str | None = None,
    advertisers: list[str] | None = None,
    countries: list[str] | None = None,
    date_from=None,
    date_to=None,
    types: list[str] | None = None,
    languages: list[str] | None = None,
    media: str | None = None,
    limit: int | None = None,
    page_token: str | int | None = None,
    fields: list[str] | None = None,
    **options,
) -> DataFrame:
    """One page of the ads that match a request, newest first.

    A page holds at most ``limit`` rows, 100 by default; ``page_token`` is the number of rows to skip. How many rows the source's own service sends at once does
    not matter here.
    """
    profile = PROFILES.get(platform.strip().lower(), Profile())
    size = DEFAULT_LIMIT if limit is None else limit
    _check_request(countries, date_from, date_to, size, max(MAX_LIMIT, profile.cap), page_token)
    found = find_ads(
        ads, platform, q, advertisers, countries, date_from, date_to, types, languages, media, **options
    )
    return select_fields(page_of_results(found, size, int(page_token or 0)), fields)


def _check_request(countries, date_from, date_to, limit, most, page_token=None) -> None:
    """Report every fault of a request together."""
    errors = []
    if page_token is not None and not re.fullmatch("[0-9]{1,18}", str(page_token).strip()):
        errors.append("page_token must be a number of rows to skip")
    bad = [c for c in countries or [] if c is None or not re.fullmatch("[A-Za-z]{2}", c)]
    if bad:
        errors.append(f"Invalid country codes: {', '.join(map(str, bad))}")
    days = {}
    for name, value in (("date_from", date_from), ("date_to", date_to)):
        if value is None:
            continue
        try:
            days[name] = datetime.date.fromisoformat(str(value)[:10])
        except ValueError:
            errors.append(f"Invalid {name} format")
    if len(days) == 2 and days["date_from"] > days["date_to"]:
        errors.append("date_from must be before or equal to date_to")
    if limit is None or limit < 1:
        errors.append("limit must be a positive integer")
    elif limit > most:
        errors.append(f"limit cannot exceed {most}")
    if errors:
        raise ValueError("; ".join(errors))


def page_token_readable(token: Column) -> Column:
    """Whether a page token is missing or a number of rows to skip, of up to 18 digits."""
    return token.isNull() | F.trim(token).rlike("^[0-9]{1,18}$")


def resolve_requests(requests: DataFrame, platform_defaults: bool = False) -> DataFrame:
    """Requests with the rules of their platform applied: what to look for, how, and which rows.

    Requests with a date or a page token that cannot be read are left out: without the date they would ask for more, and
    without the token for page one again.
    """
    platform = F.lower(F.trim("platform"))
    rules: dict[tuple, list[str]] = {}
    for name, p in PROFILES.items():
        rules.setdefault((p.countries, p.allowed, p.default_countries if platform_defaults else ()), []).append(name)
    countries = None
    for names in rules.values():
        here = platform.isin(*names)
        wanted = effective_countries(F.col("countries"), PROFILES[names[0]], platform_defaults)
        countries = F.when(here, wanted) if countries is None else countries.when(here, wanted)
    word = F.lower(F.nullif(F.trim("keyword"), F.lit("")))
    start, end = parse_day(F.col("date_from")), parse_day(F.col("date_to"))
    both = start.isNotNull() & end.isNotNull()
    dates, words = _modes("dates", platform), _modes("keyword", platform)
    readable = (start.isNotNull() | F.col("date_from").isNull()) & (end.isNotNull() | F.col("date_to").isNull())
    status = F.lit(None).cast("string")
    if platform_defaults:
        status = F.try_element_at(lookup({name: p.status for name, p in PROFILES.items() if p.status}), platform)
    token = F.col("page_token") if "page_token" in requests.columns else F.lit(None).cast("string")
    readable = readable & page_token_readable(token)
    types = F.when(platform == "meta", F.array_intersect("types", strings(META_AD_TYPES))).otherwise(F.col("types"))
    return requests.where(readable).select(
        "request_id",
        platform.alias("platform"),
        status.alias("r_status"),
        F.when(words["all_terms"], F.array_join(F.array_sort(F.array_distinct(terms(word))), " ")).otherwise(word).alias("r_text"),
        F.when(words["all_terms"], "all_terms").when(words["like"], "like").otherwise("contains").alias("r_text_mode"),
        F.when(F.size("advertisers") > 0, F.transform("advertisers", F.lower)).alias("r_advertisers"),
        F.when(words["like"], "like").otherwise("contains").alias("r_name_mode"),
        countries.alias("r_countries"),
        F.when(dates["contained"], day_start(start)).alias("r_first_min"),
        F.when(dates["overlap"], day_end(end))
        .when(dates["served"] & both, day_start(end) - F.expr("INTERVAL 0.000001 SECOND"))
        .alias("r_first_max"),
        F.when(dates["overlap"] | (dates["served"] & both), day_start(start)).alias("r_last_min"),
        F.when(dates["contained"], day_end(end)).alias("r_last_max"),
        F.when((F.size(types) > 0) & ~F.array_contains(types, "ALL"), types).alias("r_types"),
        F.when(F.size("languages") > 0, F.transform("languages", F.lower)).alias("r_languages"),
        F.when(F.upper("media") != "ALL", F.lower("media")).alias("r_media"),
        F.coalesce(F.col("limit"), F.lit(DEFAULT_LIMIT)).cast("int").alias("r_limit"),
        F.coalesce(F.trim(token).try_cast("bigint"), F.lit(0)).alias("r_skip"),
    )


def _modes(attribute: str, platform: Column) -> dict[str, Column]:
    """For each mode of a profile attribute, whether the platform has it."""
    names: dict[str, list[str]] = {}
    for name, profile in PROFILES.items():
        names.setdefault(getattr(profile, attribute), []).append(name)
    return {mode: platform.isin(*listed) for mode, listed in names.items()}


def matching_pairs(ads: DataFrame, requests: DataFrame, platform_defaults: bool = False) -> DataFrame:
    """Every (request, matching ad) pair once, with the ad's columns and the request's ``r_limit`` and ``r_skip``.

    Pairs are found through the postings of each request's rarest condition (see `matching`); an ad's columns join by
    its number afterwards.
    """
    own, asked = _numbered(ads, requests, platform_defaults)
    pairs = matched(own, asked)
    named = pairs.select("_request", AD).join(asked.select("_request", "request_id", "r_limit", "r_skip"), "_request")
    return named.join(own, AD).select("request_id", "r_limit", "r_skip", *ads.columns)


def _numbered(ads: DataFrame, requests: DataFrame, platform_defaults: bool) -> tuple[DataFrame, DataFrame]:
    return numbered(ads), request_rows(resolve_requests(requests, platform_defaults))


def match_counts(ads: DataFrame, requests: DataFrame, platform_defaults: bool = False) -> DataFrame:
    """How many ads match each request, without the bound on rows; requests that match none are left out.

    Ads are matched with conditions without dates and counted by days, from which each request is answered. Only the columns
    that they are found by are written.
    """
    own, asked = _numbered(ads.select(*SOUGHT), requests, platform_defaults)
    asked, conditions = by_condition(asked)
    counts = answers(condition_pairs(own, conditions), asked, conditions, F.lit(None))
    return counts.select("_request", "n").join(asked.select("_request", "request_id"), "_request").select("request_id", "n")


def search_ads_batch(ads: DataFrame, requests: DataFrame, platform_defaults: bool = False) -> DataFrame:
    """One page of results of every request, newest first within each: ``limit`` rows after the first ``page_token``.

    Counts by days tell how far back each request must look, so that pairs are made only of the first rows and those that
    start on the day of the last of them.
    """
    own, asked = _numbered(ads, requests, platform_defaults)
    asked, conditions = by_condition(asked)
    limit, skip = F.col("r_limit"), F.col("r_skip")
    pairs = stored(condition_pairs(own, conditions), "pairs")
    found = stored(answers(pairs, asked, conditions, F.greatest(limit, F.lit(0)) + skip), "answers")
    few = first_matches(pairs, asked, found).join(asked.select("_request", "r_limit", "r_skip"), "_request")
    best = top_per_group(few, "_request", newest_first(), limit, [AD], skip=skip).select("_request", AD)
    return best.join(asked.select("_request", "request_id"), "_request").join(own, AD).select("request_id", *ads.columns)


def ad_details(ads: DataFrame, ad_ids: DataFrame | list[str], platform: str | None = None) -> DataFrame:
    """The ads of a list of ids, in the order of the list (``position``); unknown ids are left out.

    ``ad_ids`` is a list or a table with ``ad_id`` and ``position``.
    """
    wanted = _ids(ads, ad_ids)
    found = ads if platform is None else ads.filter(F.col("platform") == platform)
    return found.join(wanted, "ad_id").orderBy("position", "platform")


def missing_ids(ads: DataFrame, ad_ids: DataFrame | list[str], platform: str | None = None) -> DataFrame:
    """The ids of a list for which there is no ad."""
    found = ads if platform is None else ads.filter(F.col("platform") == platform)
    return _ids(ads, ad_ids).join(found.select("ad_id"), "ad_id", "left_anti")


def _ids(ads: DataFrame, ad_ids: DataFrame | list[str]) -> DataFrame:
    if isinstance(ad_ids, DataFrame):
        return ad_ids.select("ad_id", "position")
    if not ad_ids:
        raise ValueError("at least one ad id is required")
    return ads.sparkSession.createDataFrame(
        list(zip(ad_ids, range(len(ad_ids)))), "ad_id string, position bigint"
    )


def search_advertisers(
    ads: DataFrame, q: str | None = None, date_from=None, limit: int | None = 100, platform: str | None = None
) -> DataFrame:
    """Advertisers with their number of ads and first and last dates, most ads first.

    ``limit=None`` gives all of them, unordered.
    """
    if limit is not None and not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    found = ads if platform is None else ads.filter(F.col("platform") == platform)
    if q is not None:
        found = found.filter(keyword_matches(F.lower("advertiser_name"), q, "like"))
    if date_from is not None:
        found = found.filter(F.col("first_seen") >= day_start(_day(date_from)))
    grouped = found.groupBy("advertiser_id", "advertiser_name").agg(
        F.count("*").alias("total_ads"),
        F.min("first_seen").alias("first_ad_date"),
        F.max("last_seen").alias("last_ad_date"),
    )
    if limit is None:
        return grouped
    return grouped.orderBy(F.desc("total_ads"), "advertiser_id", "advertiser_name").limit(limit)
