"""Values in the notation of the linkedin source: URNs, facets and request parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import parse_day

# Fixed value: prefix of country identifiers.
COUNTRY_URN = "urn:li:country:"


def strip_country_urn(countries: Column) -> Column:
    """Country codes of a list of country URNs, empties dropped."""
    return F.filter(
        F.transform(countries, lambda x: F.replace(x, F.lit(COUNTRY_URN), F.lit(""))), lambda x: x != ""
    )


def facet_segments(targeting: Column, facet_names: list[str]) -> Column:
    """Included segments of the facets whose name contains one of ``facet_names``, case-blind."""

    def wanted(facet: Column) -> Column:
        name = F.lower(facet["facetName"])
        return reduce(lambda a, b: a | b, [name.contains(asked.lower()) for asked in facet_names])

    segments = F.transform(
        F.filter(targeting, wanted), lambda f: F.coalesce(f["includedSegments"], F.array().cast("array<string>"))
    )
    return F.filter(F.flatten(segments), lambda x: x.isNotNull())


def countries_param(countries: Column) -> Column:
    """Request parameter for a list of countries; NULL when none is left after trimming."""
    codes = F.filter(F.transform(countries, lambda x: F.trim(x)), lambda x: x != "")
    urns = F.transform(codes, lambda x: F.concat(F.lit("urn%3Ali%3Acountry%3A"), F.upper(x)))
    return F.when(F.size(codes) > 0, F.concat(F.lit("(value:List("), F.array_join(urns, ","), F.lit("))")))


def _day_part(day: Column) -> Column:
    return F.format_string("(day:%d,month:%d,year:%d)", F.day(day), F.month(day), F.year(day))


def daterange_param(start: Column, end: Column) -> Column:
    """Request parameter for a range of days; NULL when either end is missing or not a date."""
    first, last = parse_day(start), parse_day(end)
    text = F.concat(F.lit("(start:"), _day_part(first), F.lit(",end:"), _day_part(last), F.lit(")"))
    return F.when(first.isNotNull() & last.isNotNull(), text)


def daterange_error(start: Column, end: Column) -> Column:
    """Message when both ends are given and one is not a date, else NULL."""
    bad = parse_day(start).isNull() | parse_day(end).isNull()
    return F.when(start.isNotNull() & end.isNotNull() & bad, F.lit("Invalid date format"))
