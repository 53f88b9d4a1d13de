"""Country codes: cleaning and the fixed lookups between names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .literals import lookup, strings

# Region name -> ISO country code.
REGION_TO_COUNTRY = {
    "United States": "US", "California": "US", "New York": "US", "Texas": "US", "Florida": "US",
    "United Kingdom": "GB", "Canada": "CA", "Australia": "AU", "Germany": "DE", "France": "FR",
    "Italy": "IT", "Spain": "ES", "Netherlands": "NL", "Belgium": "BE", "Sweden": "SE",
    "Denmark": "DK", "Norway": "NO", "Finland": "FI", "Poland": "PL", "Czech Republic": "CZ",
    "Hungary": "HU", "Romania": "RO", "Bulgaria": "BG", "Croatia": "HR", "Slovenia": "SI",
    "Slovakia": "SK", "Lithuania": "LT", "Latvia": "LV", "Estonia": "EE", "Ireland": "IE",
    "Portugal": "PT", "Greece": "GR", "Cyprus": "CY", "Malta": "MT", "Luxembourg": "LU",
}

# ISO country code -> numeric code.
COUNTRY_TO_NUMBER = {
    "US": 84, "GB": 77, "DE": 31, "FR": 30, "IT": 40, "ES": 65, "NL": 54, "BE": 14, "AT": 11, "SE": 67,
    "DK": 25, "NO": 55, "FI": 29, "PL": 58, "CZ": 24, "HU": 38, "RO": 60, "BG": 17, "HR": 37, "SI": 64,
    "SK": 63, "LT": 45, "LV": 44, "EE": 27, "IE": 39, "PT": 59, "GR": 36, "CY": 23, "MT": 51, "LU": 46,
}

# The 27 EU member states.
EU_COUNTRIES = (
    "AT BE BG HR CY CZ DK EE FI FR DE GR HU IE IT LV LT LU MT NL PL PT RO SK SI ES SE".split()
)


def _upper(codes: Column) -> Column:
    return F.filter(F.transform(codes, lambda x: F.upper(F.trim(x))), lambda x: x != "")


def clean_country_codes(codes: Column) -> Column:
    """Trimmed, upper-case two-letter codes; everything else is left out."""
    return F.filter(_upper(codes), lambda x: x.rlike("^[A-Z]{2}$"))


def rejected_country_codes(codes: Column) -> Column:
    """The codes `clean_country_codes` leaves out, each once."""
    return F.array_except(_upper(codes), clean_country_codes(codes))


def regions_to_countries(regions: Column) -> Column:
    """Country codes of region names, names without a code kept, each once in order of appearance."""
    table = lookup(REGION_TO_COUNTRY)
    return F.array_distinct(F.transform(regions, lambda x: F.coalesce(F.try_element_at(table, x), x)))


def countries_to_numbers(codes: Column) -> Column:
    """Numeric codes of ISO codes, those without one left out."""
    table = lookup(COUNTRY_TO_NUMBER)
    return F.array_compact(F.transform(clean_country_codes(codes), lambda x: F.try_element_at(table, x)))


def countries_without_number(codes: Column) -> Column:
    """The ISO codes `countries_to_numbers` leaves out, each once."""
    known = strings(COUNTRY_TO_NUMBER)
    return F.array_except(clean_country_codes(codes), known)


def number_to_country(number: Column) -> Column:
    """ISO code of a numeric code; an unknown number is kept as text."""
    table = lookup({v: k for k, v in COUNTRY_TO_NUMBER.items()})
    return F.coalesce(F.try_element_at(table, number.cast("int")), number.cast("string"))


def first_supported(codes: Column, supported: list[str], fallback: str) -> Column:
    """First cleaned code that is in ``supported``, else ``fallback``."""
    both = F.array_intersect(clean_country_codes(codes), strings(supported))
    return F.coalesce(F.try_element_at(both, F.lit(1)), F.lit(fallback))
