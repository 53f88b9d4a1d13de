"""Money and count ranges: text from bounds and bounds from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _range_text(low: Column, high: Column, low_text: Column, high_text: Column) -> Column:
    return (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(low_text, F.lit(" - "), high_text))
        .when(low.isNotNull(), F.concat(low_text, F.lit("+")))
    )


def spend_range_text(low: Column, high: Column) -> Column:
    """``$a - $b``, ``$a+`` when only the low bound is known, else NULL."""
    return _range_text(
        low, high, F.concat(F.lit("$"), low.cast("string")), F.concat(F.lit("$"), high.cast("string"))
    )


def impressions_range_text(low: Column, high: Column) -> Column:
    """``a - b`` with thousands separators, ``a+`` when only the low bound is known, else NULL."""
    return _range_text(low, high, F.format_number(low, 0), F.format_number(high, 0))


def _numbers(text: Column) -> Column:
    """Numbers in a text; a K, M or B behind one multiplies it, before fractions are cut off."""
    found = F.regexp_extract_all(text, F.lit(r"([0-9][0-9,]*(?:\.[0-9]+)?(?:\s*[KMBkmb](?![A-Za-z]))?)"), F.lit(1))

    def number(x: Column) -> Column:
        unit = F.upper(F.right(x, F.lit(1)))
        times = F.when(unit == "K", 1_000).when(unit == "M", 1_000_000).when(unit == "B", 1_000_000_000).otherwise(1)
        return (F.regexp_replace(x, "[^0-9.]", "").try_cast("decimal(22,6)") * times).cast("long")

    return F.transform(found, number)


def range_low(text: Column) -> Column:
    """Low bound of a range in text or ``{"lower_bound", "upper_bound"}`` form."""
    from_object = F.get_json_object(text, "$.lower_bound").try_cast("decimal(28,6)").cast("long")
    return F.when(text.startswith("{"), from_object).otherwise(F.try_element_at(_numbers(text), F.lit(1)))


def range_high(text: Column) -> Column:
    """High bound of a range in text or ``{"lower_bound", "upper_bound"}`` form; NULL for ``a+``."""
    from_object = F.get_json_object(text, "$.upper_bound").try_cast("decimal(28,6)").cast("long")
    return F.when(text.startswith("{"), from_object).otherwise(F.try_element_at(_numbers(text), F.lit(2)))


def spend_from_payload(text: Column) -> Column:
    """A spend field that is plain text or an object of bounds, as range text."""
    return F.when(text.startswith("{"), spend_range_text(range_low(text), range_high(text))).otherwise(text)


def impressions_from_payload(text: Column) -> Column:
    """An impressions field that is plain text or an object of bounds, as range text."""
    return F.when(text.startswith("{"), impressions_range_text(range_low(text), range_high(text))).otherwise(text)
