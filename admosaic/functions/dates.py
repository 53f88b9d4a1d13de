"""Dates in source payloads and in request parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_datetime(value: Column) -> Column:
    """Read an epoch in seconds or milliseconds, or an ISO date or time; anything else is NULL.

    Ten to thirteen digits are an epoch, in milliseconds when above 1e10.
    """
    text = F.trim(value.cast("string"))
    epoch = text.try_cast("bigint")
    return (
        F.when(
            text.rlike(r"^[0-9]{10,13}$"),
            F.when(epoch > F.lit(10_000_000_000), F.timestamp_millis(epoch)).otherwise(F.timestamp_seconds(epoch)),
        )
        .when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), text.try_cast("timestamp"))
    )


def parse_day(value: Column) -> Column:
    """An ISO day, NULL when it does not exist."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.left(text, F.lit(10)).try_cast("date"))


def format_day(day: Column, style: str = "iso", platform: str | None = None) -> Column:
    """Write a day as sources ask for it: ``iso``, ``epoch`` (milliseconds) or ``custom`` by platform."""
    if style == "epoch":
        return F.unix_millis(day.cast("timestamp")).cast("string")
    if style == "custom" and platform == "apple":
        return F.when(day.isNotNull(), F.lit("LAST_90_DAYS"))
    return F.date_format(day, "yyyy-MM-dd")


def date_preset(date_from: Column, date_to: Column, today: Column | None = None) -> Column:
    """Name of the preset that covers a span of days; the end defaults to today, no start means 90 days."""
    span = F.date_diff(F.coalesce(date_to, F.current_date() if today is None else today), date_from)
    return (
        F.when(span <= 90, F.lit("LAST_90_DAYS"))
        .when(span <= 180, F.lit("LAST_180_DAYS"))
        .when(span > 180, F.lit("LAST_YEAR"))
        .otherwise(F.lit("LAST_90_DAYS"))
    )


def preset_days(preset: Column) -> Column:
    """Length of a preset in days."""
    return F.when(preset == "LAST_180_DAYS", 180).when(preset == "LAST_YEAR", 365).otherwise(90)


def day_start(day: Column) -> Column:
    """First moment of a day."""
    return day.cast("date").cast("timestamp")


def day_end(day: Column) -> Column:
    """Last microsecond of a day."""
    return F.date_add(day.cast("date"), 1).cast("timestamp") - F.expr("INTERVAL 0.000001 SECOND")
