"""Documented quality rules of the ad table, checked row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.media import MEDIA_TYPES
from ..sources.registry import platform_names

# Allowed values of the common schema.
ADVERTISER_TYPES = (
    "candidate", "elected_official", "political_party", "non_profit", "public_figure", "organization",
    "individual", "unknown",
)
STATUSES = ("ACTIVE", "INACTIVE", "REMOVED", "PENDING", "REJECTED")
GENDERS = ("male", "female", "all", "unknown")


def _any_not(column: str, pattern: str) -> Column:
    return F.exists(column, lambda x: x.isNull() | ~x.rlike(pattern))


def _outside(column: str, allowed: tuple[str, ...]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)


def check_ads(ads: DataFrame) -> DataFrame:
    """Ads with the names of the rules each breaks in ``violations``."""
    c = F.col
    rules = {
        "ad_id:not_null": c("ad_id").isNull(),
        "ad_id:not_empty": c("ad_id") == "",
        "platform:not_null": c("platform").isNull(),
        "platform:in_list": _outside("platform", tuple(platform_names())),
        "fetched_at:not_null": c("fetched_at").isNull(),
        "advertiser_type:in_list": _outside("advertiser_type", ADVERTISER_TYPES),
        "status:in_list": _outside("status", STATUSES),
        "media_type:in_list": _outside("media_type", MEDIA_TYPES),
        "targeting_gender:in_list": F.exists("targeting_gender", lambda x: x.isNull() | ~F.lower(x).isin(*GENDERS)),
        "countries:iso_country_codes": _any_not("countries", "^[A-Z]{2}$"),
        "languages:iso_language_codes": _any_not("languages", "^[a-z]{2}$"),
    }
    if dict(ads.dtypes)["first_seen"] != "timestamp":
        for name in ("first_seen", "last_seen", "fetched_at"):
            rules[f"{name}:is_datetime"] = c(name).isNotNull() & c(name).try_cast("timestamp").isNull()
    return ads.withColumn("violations", F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in rules.items()])))


def violation_summary(ads: DataFrame) -> DataFrame:
    """Number of ads that break each rule, by platform."""
    return (
        check_ads(ads)
        .select("platform", F.explode("violations").alias("rule"))
        .groupBy("platform", "rule")
        .agg(F.count("*").alias("n"))
    )
