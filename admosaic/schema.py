"""The common ad table: one schema for every source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING = T.StringType()
_STRINGS = T.ArrayType(T.StringType())

# Field names and types of the common ad table, in order.
ADS = T.StructType(
    [
        T.StructField("ad_id", _STRING),
        T.StructField("platform", _STRING),
        T.StructField("advertiser_id", _STRING),
        T.StructField("advertiser_name", _STRING),
        T.StructField("advertiser_verified", T.BooleanType()),
        T.StructField("advertiser_type", _STRING),
        T.StructField("payer", _STRING),
        T.StructField("beneficiary", _STRING),
        T.StructField("status", _STRING),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("last_seen", T.TimestampType()),
        T.StructField("ad_text", _STRING),
        T.StructField("ad_creative_urls", _STRINGS),
        T.StructField("ad_library_url", _STRING),
        T.StructField("media_type", _STRING),
        T.StructField("media_urls", _STRINGS),
        T.StructField("landing_url", _STRING),
        T.StructField("countries", _STRINGS),
        T.StructField("languages", _STRINGS),
        T.StructField("spend_range", _STRING),
        T.StructField("impressions_range", _STRING),
        T.StructField("eu_reach", _STRING),
        T.StructField("targeting_age", _STRINGS),
        T.StructField("targeting_gender", _STRINGS),
        T.StructField("targeting_locations", _STRINGS),
        T.StructField("targeting_interests", _STRINGS),
        T.StructField("targeting_behaviors", _STRINGS),
        T.StructField("targeting_custom_audiences", _STRINGS),
        T.StructField("targeting_exclusions", _STRINGS),
        T.StructField("extra_json", _STRING),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("targeting_other", _STRINGS),
        T.StructField("advertiser_url", _STRING),
        T.StructField("spend_low", T.LongType()),
        T.StructField("spend_high", T.LongType()),
        T.StructField("impressions_low", T.LongType()),
        T.StructField("impressions_high", T.LongType()),
    ]
)

LIST_FIELDS = tuple(f.name for f in ADS if isinstance(f.dataType, T.ArrayType))


def no_strings() -> Column:
    """An empty list of strings."""
    return F.array().cast(_STRINGS)


def missing(field: T.StructField) -> Column:
    """The value a field takes when its source says nothing: an empty list or NULL."""
    if isinstance(field.dataType, T.ArrayType):
        return no_strings()
    return F.lit(None).cast(field.dataType)


def empty_ads(spark: SparkSession) -> DataFrame:
    """A zero-row ad table."""
    return spark.range(0).select(*ads_columns({}))


def ads_columns(values: dict[str, Column]) -> list[Column]:
    """All fields of the ad table in order, taking ``values`` where given."""
    unknown = set(values) - set(ADS.names)
    if unknown:
        raise ValueError(f"not fields of the ad table: {sorted(unknown)}")
    out = []
    for field in ADS:
        if field.name in values:
            column = values[field.name]
            if isinstance(field.dataType, T.ArrayType):
                column = F.coalesce(column, no_strings())
            else:
                column = column.cast(field.dataType)
        else:
            column = missing(field)
        out.append(column.alias(field.name))
    return out
