"""The registry as dimension tables: at most a few rows per source, so safe to broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry_values import DEFAULT_RATE_LIMITS, FIELD_PATHS, GLOBAL, PLATFORMS

FEATURES = {
    "search_ads": ("endpoints", "search_ads"),
    "details": ("endpoints", "details"),
    "advertisers": ("endpoints", "advertisers"),
    "keyword_search": ("params", "keyword"),
    "date_filtering": ("params", "date_from"),
    "country_filtering": ("params", "countries"),
}


def platform_names() -> list[str]:
    """The sources, sorted."""
    return sorted(PLATFORMS)


def platforms(spark: SparkSession) -> DataFrame:
    """One row per source; settings a source lacks come from the global ones."""
    rows = []
    for name in platform_names():
        own = PLATFORMS[name]
        shared = {key: own.get(key, value) for key, value in GLOBAL.items()}
        rows.append((name, own["name"], own["version"], own["paging"], own["auth"], *shared.values()))
    settings = ", ".join(f"{key} int" for key in GLOBAL)
    schema = f"platform string, name string, version string, paging string, auth string, {settings}"
    return spark.createDataFrame(rows, schema)


def platform_endpoints(spark: SparkSession) -> DataFrame:
    """Platform, operation and native endpoint; NULL where unsupported."""
    rows = [(p, op, path) for p in platform_names() for op, path in PLATFORMS[p]["endpoints"].items()]
    return spark.createDataFrame(rows, "platform string, operation string, endpoint string")


def platform_params(spark: SparkSession) -> DataFrame:
    """Platform, unified parameter and native name; NULL where unsupported."""
    unified = sorted({name for p in PLATFORMS.values() for name in p["params"]})
    rows = [(p, name, PLATFORMS[p]["params"].get(name)) for p in platform_names() for name in unified]
    return spark.createDataFrame(rows, "platform string, param string, native_name string")


def platform_limits(spark: SparkSession) -> DataFrame:
    """Requests allowed per minute, hour and day, and the wait after a refusal in seconds."""
    rows = []
    for name in platform_names():
        limits = {**DEFAULT_RATE_LIMITS, **PLATFORMS[name]["rate_limits"]}
        rows.append(
            (
                name,
                limits.get("requests_per_minute"),
                limits["requests_per_hour"],
                limits["requests_per_day"],
                limits["retry_after_default"],
            )
        )
    return spark.createDataFrame(
        rows,
        "platform string, requests_per_minute bigint, requests_per_hour bigint, requests_per_day bigint, "
        "retry_after_default bigint",
    )


def platform_coverage(spark: SparkSession) -> DataFrame:
    """Stated geographic and temporal coverage."""
    rows = [(p, PLATFORMS[p]["geographic"], PLATFORMS[p]["temporal"]) for p in platform_names()]
    return spark.createDataFrame(rows, "platform string, geographic array<string>, temporal string")


def supports(platform: str, feature: str) -> bool:
    """Whether a source offers a feature; unknown features are not offered."""
    if feature == "pagination":
        return PLATFORMS[platform].get("paging") is not None
    if feature not in FEATURES:
        return False
    section, key = FEATURES[feature]
    return PLATFORMS[platform][section].get(key) is not None


def platform_capabilities(spark: SparkSession) -> DataFrame:
    """Platform, feature and whether it is supported."""
    rows = [(p, f, supports(p, f)) for p in platform_names() for f in (*FEATURES, "pagination")]
    return spark.createDataFrame(rows, "platform string, feature string, supported boolean")


def source_index(spark: SparkSession) -> DataFrame:
    """Platform, field of the ad table and documented path in the source's payload."""
    rows = [
        (platform, field, position, path)
        for platform, fields in FIELD_PATHS.items()
        for field, paths in fields.items()
        for position, path in enumerate(paths)
    ]
    return spark.createDataFrame(rows, "platform string, field string, position int, path string")


def ads_with_limits(ads: DataFrame) -> DataFrame:
    """Every row with the limits of its platform; rows of unknown platforms get the defaults."""
    limits = platform_limits(ads.sparkSession)
    return ads.join(F.broadcast(limits), "platform", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(value).cast("bigint")) for name, value in DEFAULT_RATE_LIMITS.items()}
    )


def field_coverage(items: DataFrame, platform: str) -> DataFrame:
    """How many items of a source hold a value at each documented path, each item parsed once."""
    paths = [
        (field, path) for field, listed in FIELD_PATHS.get(platform, {}).items() for path in listed
    ]
    if not paths:
        raise ValueError(f"no documented paths for {platform}")
    def has(path: str) -> Column:
        """Items that cannot be parsed whole, and wildcards, are searched as text."""
        path = "$." + path.replace("videos.url", "videos[*].url")
        as_text = F.get_json_object("item", path).isNotNull()
        parsed = F.try_variant_get("parsed", path, "string").isNotNull()
        return as_text if "*" in path else F.when(F.col("parsed").isNull(), as_text).otherwise(parsed)

    items = items.select("item", F.try_parse_json("item").alias("parsed"))
    counts = [F.count_if(has(path)).alias(f"n{i}") for i, (_, path) in enumerate(paths)]
    rows = F.array(
        *[
            F.struct(F.lit(field).alias("field"), F.lit(path).alias("path"), F.col(f"n{i}").alias("items"))
            for i, (field, path) in enumerate(paths)
        ]
    )
    return items.agg(*counts).select(F.lit(platform).alias("platform"), F.inline(rows))
