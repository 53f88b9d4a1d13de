"""All registered queries with their checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import analysis, jobs, logs, normalization, searching

QUERIES = {**normalization.QUERIES, **searching.QUERIES, **analysis.QUERIES, **jobs.QUERIES, **logs.QUERIES}
ORACLES = {**normalization.ORACLES, **searching.ORACLES, **analysis.ORACLES, **jobs.ORACLES, **logs.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Political ads normalised, searched and counted by country."""
    return QUERIES["political_ads_by_country"](spark, sf_dir)
