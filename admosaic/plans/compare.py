"""Results in a form both engines hash alike: lists as sorted joined text, times as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ADS


def plain(table: DataFrame) -> DataFrame:
    columns = []
    for field in table.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(F.array_sort(column), ",")
        elif isinstance(field.dataType, (T.TimestampType, T.DateType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return table.select(*columns)


def plain_ads(ads: DataFrame) -> DataFrame:
    """An ad table in plain form; of the raw item only whether it is there."""
    return plain(ads.withColumn("extra_json", F.col("extra_json").isNotNull()))


def sql_list(values) -> str:
    """A list of texts, or of lists of texts, as a SQL literal."""
    if values and isinstance(values[0], list):
        return "[" + ", ".join(f"CAST({sql_list(v)} AS VARCHAR[])" for v in values) + "]"
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def sql_pick(values, index: str) -> str:
    return f"({sql_list(values)})[CAST({index} AS BIGINT) + 1]"


def sql_joined(expression: str) -> str:
    return f"coalesce(array_to_string(list_sort({expression}), ','), '')"


def sql_time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def sql_ads(source: str, **values: str) -> str:
    """SELECT of a whole ad table in plain form; fields without a value are NULL or an empty list."""
    columns = []
    for field in ADS:
        name = field.name
        if isinstance(field.dataType, T.ArrayType):
            text = sql_joined(values[name]) if name in values else "''"
        elif isinstance(field.dataType, T.TimestampType):
            text = sql_time(values[name]) if name in values else "CAST(NULL AS VARCHAR)"
        elif name == "extra_json":
            text = "TRUE"
        elif isinstance(field.dataType, T.BooleanType):
            text = values.get(name, "CAST(NULL AS BOOLEAN)")
        elif isinstance(field.dataType, T.LongType):
            text = values.get(name, "CAST(NULL AS BIGINT)")
        else:
            text = values.get(name, "CAST(NULL AS VARCHAR)")
        columns.append(f"{text} AS {name}")
    return "SELECT " + ",\n  ".join(columns) + f"\nFROM {source}"
