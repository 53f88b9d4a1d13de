"""Fixed lists and lookups as literal columns, each built in one call."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(value) -> str:
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strings(values: Iterable[str]) -> Column:
    """A list of strings."""
    return F.expr(f"cast(array({', '.join(map(_quoted, values))}) as array<string>)")


def string_lists(values: Iterable[Iterable[str]]) -> Column:
    """A list of lists of strings."""
    lists = (f"cast(array({', '.join(map(_quoted, v))}) as array<string>)" for v in values)
    return F.expr(f"array({', '.join(lists)})")


def lookup(pairs: Mapping) -> Column:
    """A map from the keys to the values."""
    return F.expr(f"map({', '.join(f'{_quoted(k)}, {_quoted(v)}' for k, v in pairs.items())})")
