"""Text cleaning, list flattening and identifiers in URLs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column, encode_spaces: bool = True) -> Column:
    """Trim, turn line breaks and runs of white space into one space; optionally write spaces as ``%20``."""
    out = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+", " ")
    return F.replace(out, F.lit(" "), F.lit("%20")) if encode_spaces else out


def percent_encode(text: Column) -> Column:
    """Percent-encode a value for a URL, leaving only unreserved characters as they are."""
    out = F.url_encode(text)
    for written, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(written), F.lit(wanted))
    return out


def collapse_list(items: Column, sep: str = ", ", max_items: int | None = 5) -> Column:
    """Join the non-empty items of a string list, cutting after ``max_items`` with ``...``; NULL when none.

    ``max_items=None`` keeps all.
    """
    kept = F.filter(items, lambda x: x.isNotNull() & (x != ""))
    shown = kept
    if max_items is not None:
        cut = F.concat(F.slice(kept, 1, max_items), F.array(F.lit("...")))
        shown = F.when(F.size(kept) > max_items, cut).otherwise(kept)
    return F.when(F.size(kept) > 0, F.array_join(shown, sep))


def collapse_lists(nested: Column, sep: str = ", ", max_items: int = 5) -> Column:
    """`collapse_list` over a list of string lists."""
    return collapse_list(F.flatten(F.filter(nested, lambda x: x.isNotNull())), sep, max_items)


def join_text_parts(parts: Iterable[Column], sep: str = " ") -> Column:
    """Join the parts that are present, trim; NULL when nothing is left."""
    return F.nullif(F.trim(F.concat_ws(sep, *parts)), F.lit(""))


def id_from_url(url: Column) -> Column:
    """Digits at the end of a URL, or NULL."""
    return F.nullif(F.regexp_extract(url, r"([0-9]+)$", 1), F.lit(""))


def string_list(value: Column) -> Column:
    """A JSON field that may hold nothing, one scalar or a list, read as a list of strings.

    ``value`` is the field declared as string in the payload schema, so lists arrive as JSON text.
    """
    listed = F.filter(F.from_json(value, "array<string>"), lambda x: x.isNotNull())
    return (
        F.when(value.isNull(), F.array().cast("array<string>"))
        .when(value.startswith("["), F.coalesce(listed, F.array(value)))
        .otherwise(F.array(value))
    )


def present_strings(items: Column) -> Column:
    """Items that are neither NULL nor empty."""
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def extract_path(json: Column, path: str, default: Column | None = None) -> Column:
    """Value at a JSON path, or ``default`` when any step is missing."""
    found = F.get_json_object(json, path)
    return found if default is None else F.coalesce(found, default)
