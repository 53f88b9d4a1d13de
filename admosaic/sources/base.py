"""What one source has to declare: its page envelope, its item payload and its mapping."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

STRINGS = "array<string>"


@dataclass(frozen=True)
class Source:
    """A source of landed response pages.

    ``page`` and ``payload`` are DDL; fields declared as string take any JSON value as its text.
    ``items(page, operation, body)`` yields the list of item texts of a page, ``total(page)`` the
    count the page reports (NULL when it reports none), ``next_position(page)`` where the next page
    starts (NULL at the end), ``error(page)`` the message of an error page, and ``mapping(item)`` the
    fields of the ad table.
    """

    name: str
    page: str
    payload: str
    items: Callable[[Column, Column, Column], Column]
    mapping: Callable[[Column], dict[str, Column]]
    total: Callable[[Column], Column] = lambda page: F.lit(None).cast("bigint")
    next_position: Callable[[Column], Column] = lambda page: F.lit(None).cast("string")
    error: Callable[[Column], Column] = lambda page: F.lit(None).cast("string")
    #: What the functions above get as the page: the parsed body, with whatever they read of it more than once.
    parsed: Callable[[Column], Column] = lambda page: page


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """An expression of a value that is worked out once, as a lambda variable."""
    return F.element_at(F.transform(F.array(value), of), 1)


def strings(text: Column) -> Column:
    """A JSON list kept as text, as its items' texts."""
    return F.from_json(text, STRINGS)


def one_object(text: Column) -> Column:
    """A single JSON object as a list of one item text."""
    return F.when(text.startswith("{"), F.array(text))


def pick(operation: Column, search: Column, **others: Column) -> Column:
    """The item list for the page's operation: ``others`` by name, ``search`` for the rest."""
    out = None
    for name, column in others.items():
        out = F.when(operation == name, column) if out is None else out.when(operation == name, column)
    return search if out is None else out.otherwise(search)


def next_offset(offset: Column, size: Column, total: Column, default_size: int) -> Column:
    """``offset + size`` as text while below ``total``, else NULL."""
    following = F.coalesce(offset, F.lit(0)) + F.coalesce(size, F.lit(default_size))
    return F.when(following < F.coalesce(total, F.lit(0)), following.cast("string"))
