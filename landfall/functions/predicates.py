"""Predicates and conditional columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from .dates import day_literal, moment
from .text import base_name, col, strip

# Fixed value: how old a landed file may be.
FRESH_MINUTES = 10


def all_equal(values: Mapping[str, object], active: str | None = None) -> Column:
    """Every named column equals its value, and the active flag is set."""
    tests = [F.col(name) == F.lit(value) for name, value in values.items()]
    if active:
        tests.append(F.col(active))
    return reduce(and_, tests)


def on_date(c: Column | str, day: dt.date | str | Column) -> Column:
    """The calendar date of ``c`` is ``day``; Catalyst pushes it to the scan as a range."""
    return F.to_date(col(c)) == day_literal(day)


def any_of(c: Column | str, values: Sequence | Column) -> Column:
    """Membership in a list or in an array column."""
    if isinstance(values, Column):
        return F.array_contains(values, col(c))
    return col(c).isin(*values)


def in_array(array: Column | str, value: Column | object) -> Column:
    """The array holds the value; a null array holds nothing."""
    return F.coalesce(F.array_contains(col(array), value), F.lit(False))


def name_match(
    c: Column | str,
    prefix: str = "",
    suffix: str = "",
    contains: str = "",
    base_only: bool = False,
    any_case: bool = False,
) -> Column:
    """Name tests. ``base_only`` looks for ``contains`` in the last path part, ``any_case`` eases the suffix."""
    c = col(c)
    tests = []
    if prefix:
        tests.append(c.startswith(prefix))
    if suffix:
        tests.append(F.lower(c).endswith(suffix.lower()) if any_case else c.endswith(suffix))
    if contains:
        tests.append((base_name(c) if base_only else c).contains(contains))
    return reduce(and_, tests) if tests else c.isNotNull()


def recent(c: Column | str, now: dt.datetime | str | Column, minutes: int = FRESH_MINUTES) -> Column:
    """At most ``minutes`` before ``now``, the limit included; later times pass too."""
    return col(c) >= moment(now) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def is_open(c: Column | str) -> Column:
    return col(c).isNull()


def missing(c: Column | str, mode: str = "falsy") -> Column:
    """``falsy``: null or empty text. ``null``: null only."""
    c = col(c)
    if mode == "null":
        return c.isNull()
    if mode == "falsy":
        return c.isNull() | (c.cast("string") == "")
    raise ValueError(f"unknown mode {mode!r}")


def by_status(status: Column | str, success: Column | str, failure: Column | str) -> Column:
    """The success column for ``OK`` in any case, the failure column for anything else."""
    return F.when(F.upper(col(status)) == "OK", col(success)).otherwise(col(failure))


def default_if_absent(entry: Column | str, key: str, default: object) -> Column:
    """The value under ``key``; the default only when the map lacks the key."""
    entry = col(entry)
    return F.when(F.map_contains_key(entry, key), F.element_at(entry, F.lit(key))).otherwise(F.lit(default))


def default_if_blank(c: Column | str, default: object) -> Column:
    """The default for null and for text that is empty once trimmed."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(default))
