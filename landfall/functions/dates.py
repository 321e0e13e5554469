"""Dates, periods and the load stamp."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from .text import col, strip

# Fixed value: the zone whose wall clock is written as the load stamp.
LOAD_ZONE = "America/Santiago"

# The spellings of each periodicity.
PERIODICITY = {
    "daily": ("diario", "diaria"),
    "monthly": ("mensual",),
    "sporadic": ("esporadica", "esporádica"),
}


def moment(now: dt.datetime | str | Column) -> Column:
    """A literal instant for an aware ``datetime``; a zone-free one for a naive ``datetime`` or text."""
    if isinstance(now, Column):
        return now
    if isinstance(now, dt.datetime) and now.tzinfo is not None:
        return F.lit(now)
    return F.lit(str(now)).cast("timestamp_ntz")


def day_literal(day: dt.date | str | Column) -> Column:
    if isinstance(day, Column):
        return day
    if isinstance(day, dt.datetime):
        day = day.date()
    return F.lit(str(day)).cast("date")


def load_stamp(now: dt.datetime | str | Column, zone: str = LOAD_ZONE) -> Column:
    """Wall clock of ``zone`` at ``now``, which is UTC when it names no zone.

    The result carries no zone, so it does not move with the session's zone.
    """
    if isinstance(now, dt.datetime) and now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment(now).cast("timestamp_ntz"))


def periodicity(c: Column | str) -> Column:
    """``daily``, ``monthly`` or ``sporadic``; null for any other word."""
    word = F.lower(strip(c))
    result = F.lit(None).cast("string")
    for name, spellings in PERIODICITY.items():
        result = F.when(word.isin(*spellings), F.lit(name)).otherwise(result)
    return result


def period_date(day: Column | str, period: Column | str) -> Column:
    """Struct of ``value`` (``yyyy-MM-dd``) and ``reason``.

    ``day`` is ``dd-MM-yyyy`` text; a daily period keeps it and a monthly one takes the first of the month.
    """
    text, kind = col(day), periodicity(period)
    date = F.when(text.rlike(r"\A\d{1,2}-\d{1,2}-\d{4}\z"), F.try_to_date(text, "d-M-yyyy"))
    value = F.when(kind == "daily", date).when(kind == "monthly", F.trunc(date, "MM"))
    reason = (
        F.when(date.isNull(), F.lit("bad date"))
        .when(~F.coalesce(kind.isin("daily", "monthly"), F.lit(False)), F.lit("bad periodicity"))
    )
    return F.struct(F.date_format(value, "yyyy-MM-dd").alias("value"), reason.alias("reason"))


def iso_weekday(c: Column | str) -> Column:
    """Monday is 1 and Sunday 7."""
    return F.weekday(col(c)) + F.lit(1)


def day_text(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(col(c), pattern)


def text_date(c: Column | str) -> Column:
    """Date part of a timestamp written as text; null when it is not one."""
    return F.to_date(col(c).try_cast("timestamp_ntz"))


def normal_period(word: str | None) -> str | None:
    """The same as ``periodicity`` for a configured word."""
    word = (word or "").strip().lower()
    return next((name for name, spellings in PERIODICITY.items() if word in spellings), None)
