"""Counts, newest entries, periods and rollups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import on_date


def row_count(df: DataFrame) -> DataFrame:
    """``row_count`` and ``has_records`` of a whole table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("has_records", F.col("row_count") > 0)


def row_count_on(
    df: DataFrame,
    date_column: str | None,
    day: dt.date | str | None,
    sporadic: bool = False,
) -> DataFrame:
    """Row count on a date; of the whole table when the load is sporadic or no column or date is given."""
    if sporadic or not date_column or not day:
        return row_count(df)
    return row_count(df.where(on_date(date_column, day)))


def daily_counts(df: DataFrame, date_column: str, day: str = "day") -> DataFrame:
    """Row count of every date at once."""
    return (
        df.groupBy(F.to_date(F.col(date_column)).alias(day))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("has_records", F.col("row_count") > 0)
    )


def keyed_counts(tables: Mapping[str, DataFrame], keys: Mapping[str, Column | str], key: str = "key") -> DataFrame:
    """``source``, key and ``n`` over several tables; each is counted before the union."""
    frames = []
    for name, df in tables.items():
        c = keys[name]
        frames.append(
            df.groupBy((F.col(c) if isinstance(c, str) else c).alias(key))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("source"), key, "n")
        )
    return reduce(DataFrame.unionByName, frames)


def latest_start(df: DataFrame, keys: Sequence[str], start: str, end: str, out: str = "latest_start") -> DataFrame:
    """Greatest start among the open rows of each key; null for a key without open rows."""
    return df.groupBy(*keys).agg(F.max(F.when(F.col(end).isNull(), F.col(start))).alias(out))


def newest(df: DataFrame, keys: Sequence[str], name: str, modified: str, out: str | None = None) -> DataFrame:
    """The name with the latest time of each group; the smallest name when times are equal.

    The latest time comes from a hash aggregation and is joined back, which leaves few rows for the names. One aggregation
    of time and name together would sort all rows first. The join includes the time, so a hot group does not
    gather in one task. Rows without a time do not count.
    """
    latest = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.max(modified).alias("_latest"))
    same = F.col(modified) == F.col("_latest")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(latest, same).groupBy(*keys).agg(F.min(name).alias(out or name))


def newest_path(files: DataFrame, name: str = "path", modified: str = "modified") -> str:
    """The newest file of a catalogue; none is an error."""
    path = newest(files, [], name, modified, "path").first()["path"]
    if path is None:
        raise FileNotFoundError("no file fits")
    return path


def period_values(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest ``period`` as ``yyyy-MM-dd`` text and the number of distinct ``periods``.

    Values are made distinct with partial aggregation before they are counted. Text is taken as it is.
    """
    is_text = df.schema[column].dataType.typeName() == "string"
    value = F.col(column) if is_text else F.to_date(F.col(column))
    distinct = df.select(*keys, value.alias("_period")).distinct()
    smallest = F.min("_period") if is_text else F.date_format(F.min("_period"), "yyyy-MM-dd")
    return distinct.groupBy(*keys).agg(smallest.alias("period"), F.count("_period").alias("periods"))


def files_with_counts(catalog: DataFrame, counts: DataFrame) -> DataFrame:
    """Catalogue entries with ``row_count`` and ``has_records``; an absent count is zero."""
    return (
        catalog.join(counts, "path", "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        .withColumn("has_records", F.col("row_count") > 0)
    )


def all_required(
    counts: DataFrame, required: DataFrame, keys: Sequence[str], name: str = "source", n: str = "n"
) -> DataFrame:
    """``ok`` per key when every required name has a positive count; ``required`` has the keys and the name."""
    on = [*keys, name]
    return (
        required.join(counts.groupBy(*on).agg(F.sum(n).alias("_n")), on, "left")
        .groupBy(*keys)
        .agg(F.bool_and(F.coalesce(F.col("_n") > 0, F.lit(False))).alias("ok"))
    )


def outcome(df: DataFrame, failed: Column, done: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``processed`` and ``succeeded`` counts, ``status`` ``partial`` when any row failed."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(done).alias("succeeded"),
        F.when(F.coalesce(F.bool_or(failed), F.lit(False)), F.lit("partial")).otherwise(F.lit("ok")).alias("status"),
    )
