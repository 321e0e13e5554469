"""Row changes as new versions of a frame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import day_literal, load_stamp, on_date
from .project import route_required

# The run log's key columns. The count column keeps its established spelling.
RUN_KEYS = ("process_name", "zone_name", "dataset_name", "table_name")
RUN_COUNT = "qantity_of_records"


def purge(df: DataFrame, date_column: str, day: dt.date | str | Column) -> DataFrame:
    """Rows not on the date; rows without a date stay."""
    return df.where(~F.to_date(F.col(date_column)).eqNullSafe(day_literal(day)))


def purged(df: DataFrame, date_column: str, day: dt.date | str | Column) -> DataFrame:
    """The rows that a purge removes."""
    return df.where(on_date(date_column, day))


def stamp_nulls(df: DataFrame, column: str, stamp: Column) -> DataFrame:
    """Set the stamp where it is null; the column is added when absent."""
    if column not in df.columns:
        return df.withColumn(column, stamp)
    return df.withColumn(column, F.coalesce(F.col(column), stamp.cast(df.schema[column].dataType)))


def close_runs(
    log: DataFrame,
    counts: DataFrame,
    stamp: Column,
    keys: Sequence[str] = RUN_KEYS,
    start: str = "start_process",
    end: str = "end_process",
    count: str = RUN_COUNT,
) -> DataFrame:
    """Close the latest open run of each counted key with the stamp and the key's ``row_count``.

    The latest start is aggregated per key and joined back on key and start, so the rows of a hot key are spread over
    tasks by their start time rather than gathered as a window would.
    """
    latest = (
        log.where(F.col(end).isNull())
        .groupBy(*keys)
        .agg(F.max(start).alias(start))
        .join(counts.groupBy(*keys).agg(F.max("row_count").alias("_count")), list(keys))
        .withColumn("_close", F.lit(True))
    )
    rows = log.join(latest, [*keys, start], "left")
    close = F.col("_close") & F.col(end).isNull()
    kinds = {field.name: field.dataType for field in log.schema.fields}
    return rows.select(
        *(
            F.when(close, stamp.cast(kinds[end])).otherwise(F.col(end)).alias(end)
            if name == end
            else F.when(close, F.col("_count").cast(kinds[count])).otherwise(F.col(count)).alias(count)
            if name == count
            else F.col(name)
            for name in log.columns
        )
    )


def open_runs(entries: DataFrame, process_name: str, now, entry: str = "entry") -> DataFrame:
    """One open run per entry that names a dataset and a table."""
    kept, _ = route_required(entries, ["dataset_name", "table_name"], entry=entry)

    def value(name: str) -> Column:
        return F.element_at(F.col(entry), F.lit(name)).alias(name)

    return kept.select(
        F.lit(process_name).alias("process_name"),
        value("dataset_name"),
        value("table_name"),
        load_stamp(now).alias("start_process"),
        F.lit(None).cast("timestamp_ntz").alias("end_process"),
        F.lit(None).cast("bigint").alias(RUN_COUNT),
        value("zone_name"),
    )
