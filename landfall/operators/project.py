"""Projections and row routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, StringType, TimestampNTZType, TimestampType

from ..functions import missing, plain_text

_DATE_LIKE = (DateType, TimestampType, TimestampNTZType)


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns in the given order; the error lists every name that is missing."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    return df.select(*(F.col(f"`{name}`") for name in names))


def normal_type(kind: DataType) -> DataType:
    """Dates and timestamps keep their type, everything else is text."""
    return kind if isinstance(kind, _DATE_LIKE) else StringType()


def string_projection(df: DataFrame) -> DataFrame:
    """All columns as text but for dates and timestamps."""

    def text(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            return plain_text(c).alias(field.name)
        return c.cast(normal_type(field.dataType)).alias(field.name)

    return df.select(*map(text, df.schema.fields))


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """The same values on every row."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def missing_names(required: Sequence[str], mode: str = "falsy", entry: str | None = None) -> Column:
    """Array of the required names without a value, in columns or under the keys of a map column."""

    def value(name: str) -> Column:
        return F.element_at(F.col(entry), F.lit(name)) if entry else F.col(f"`{name}`")

    return F.array_compact(F.array(*(F.when(missing(value(name), mode), F.lit(name)) for name in required)))


def route_required(
    df: DataFrame, required: Sequence[str], mode: str = "falsy", entry: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with every required value, and the skipped ones with a ``reason``."""
    names = missing_names(required, mode, entry)
    kept = df.where(F.size(names) == 0)
    skipped = df.where(F.size(names) > 0).withColumn(
        "reason", F.concat(F.lit("missing: "), F.array_join(names, ", "))
    )
    return kept, skipped
