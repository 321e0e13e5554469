"""Schema documents and their enforcement."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType, VariantType,
)

from .project import normal_type

# Type names of a schema document.
TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "BYTES": BinaryType(),
    "BOOL": BooleanType(),
    "BOOLEAN": BooleanType(),
    "INT64": LongType(),
    "INTEGER": LongType(),
    "FLOAT64": DoubleType(),
    "FLOAT": DoubleType(),
    "NUMERIC": DecimalType(38, 9),
    "BIGNUMERIC": DecimalType(38, 18),
    "DATE": DateType(),
    "DATETIME": TimestampNTZType(),
    "TIMESTAMP": TimestampType(),
    "TIME": StringType(),
    "GEOGRAPHY": StringType(),
    "JSON": VariantType(),
}

# The keys each field of a schema document must have, and its modes.
FIELD_KEYS = ("name", "type", "mode")
MODES = ("NULLABLE", "REQUIRED", "REPEATED")


def struct_type(document: Sequence[dict]) -> StructType:
    """The Spark schema of a document ``[{"name", "type", "mode"}]``."""
    fields = []
    for entry in document:
        name, kind, mode = entry["name"], str(entry["type"]).upper(), str(entry["mode"]).upper()
        if kind not in TYPES:
            raise ValueError(f"column '{name}': type {kind} has no counterpart")
        if mode not in MODES:
            raise ValueError(f"column '{name}': unknown mode {mode}")
        spark_type = ArrayType(TYPES[kind]) if mode == "REPEATED" else TYPES[kind]
        fields.append(StructField(name, spark_type, nullable=mode != "REQUIRED"))
    return StructType(fields)


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in order, cast to its types; columns the frame lacks are null."""
    def column(f: StructField) -> Column:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        return c.cast(f.dataType).alias(f.name)

    return df.select(*map(column, schema.fields))


def document_violations(df: DataFrame, document: str, *ids: str) -> DataFrame:
    """What breaks the contract in each JSON text: ``position`` (null for the whole text) and ``reason``.

    The text must be a list of records that each have the three keys.
    """
    text = F.btrim(F.col(document))
    items = F.from_json(text, "array<string>")
    whole = df.where(~F.coalesce(text.startswith("["), F.lit(False)) | items.isNull()).select(
        *ids, F.lit(None).cast("int").alias("position"), F.lit("not a list").alias("reason")
    )
    rows = df.where(text.startswith("[")).select(*ids, F.posexplode(items).alias("position", "_item"))
    keys = F.json_object_keys(F.col("_item"))
    lacking = F.array_except(F.array(*map(F.lit, FIELD_KEYS)), keys)
    reason = F.when(keys.isNull(), F.lit("not a record")).when(
        F.size(lacking) > 0, F.concat(F.lit("missing: "), F.array_join(lacking, ", "))
    )
    parts = rows.select(*ids, "position", reason.alias("reason")).where(F.col("reason").isNotNull())
    return whole.unionByName(parts)


def check_document(text: str) -> list[dict]:
    """A schema document from its text, which must be a list of records with the three keys."""
    document = json.loads(text)
    if not isinstance(document, list):
        raise ValueError("the schema is not a list of fields")
    for field in document:
        if not isinstance(field, dict):
            raise ValueError("a field of the schema is not a record")
        lacking = [key for key in FIELD_KEYS if key not in field]
        if lacking:
            raise ValueError(f"field {field} lacks {', '.join(lacking)}")
    return document


def add_missing_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add a null column of the given type unless it is there."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def _required(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def required_violations(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows with a null in a required column, with the array of those columns as ``null_columns``."""
    tests = [F.when(F.col(f"`{n}`").isNull(), F.lit(n)) for n in _required(schema)]
    names = F.array_compact(F.array(*tests).cast("array<string>"))
    return df.withColumn("null_columns", names).where(F.size("null_columns") > 0)


def enforce_required(df: DataFrame, schema: StructType) -> DataFrame:
    """The same frame; a null in a required column fails the query that reads it."""

    def checked(field: StructField) -> Column:
        c = F.col(f"`{field.name}`")
        error = F.raise_error(F.lit(f"null in required column '{field.name}'")).cast(field.dataType)
        return F.when(c.isNull(), error).otherwise(c)

    present = [f for f in schema.fields if not f.nullable and f.name in df.columns]
    return df.withColumns({f.name: checked(f) for f in present})


def raw_schema(schema: StructType) -> StructType:
    """Schema of a raw load: dates and timestamps as they are, everything else text."""
    return StructType([StructField(f.name, normal_type(f.dataType), f.nullable) for f in schema.fields])
