"""JSON documents: a flat part and an array of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions import text_date


def read_documents(
    spark: SparkSession, *paths: str, schema: StructType | str | None = None, lines: bool = False, body: str | None = None
) -> DataFrame:
    """One row per JSON document: a whole file each, or one on every line, which lets a file be split.

    A file may also be an array of documents. ``body`` names a column that gets the text of each document, which tells a field that is
    absent from one that is null.
    """
    reader = spark.read.option("multiLine", not lines)
    if schema:
        reader = reader.schema(schema)
    parsed = reader.json(list(paths))
    if body is None:
        return parsed
    texts = document_texts(spark, *paths, lines=lines).select(F.from_json("body", parsed.schema).alias("_doc"), F.col("body").alias(body))
    return texts.select("_doc.*", body)


def document_texts(spark: SparkSession, *paths: str, lines: bool = False) -> DataFrame:
    """The ``body`` of each document."""
    texts = spark.read.text(list(paths), wholetext=not lines).select(F.col("value").alias("body")).where(F.col("value").rlike(r"\S"))
    if lines:
        return texts
    several = F.when(F.col("body").rlike(r"\A\s*\["), F.from_json("body", "array<string>")).otherwise(F.array("body"))
    return texts.select(F.explode(several).alias("body"))


def missing_fields(body: Column, names: Sequence[str]) -> Column:
    """Names that are no top-level key of the JSON text. A key with a null value is present."""
    nothing = F.array().cast("array<string>")
    keys = F.coalesce(F.json_object_keys(body), nothing)
    return F.array_except(F.array(*map(F.lit, names)), keys) if names else nothing


def document_problem(body: Column, flat: Sequence[str], nested: Sequence[str], array: str = "serie") -> Column:
    """What a document lacks: a flat field, the array or its records, an inner field that none of its records has; null if nothing."""
    missing = missing_fields(body, flat)
    named = lambda what, names: F.concat(F.lit(f"{what} not found: "), F.array_join(names, ", "))
    problem = F.when(F.size(missing) > 0, named("flat fields", missing))
    if not nested:
        return problem
    records = F.from_json(F.get_json_object(body, f"$['{array}']"), "array<map<string,string>>")
    keys = F.flatten(F.transform(records, lambda r: F.coalesce(F.map_keys(r), F.array().cast("array<string>"))))
    lacking = F.array_except(F.array(*map(F.lit, nested)), keys)
    empty = F.coalesce(F.size(records), F.lit(0)) <= 0
    return problem.when(empty, F.lit(f"section '{array}' is absent or empty")).when(F.size(lacking) > 0, named(f"fields of '{array}'", lacking))


def _records_of(schema: StructType, array: str) -> list[str]:
    if array in schema.names and isinstance(schema[array].dataType, ArrayType):
        inner = schema[array].dataType.elementType
        if isinstance(inner, StructType):
            return inner.names
    return []


def flatten_documents(
    docs: DataFrame,
    flat: Sequence[str],
    nested: Sequence[str],
    array: str = "serie",
    date_field: str = "fecha",
    keep: Sequence[str] = (),
    body: str | None = None,
) -> DataFrame:
    """One row per record of ``array`` with the chosen inner fields, then the chosen flat fields.

    Without inner fields there is one row per document. A flat field replaces an inner one of the same
    name. The inner date field becomes a date. Unknown names raise an error, and so does a document whose array is
    empty when inner fields are asked for. ``keep`` names further columns to carry along. ``body`` names the column with each document's text: then
    every document is judged by its own fields, and one that lacks any raises an error; a field that is null is there.
    """
    absent = [name for name in flat if name not in docs.columns]
    if absent:
        raise ValueError(f"flat fields not found: {', '.join(absent)}")
    carried = [F.col(f"`{name}`") for name in keep]
    flats = [F.col(f"`{name}`") for name in flat]
    if body is not None:
        problem = document_problem(F.col(f"`{body}`"), flat, nested, array)
        docs = docs.where(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(True))
    if not nested:
        return docs.select(*carried, *flats)
    if array not in docs.columns:
        raise ValueError(f"section '{array}' is absent or empty")
    absent = [name for name in nested if name not in _records_of(docs.schema, array)]
    if absent:
        raise ValueError(f"fields of '{array}' not found: {', '.join(absent)}")
    records = F.col(f"`{array}`")
    checked = F.when(
        F.coalesce(F.size(records), F.lit(0)) <= 0,
        F.raise_error(F.lit(f"section '{array}' is absent or empty")).cast(docs.schema[array].dataType),
    ).otherwise(records)
    rows = docs.select(*carried, *flats, F.explode(checked).alias("_record"))

    def inner(name: str) -> Column:
        value = F.col("_record")[name]
        return (text_date(value) if name == date_field else value).alias(name)

    return rows.select(
        *carried,
        *(F.col(f"`{name}`") if name in flat else inner(name) for name in nested),
        *(F.col(f"`{name}`") for name in flat if name not in nested),
    )


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Business calendar ``[{"DIA": "dd-MM-yyyy", "HABIL": "S"}]`` as ``position``, ``day``, ``flag``.

    A calendar has one entry per day, so its one document is small. The position says which of two
    entries for a day came first.
    """
    return calendar_entries(spark.read.text(path, wholetext=True).select(F.col("value").alias("body")))


def calendar_entries(docs: DataFrame, body: str = "body") -> DataFrame:
    parsed = F.from_json(F.col(body), "array<struct<DIA:string,HABIL:string>>")
    return docs.select(F.posexplode(parsed).alias("position", "entry")).select(
        "position",
        F.try_to_date(F.col("entry.DIA"), "dd-MM-yyyy").alias("day"),
        F.col("entry.HABIL").alias("flag"),
    )
