"""Loads of landed files into raw tables."""

from __future__ import annotations

import datetime as dt
import posixpath
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from ..functions import base_name, field_list, load_stamp, name_match, on_date
from ..functions.dates import normal_period
from ..functions.text import TRUE_WORDS
from ..operators import newest_path, open_runs, purge, raw_schema, stamp_nulls, string_projection
from ..sinks import (
    add_table_column, append_rows, ensure_table, fitted, full_refresh, replace_day, rewrite,
    write_parquet,
)
from ..sources import file_catalog, flatten_documents, qualified_path, read_csv, read_documents, read_parquet


#: The entry that names the date or timestamp column by whose day a new raw table is partitioned.
PARTITION_KEY = "campo_particion"


#: The column of a document's text.
_BODY = "_landfall_body"


def newest_file(
    spark: SparkSession, folder: str, contains: str = "", suffix: str = "", base_only: bool = False
) -> str:
    """Newest file below a folder whose name fits; the smallest path when times are equal.

    With ``base_only`` the name is the last part of the path, and a folder of part files that Spark wrote under a name that fits is a file,
    too, as new as its newest part.
    """
    files = file_catalog(spark, folder)
    fits = name_match("path", suffix=suffix, contains=contains, base_only=base_only)
    if not base_only:
        return newest_path(files.where(fits))
    below = re.escape(qualified_path(spark, folder).rstrip("/"))
    named = rf"(?=[^/]*{re.escape(contains)})[^/]*{re.escape(suffix)}"
    written = F.nullif(F.regexp_extract("path", rf"(?s)\A({below}/(?:.*/)?{named})/", 1), F.lit(""))
    part = base_name("path").startswith("part-") & F.col("path").endswith(suffix)
    landed = F.when(part & written.isNotNull(), written).when(fits, F.col("path"))
    files = files.select(landed.alias("path"), "modified").where("path IS NOT NULL")
    return newest_path(files.groupBy("path").agg(F.max("modified").alias("modified")))


def _source_and_target(params: Mapping[str, str]) -> tuple[str, str]:
    source, target = params.get("input"), params.get("output")
    if not source or not target:
        raise ValueError("params need 'input' and 'output'")
    if len(target.split(".")) != 3:
        raise ValueError("'output' must be catalog.schema.table")
    return source, target


def _folder_and_stem(path: str) -> tuple[str, str, str]:
    folder, name = posixpath.split(path)
    stem, extension = posixpath.splitext(name)
    return folder, stem, extension


def _flag(text: str | None, default: bool) -> bool:
    return default if text is None else text.strip().lower() in TRUE_WORDS


def load_csv(
    spark: SparkSession, params: Mapping[str, str], now: dt.datetime, schema: StructType | None = None
) -> dict[str, object]:
    """Load a CSV file into a raw table: text but for dates and timestamps, with a load stamp.

    Daily and monthly loads take the newest file (or folder of part files) below the input's folder whose name holds the input's stem; others
    take the input as it is. One plan scans, projects, stamps and appends. Older rows without a
    stamp, also those that others have put in since the last load, are stamped first; footers tell the files that hold such rows, and of others no values are read. A new table is partitioned by the day of the column that ``campo_particion`` names, if any.
    """
    source, target = _source_and_target(params)
    if normal_period(params.get("periodicidad")) in ("daily", "monthly"):
        folder, stem, _ = _folder_and_stem(source)
        source = newest_file(spark, folder, contains=stem, suffix=".csv", base_only=True)
    stamp_column = params.get("campo_fecha", "fecha_carga")
    header = _flag(params.get("csv_header"), True)
    rows = string_projection(
        read_csv(spark, source, params.get("csv_delimiter", ","), header, schema=schema)
    )
    created = ensure_table(spark, target, _with_stamp(raw_schema(rows.schema), stamp_column), params.get(PARTITION_KEY) or None)
    if stamp_column:
        stamp = load_stamp(now)
        if not created:
            add_table_column(spark, target, stamp_column, "timestamp")
            rewrite(spark, target, F.col(f"`{stamp_column}`").isNull(), lambda df: stamp_nulls(df, stamp_column, stamp))
        rows = stamp_nulls(rows, stamp_column, stamp)
    append_rows(spark, rows, target)
    return {"status": "OK", "file": source, "table": target, "created": created, "stamped": bool(stamp_column)}


def _with_stamp(schema: StructType, column: str) -> StructType:
    if not column or column in schema.names:
        return schema
    return StructType([*schema.fields, StructField(column, TimestampType())])


def load_parquet(spark: SparkSession, params: Mapping[str, str], now: dt.datetime) -> dict[str, object]:
    """Append a Parquet file, or the part files of a folder of that name, to a raw table.

    Monthly loads take the newest one whose name holds the input's stem, others the name dated today.
    """
    source, target = _source_and_target(params)
    folder, stem, extension = _folder_and_stem(source)
    if normal_period(params.get("periodicidad")) == "monthly":
        source = newest_file(spark, folder, contains=stem, suffix=".parquet", base_only=True)
    else:
        source = f"{folder}/{stem}_{now:%Y-%m-%d}{extension}"
    rows = read_parquet(spark, source)
    created = ensure_table(spark, target, rows.schema, params.get(PARTITION_KEY) or None)
    append_rows(spark, rows, target)
    return {"status": "OK", "file": source, "table": target, "created": created}


def reload_date(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    date_column: str | None,
    day: dt.date | str | None,
    sporadic: bool = False,
    ddl: str | None = None,
) -> None:
    """Purge the date and append its rows, so that a repeated load leaves the same table.

    A sporadic load, or one without a column or date, replaces the whole table, by what its definition makes if one is given. An unpartitioned table gets one new version
    without the old rows and with the new ones; a partitioned one gets all its partitions concerned replaced in one commit. ``rows`` must not read the table.
    """
    if sporadic or not date_column or not day:
        full_refresh(spark, table, ddl, rows)
        return
    if replace_day(spark, rows, table, date_column, day):
        return
    fresh = fitted(spark, rows, table)
    done = rewrite(
        spark, table, on_date(date_column, day),
        lambda df: purge(df, date_column, day).unionByName(fresh),
    )
    if not done["changed"]:
        append_rows(spark, rows, table)


def load_documents(
    spark: SparkSession, entries, landed: str, out: str, lines: bool = False
) -> list[dict[str, str | None]]:
    """Flatten landed API documents to Parquet, one file per entry; a bad entry does not stop the others.

    An entry names ``url``, ``filename`` and ``vars``. Its document is ``<landed>/<filename>.json``: whole files, or with ``lines`` a document on
    every line, so that a large entry comes in many documents that are read in parallel. An entry is bad if any of its documents lacks a field.
    """

    results = []
    for entry in entries:
        name, wanted = entry.get("filename"), entry.get("vars")
        if not entry.get("url") or not name or not wanted:
            results.append({"filename": name or None, "status": "SKIPPED", "error": "url, filename or vars missing"})
            continue
        listed = spark.range(1).select(field_list(F.lit(wanted)).alias("f")).first()["f"]
        flat, nested = listed["flat"], listed["nested"]
        try:
            docs = read_documents(spark, f"{landed.rstrip('/')}/{name.removesuffix('.parquet')}.json", lines=lines, body=_BODY)
            path = write_parquet(flatten_documents(docs, flat, nested, body=_BODY), f"{out.rstrip('/')}/{name}", mode="overwrite")
            results.append({"filename": name, "status": "OK", "path": path})
        except Exception as error:
            results.append({"filename": name, "status": "ERROR", "error": str(error)})
    return results


def open_process_runs(spark: SparkSession, entries: DataFrame, process_name: str, now: dt.datetime, log: str) -> dict:
    """Append one open run per valid entry to the run log. Entries are configuration, one per table."""
    runs = open_runs(entries, process_name, now)
    opened = runs.count()
    if not opened:
        return {"status": "WARNING", "opened": 0}
    append_rows(spark, runs, log)
    return {"status": "OK", "opened": opened}
