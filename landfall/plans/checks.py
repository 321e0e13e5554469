"""Checks of landed files, loaded tables and configuration."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import load_stamp, name_match, recent
from ..functions.dates import normal_period
from ..operators import (
    close_runs, expected_files, files_with_counts, row_count,
)
from ..session import scratch_path
from ..sinks import quoted, results_frame, rewrite, table_on_date
from ..sources import Conflict, file_catalog, merged_schema, parquet_row_counts, path_exists, qualified_path, recent_parquet, rows_by_file, schema_classes

# The control tables that a process must be registered in, by archetype type.
REQUIRED_TABLES = {
    "raw": ("process_params", "process_email", "process_ddl"),
    "cleansed": ("process_params", "process_email", "process_ddl", "process_insert"),
}

# The table types of the cleansed zone.
TABLE_TYPES = ("satelite", "hub", "link")


_FILE = "path string, modified timestamp, length bigint, row_count bigint, has_records boolean"


def _read_error(spark: SparkSession, *paths: str) -> str | None:
    """Why the files can't be read; only their footers are looked at, in one job."""
    try:
        spark.read.schema(StructType([])).parquet(*paths).count()
        return None
    except Exception as error:
        return str(error)


def _empty_errors(spark: SparkSession, empty: list) -> list[tuple[str, str]]:
    """Errors of files without rows. One job tells whether all are sound; if not, halves are tried, so few jobs look for few bad files."""
    errors = [(row["path"], "not a Parquet file") for row in empty if row["length"] < 12]
    open_ = [[row["path"] for row in empty if row["length"] >= 12]]
    while open_:
        paths = open_.pop()
        if not paths or not (error := _read_error(spark, *paths)):
            continue
        if len(paths) == 1:
            errors.append((paths[0], error))
        else:
            half = len(paths) // 2
            open_ += [paths[:half], paths[half:]]
    return errors


def _rows_read(spark: SparkSession, root: str, since: dt.datetime, files: DataFrame) -> DataFrame | None:
    """The number of rows of each file below a folder that can be read in all their columns.

    Files whose schemas can't be merged are read class by class; only then their names come to the driver.
    """
    new_reader = lambda: recent_parquet(spark, since)
    try:
        schema = merged_schema(new_reader(), root)
        classes = [(schema, [root])] if schema is not None else []
    except Conflict:
        counts = files.where(F.col("has_records") & F.startswith("path", F.lit(root.rstrip("/") + "/"))).select("path", "row_count")
        classes = schema_classes(new_reader, counts, [row["path"] for row in counts.collect()])
    read = [rows_by_file(new_reader().schema(schema).option("ignoreCorruptFiles", True).parquet(*paths)) for schema, paths in classes]
    return reduce(DataFrame.unionByName, read) if read else None


def landing_report(
    spark: SparkSession, expected: DataFrame, now: dt.datetime, minutes: int = 10, strict: bool = False, thorough: bool = True
) -> DataFrame:
    """For every expected ``path`` its recent Parquet files and whether each has rows.

    ``expected`` has ``path`` and may have ``periodicidad``. Rows are counted from footers in one job. ``thorough`` reads all columns of
    all files in one more for each class of schemas that can be merged, and reports files that give fewer rows than their footers promise. One job tells whether files
    without rows are sound. ``strict`` raises an error when some path has no recent file.
    """
    named = [row["path"] for row in expected.select("path").distinct().toLocalIterator()]
    folders = {path: qualified_path(spark, path) for path in named}
    roots = sorted(root for root in set(folders.values()) if path_exists(spark, root))
    since = now - dt.timedelta(minutes=minutes)
    if roots:
        catalog = file_catalog(spark, *roots, since=since).where(
            name_match("path", suffix=".parquet") & recent("modified", now, minutes)
        )
        # One row per recent file, written down so that footers are read once.
        found = scratch_path(spark, "landing")
        files_with_counts(catalog, parquet_row_counts(spark, *roots, since=since)).write.parquet(found)
        files = spark.read.schema(_FILE).parquet(found)
    else:
        files = spark.createDataFrame([], _FILE)
    errors = _empty_errors(spark, files.where(~F.col("has_records")).select("path", "length").collect())
    failures = spark.createDataFrame(errors, "path string, error string")
    read = [rows for root in roots if thorough and (rows := _rows_read(spark, root, since, files)) is not None]
    if read:
        counted = reduce(DataFrame.unionByName, read).groupBy("path").agg(F.max("rows_read").alias("rows_read"))
        got = F.coalesce("rows_read", F.lit(0))
        message = F.concat(F.lit("only "), got.cast("string"), F.lit(" of "), F.col("row_count").cast("string"), F.lit(" rows can be read"))
        failures = failures.unionByName(
            files.where("has_records").join(counted, "path", "left").where(got < F.col("row_count")).select("path", message.alias("error")))
    wanted = expected.join(spark.createDataFrame(list(folders.items()), "path string, _folder_path string"), "path")
    if "periodicidad" in expected.columns:
        wanted = wanted.withColumn("periodicidad", F.lower(F.coalesce("periodicidad", F.lit("esporádica"))))
    report = (
        expected_files(wanted, files.join(failures, "path", "left"), path="_folder_path")
        .withColumn("exists", F.col("file_path").isNotNull())
        .withColumn("has_records", F.coalesce("has_records", F.lit(False)))
        .withColumn("error", F.when(~F.col("exists"), F.lit("no recent file")).otherwise(F.col("error")))
        .drop("modified", "length", "_folder_path")
    )
    if strict:
        absent = [row["path"] for row in report.where(~F.col("exists")).toLocalIterator()]
        if absent:
            raise FileNotFoundError(f"no recent file below: {', '.join(sorted(absent))}")
    return report


def table_counts(spark: SparkSession, entries: Iterable[Mapping[str, str]]) -> list[dict]:
    """Row count of each configured table, on its date unless it is sporadic. All counts run as one job."""
    results, frames = [], {}
    for position, entry in enumerate(entries):
        dataset, table = entry.get("dataset_name"), entry.get("table_name")
        result = {"dataset_name": dataset, "table_name": table, "row_count": None, "has_records": None, "error": None}
        results.append(result)
        if not dataset or not table:
            result["error"] = "dataset or table missing"
            continue
        name, column, day = f"{dataset}.{table}", entry.get("fecha_columna"), entry.get("fecha_param")
        try:
            if normal_period(entry.get("periodicidad")) == "sporadic" or not column or not day:
                rows = spark.table(quoted(name))
            else:
                rows = table_on_date(spark, name, column, day)
        except Exception as error:
            result["error"] = str(error)
            continue
        frames[position] = row_count(rows).withColumn("position", F.lit(position))

    def take(frame: DataFrame) -> None:
        for row in frame.collect():
            results[row["position"]].update(row_count=row["row_count"], has_records=row["has_records"])

    if frames:
        try:
            take(reduce(DataFrame.unionByName, frames.values()))
        except Exception:  # some table can't be read: each by itself, so that the others count
            for position, frame in frames.items():
                try:
                    take(frame)
                except Exception as error:
                    results[position]["error"] = str(error)
    return results


def validate_tables(
    spark: SparkSession,
    entries: Iterable[Mapping[str, str]],
    process_name: str,
    zone_name: str,
    log: str,
    now: dt.datetime,
) -> DataFrame:
    """Count the configured tables and close their latest open runs in the log, with one rewrite for all."""
    results = table_counts(spark, entries)
    frame = results_frame(
        spark, results, "dataset_name string, table_name string, row_count bigint, has_records boolean, error string"
    )
    counts = frame.where(F.col("row_count").isNotNull()).select(
        F.lit(process_name).alias("process_name"), F.lit(zone_name).alias("zone_name"), "dataset_name", "table_name",
        "row_count",
    )
    opened = (
        (F.col("process_name") == process_name) & (F.col("zone_name") == zone_name) & F.col("end_process").isNull()
    )
    stamp = load_stamp(now)
    rewrite(spark, log, opened, lambda df: close_runs(df, counts, stamp), regroup=True)
    return frame


def completeness(
    requests: DataFrame,
    process_params: DataFrame,
    process_email: DataFrame,
    process_ddl: DataFrame,
    process_insert: DataFrame,
    table_types: Sequence[str] = TABLE_TYPES,
) -> DataFrame:
    """Registrations of each requested process in the control tables, and whether none is lacking.

    A request has ``process_name``, ``arquetipo_type``, ``arquetype_name``, ``zone_email`` and ``zone_ddl``. Every table
    is counted by its keys before it is joined.
    """
    sources = {
        "process_params": (process_params, {"arquetype_name": "arquetype_name"}),
        "process_email": (process_email, {"zone_email": "zone_name"}),
        "process_ddl": (process_ddl, {"zone_ddl": "zone_name"}),
        "process_insert": (process_insert.where(F.col("table_type").isin(*table_types)), {}),
    }
    result = requests.withColumn("arquetipo_type", F.lower("arquetipo_type"))
    for name, (table, keys) in sources.items():
        on = ["process_name", *keys]
        counted = (
            table.groupBy("process_name", *(F.col(c).alias(k) for k, c in keys.items()))
            .agg(F.count(F.lit(1)).alias(name))
        )
        result = result.join(counted, on, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    ok = F.lit(False)
    for kind, tables in REQUIRED_TABLES.items():
        every = reduce(lambda a, b: a & b, (F.col(t) > 0 for t in tables))
        ok = F.when(F.col("arquetipo_type") == kind, every).otherwise(ok)
    return result.withColumn("status", F.when(ok, F.lit("ok")).otherwise(F.lit("fail")))


def completeness_line():
    """Text line of a completeness result."""
    # Fixed value: the tag of the line.
    counts = [F.concat(F.lit(f" {name}="), F.col(name)) for name in REQUIRED_TABLES["cleansed"]]
    return F.concat(
        F.lit("[VALIDATION] proc="), F.col("process_name"), F.lit(" type="), F.col("arquetipo_type"), *counts,
        F.lit(" status: "), F.col("status"),
    )
