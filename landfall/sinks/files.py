"""File sinks."""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import normal_period
from ..operators.aggregate import period_values


def parquet_name(name: str) -> str:
    return name if name.endswith(".parquet") else f"{name}.parquet"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write to ``path``, whose name gets ``.parquet`` when it lacks it. Returns the path."""
    path = parquet_name(path)
    df.write.mode(mode).parquet(path)
    return path


def slug(file: str) -> str:
    """Driver-side form of the file slug, for names of folders."""
    return file.rsplit(".", 1)[0].replace("_", "-").lower()


def export_folder(root: str, file: str, day: str) -> str:
    return f"{root.rstrip('/')}/files/{slug(file).replace('-', '_').upper()}/periodo_dia={day}"


def export_rows(df: DataFrame, root: str, file: str, day: str) -> str:
    """Write the rows as the partition of ``day`` of an exported file, replacing what it held."""
    path = export_folder(root, file, day)
    df.write.mode("overwrite").parquet(path)
    return path


def archive_rows(
    df: DataFrame,
    root: str,
    file: str,
    periodicity: str,
    today: dt.date,
    on_several: str = "error",
) -> str:
    """Write the rows below ``root`` under a name that carries their period. Returns the path.

    The period column is ``periodo_dia`` or ``periodo_mes``; sporadic data takes today's date. Several periods in one
    frame are an error, unless ``on_several`` is ``first`` (all under the smallest) or ``split`` (one write into
    ``<file>/<column>=<period>`` folders).
    """
    stem, extension = posixpath.splitext(file)

    def target(day: str) -> str:
        return f"{root.rstrip('/')}/{stem}_{day}{extension}"

    period = normal_period(periodicity)
    if period == "sporadic":
        path = target(today.isoformat())
        df.write.mode("overwrite").parquet(path)
        return path
    # The period columns.
    column = {"daily": "periodo_dia", "monthly": "periodo_mes"}.get(period)
    if column is None or column not in df.columns:
        raise ValueError(f"no period column for periodicity '{periodicity}'")
    found = period_values(df, column).first()
    if not found["periods"]:
        raise ValueError(f"'{column}' holds no period")
    if found["periods"] > 1 and on_several == "error":
        raise ValueError(f"'{column}' holds {found['periods']} periods")
    if found["periods"] == 1 or on_several == "first":
        path = target(found["period"])
        df.write.mode("overwrite").parquet(path)
        return path
    path = f"{root.rstrip('/')}/{stem}{extension}"
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
    return path


def results_frame(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """Statuses of a run as a frame; one row per step."""
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)


def write_results(results: DataFrame, folder: str, line) -> None:
    """Append step results as JSON records and as text lines made by the ``line`` column."""
    results.coalesce(1).write.mode("append").json(f"{folder.rstrip('/')}/json")
    results.select(line.alias("value")).coalesce(1).write.mode("append").text(f"{folder.rstrip('/')}/text")


def write_document(spark: SparkSession, text: str, path: str) -> str:
    """Write one small text document."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder; the source may be a pattern that fits just one."""
    system, pattern = _system(spark, source)
    found = system.globStatus(pattern)
    if not found or len(found) != 1:
        raise FileNotFoundError(f"{source} names {len(found or ())} files")
    _, place = _system(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(found[0].getPath(), place):
        raise OSError(f"{source} can't be moved to {target}")


def set_modified(spark: SparkSession, path: str, moment: dt.datetime) -> None:
    """Set the time of a file, or of all files below a folder."""
    system, place = _system(spark, path)
    files = system.listFiles(place, True)
    while files.hasNext():
        system.setTimes(files.next().getPath(), int(moment.timestamp() * 1000), -1)
