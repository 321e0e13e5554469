"""Parquet scans, the landing catalogue and whole-file texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet scan; a given schema saves the footer read that infers one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, as file listings write it."""
    system, hadoop_path = _hadoop(spark, path)
    return system.makeQualified(hadoop_path).toString()


def plain_path(path: Column) -> Column:
    """A path as readers take it, from the encoded form of file metadata."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"\A([a-z]+):///", "$1:/")


def _since(reader, since: dt.datetime | None):
    """Leave out files that are older, when they are listed. The limit is lowered to a whole second."""
    if since is None:
        return reader
    utc = since.astimezone(dt.timezone.utc) - dt.timedelta(seconds=1)
    return reader.option("modifiedAfter", f"{utc:%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")


def file_catalog(
    spark: SparkSession, *paths: str, since: dt.datetime | None = None, glob: str | None = None
) -> DataFrame:
    """Every file below the paths: ``path``, ``modified``, ``length``. Contents are not read.

    A scan leaves out files of no length, but an empty file may be the newest, or the one that a check must
    report. They are in the reader's listing, so those that the scan lacks are looked up one by one.
    """
    reader = _since(spark.read.format("binaryFile"), since).option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(list(paths))
    scanned = files.select("path", F.col("modificationTime").alias("modified"), "length")
    names = files.inputFiles()
    if scanned.count() == len(names):
        return scanned
    listed = spark.createDataFrame([(name,) for name in names], "name string")
    listed = listed.select(plain_path(F.col("name")).alias("path"))
    rows = []
    for row in listed.join(scanned, "path", "left_anti").toLocalIterator():
        system, hadoop_path = _hadoop(spark, row["path"])
        millis = system.getFileStatus(hadoop_path).getModificationTime()
        rows.append((row["path"], dt.datetime.fromtimestamp(millis / 1000, dt.timezone.utc), 0))
    return scanned.unionByName(spark.createDataFrame(rows, scanned.schema))


def recent_parquet(spark: SparkSession, since: dt.datetime | None = None):
    """A reader of all Parquet files below the paths, or the recent ones."""
    return _since(spark.read, since).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")


def parquet_row_counts(spark: SparkSession, *paths: str, since: dt.datetime | None = None) -> DataFrame:
    """``path`` and ``row_count`` for each readable Parquet file that has rows.

    The read schema is empty, so only footers are read, and files of different schemas may be mixed.
    """
    return (
        recent_parquet(spark, since)
        .schema(StructType([]))
        .option("ignoreCorruptFiles", True)
        .parquet(*paths)
        .groupBy(plain_path(F.col("_metadata.file_path")).alias("path"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def read_texts(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Whole text of each file below ``path`` whose name fits ``glob``: ``path``, ``body``.

    An empty file yields no row in a text scan, so the catalogue supplies it with an empty body.
    """
    texts = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("body"))
    )
    listed = file_catalog(spark, path, glob=glob).select("path")
    return listed.join(texts, "path", "left").withColumn("body", F.coalesce("body", F.lit("")))
