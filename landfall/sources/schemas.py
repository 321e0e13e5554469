"""Classes of Parquet files whose schemas can be merged."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructType

from .files import plain_path

#: Types that a column is also read as to tell its real type: forms in which Parquet keeps values can be read as several types.
_PROBES = ("double", "timestamp_ntz", "string")


class Conflict(Exception):
    """Two schemas that can't be merged."""

    def __init__(self, left: StructType, right: StructType):
        super().__init__(f"{left.simpleString()} and {right.simpleString()}")
        self.left, self.right = left, right

    def column(self) -> tuple[str, list[DataType]]:
        """The first column, by name, of different types and these."""
        left, right = ({f.name.lower(): f for f in s.fields} for s in (self.left, self.right))
        name = min(n for n in left.keys() & right.keys() if _bare(left[n].dataType) != _bare(right[n].dataType))
        return left[name].name, [left[name].dataType, right[name].dataType]


def _bare(kind: DataType) -> str:
    return kind.simpleString().lower()


def merged_schema(reader, *paths: str) -> StructType | None:
    """The merged schema of files, from their footers; None if no file has one. A ``Conflict`` tells what can't be merged."""
    try:
        return reader.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(*paths).schema
    except AnalysisException:
        return None
    except Exception as error:
        cause = getattr(error, "java_exception", error)
        if "CANNOT_MERGE_SCHEMAS" not in str(cause):
            raise
        given = dict(cause.getMessageParameters())
        left, right = (StructType.fromDDL("s " + given[side].strip('"'))["s"].dataType for side in ("left", "right"))
        raise Conflict(left, right) from None


def rows_by_file(rows: DataFrame) -> DataFrame:
    """``path`` and ``rows_read`` of each file that a scan reads, all its columns included."""
    values = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in rows.schema.fields]
    seen = rows.groupBy(plain_path(F.col("_metadata.file_path")).alias("path")).agg(F.count("*").alias("rows_read"), F.bit_xor(F.xxhash64(*values)).alias("_all"))
    # The hash of all columns is used, or the scan would leave them out.
    return seen.select("path", F.when(F.col("_all").isNotNull(), F.col("rows_read")).alias("rows_read"))


def _readable(new_reader, counts: DataFrame, paths: list[str], column: str, types: Sequence[str]) -> list[list[str]]:
    """The paths by which of the types their column can be read as in full, in one job."""
    def read(kind: str) -> DataFrame:
        return rows_by_file(new_reader().schema(f"`{column}` {kind}").option("ignoreCorruptFiles", True).parquet(*paths)).withColumn("kind", F.lit(kind))

    full = reduce(DataFrame.unionByName, map(read, types)).join(counts, "path").where("rows_read = row_count")
    signs = {row["path"]: tuple(sorted(row["kinds"])) for row in full.groupBy("path").agg(F.collect_set("kind").alias("kinds")).collect()}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(signs.get(path, ()), []).append(path)
    return list(groups.values())


def schema_classes(new_reader, counts: DataFrame, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Files in classes that have one merged schema each. ``counts`` has ``path`` and ``row_count``, from footers.

    Merging the footers of all files names two schemas that don't go together. One more job reads just the column in question as either type, and
    as some others, which tells the files apart; so jobs grow with the number of types, not of files. Files that
    read alike though their types differ, such as damaged ones, are halved. ``new_reader`` gives a fresh reader.
    """
    done, open_ = [], [list(paths)]
    while open_:
        some = open_.pop()
        if not some:
            continue
        try:
            schema = merged_schema(new_reader(), *some)
            if schema is not None:
                done.append((schema, some))
        except Conflict as conflict:
            column, types = conflict.column()
            kinds = list(dict.fromkeys([*map(_bare, types), *_PROBES]))
            groups = _readable(new_reader, counts, some, column, kinds)
            half = len(some) // 2
            open_ += groups if len(groups) > 1 else [some[:half], some[half:]]
    return done
