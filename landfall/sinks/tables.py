"""Table sinks and row changes on catalogue tables of plain Parquet.

Such tables have no DELETE or UPDATE. A change writes a new version of an unpartitioned table beside the old one and points the table to it,
so a job that dies half-way leaves the table as it was.

A change of a partitioned table is one commit, too, however many partitions it has. What the partitions concerned are to hold is written to a folder
beside the table, with a list of these partitions. Then a property of the table names the folder: that is the commit. Only after it partitions are
emptied and filled from the folder, which can be done over and over with the same end, and the property goes. A job that dies before the commit leaves the
old state; after it the next writer goes through the list again, and readers of this library take those partitions from the folder meanwhile.
A table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType, TimestampType

from ..functions import day_literal, on_date
from ..operators.mutate import purge
from ..operators.schema import enforce_required
from ..session import delete_folder, folder_is_empty

_DAY_OF = "landfall.day_of."
_REQUIRED = "landfall.required"

# Between the folder of an unpartitioned table's first version and the mark of a later one.
VERSION = "--v-"

# Between the name of a table and the mark of a version that is to take its place or has left it.
NEW, OLD = "__landfall_new_", "__landfall_old_"
REPLACES = "landfall.replaces"

# The property that names the folder of a change that is committed and not yet through, and the mark of such folders.
INTENT, CHANGE = "landfall.intent", "--c-"


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(quoted(table)) if c.isPartition]


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def sibling(table: str, mark: str) -> str:
    """A fresh name beside a table."""
    *schema, name = table.replace("`", "").split(".")
    return ".".join([*schema, f"{name}{mark}{uuid.uuid4().hex}"])


def siblings(spark: SparkSession, table: str, mark: str) -> list[str]:
    """The names beside a table that ``sibling`` has given."""
    *schema, name = table.replace("`", "").split(".")
    place = f" IN {quoted('.'.join(schema))}" if schema else ""
    found = spark.sql(f"SHOW TABLES{place} LIKE '{name.lower()}{mark}*'").select("tableName").collect()
    return sorted(".".join([*schema, row["tableName"]]) for row in found)


def step(spark: SparkSession, sql: str) -> None:
    """One change of metadata."""
    spark.sql(sql)


def settle(spark: SparkSession, table: str) -> str | None:
    """Finish or undo the swap or change of a table that a job died in, and say which. Writers do so before they look for the table.

    A change of partitions that is committed is gone through again.
    """
    done = _settle_name(spark, table)
    if spark.catalog.tableExists(quoted(table)) and (folder := properties(spark, table).get(INTENT)):
        _go_through(spark, table, folder)
        return "new"
    return done


def _settle_name(spark: SparkSession, table: str) -> str | None:
    """Between the two renames of a swap the table has no name. By then the new version is complete and marked, so it takes
    the name; without one the old version takes it back.
    """
    if spark.catalog.tableExists(quoted(table)):
        return None
    for name in siblings(spark, table, NEW):
        if properties(spark, name).get(REPLACES) == table.split(".")[-1].replace("`", "").lower():
            step(spark, f"ALTER TABLE {quoted(name)} RENAME TO {renamed(table)}")
            return "new"
    for name in siblings(spark, table, OLD):
        step(spark, f"ALTER TABLE {quoted(name)} RENAME TO {renamed(table)}")
        return "old"
    return None


def renamed(table: str) -> str:
    """A name as RENAME and LIKE take it, without the catalogue, which is that of the session."""
    return quoted(".".join(table.replace("`", "").split(".")[-2:]))


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_column: str | None = None,
    path: str | None = None,
) -> bool:
    """Create the table unless it exists, by day of a date or timestamp column if one is named.

    A timestamp column gets a date column beside it that holds the day; the table's properties say whose day it
    is, and appends and purges use it. Returns whether the table was created.
    """
    settle(spark, table)
    if spark.catalog.tableExists(quoted(table)):
        return False
    fields, props, partition = list(schema.fields), {}, None
    required = [f.name for f in fields if not f.nullable]
    if required:
        props[_REQUIRED] = ",".join(required)
    if partition_column:
        kind = schema[partition_column].dataType
        if isinstance(kind, DateType):
            partition = partition_column
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            partition = f"{partition_column}_day"
            fields.append(StructField(partition, DateType()))
            props[_DAY_OF + partition] = partition_column
        else:
            raise ValueError(f"'{partition_column}' is neither a date nor a timestamp")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = [f"CREATE TABLE {quoted(table)} ({columns}) USING parquet"]
    if partition:
        parts.append(f"PARTITIONED BY (`{partition}`)")
    if path:
        parts.append(f"LOCATION {text(path)}")
    if props:
        parts.append("TBLPROPERTIES (" + ", ".join(f"{text(k)}={text(v)}" for k, v in props.items()) + ")")
    spark.sql(" ".join(parts))
    return True


def day_columns(spark: SparkSession, table: str) -> dict[str, str]:
    """Day column of each timestamp column that partitions the table."""
    return {
        source: key.removeprefix(_DAY_OF)
        for key, source in properties(spark, table).items()
        if key.startswith(_DAY_OF)
    }


def table_on_date(spark: SparkSession, table: str, column: str, day: dt.date | str) -> DataFrame:
    """Rows of a date; a table partitioned by that column's day reads its partition and that of rows without a day."""
    _settle_name(spark, table)
    rows = table_rows(spark, table).where(on_date(column, day))
    day_column = _day_column(spark, table, column)
    # An INSERT by SQL may have left the day out.
    return rows.where((F.col(day_column) == day_literal(day)) | F.col(day_column).isNull()) if day_column else rows


def _day_column(spark: SparkSession, table: str, column: str) -> str | None:
    """The day column that belongs to a timestamp column, whatever the case of its name."""
    return {source.lower(): day for source, day in day_columns(spark, table).items()}.get(column.lower())


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """The target's columns in its order and types, matched by name; absent ones are null, unknown ones an error."""
    have = {name.lower(): name for name in df.columns}
    unknown = have.keys() - {name.lower() for name in schema.names}
    if unknown:
        raise ValueError(f"the target has no columns: {', '.join(sorted(unknown))}")

    def column(f: StructField) -> Column:
        name = have.get(f.name.lower())
        return (F.col(f"`{name}`") if name else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*map(column, schema.fields))


def fitted(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """The frame as the table takes it: by name, with its day column, required values checked."""
    settle(spark, table)
    target = spark.table(quoted(table)).schema
    props = properties(spark, table)
    for source, day in day_columns(spark, table).items():
        given = next((name for name in df.columns if name.lower() == source.lower()), None)
        if given:
            df = df.withColumn(day, F.to_date(F.col(f"`{given}`")))
    rows = align(df, target)
    required = props.get(_REQUIRED, "").split(",")
    checked = StructType([StructField(f.name, f.dataType, f.name not in required) for f in target.fields])
    rows = enforce_required(rows, checked)
    # Rows of one partition come together in files of a fair size; a partition with very many rows is split.
    parts = partition_columns(spark, table)
    return rows.hint("rebalance", *parts) if parts else rows


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _overwriting(spark: SparkSession, mode: str):
    """Set what an overwrite replaces: the whole table or only the partitions written to."""
    return _setting(spark, "spark.sql.sources.partitionOverwriteMode", mode)


def counting_nulls(spark: SparkSession):
    """Let files that are written keep bounds and null counts of timestamps in their footers.

    The old form of timestamps has neither, so a look for rows without a stamp, or of a date, would read all values. By these a scan skips
    what can't hold such rows.
    """
    return _setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def append_rows(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append by column name."""
    with counting_nulls(spark):
        fitted(spark, df, table).write.mode("append").insertInto(quoted(table))


def empty_table(spark: SparkSession, table: str) -> None:
    """Empty a table in place, all partitions in one change."""
    if not partition_columns(spark, table):
        nothing = spark.createDataFrame([], spark.table(quoted(table)).schema)
        with _overwriting(spark, "static"):
            nothing.write.mode("overwrite").insertInto(quoted(table))
        return
    settle(spark, table)
    _commit(spark, table, _change_folder(spark, table), [{}])


def _partition_key(names: list[str]) -> Column:
    """A partition's values as one text, nulls left out."""
    return F.to_json(F.struct(*(F.col(f"`{name}`") for name in names)))


def _in_partitions(specs: list[Row]) -> Column:
    """A predicate on partition columns that prunes the scan to the given partitions, by one set lookup each."""
    names = [name for name in specs[0].asDict() if name != "_key"]
    listed = _partition_key(names).isin([spec["_key"] for spec in specs])
    # A catalogue can itself select by plain values.
    for name in names:
        values = {spec[name] for spec in specs}
        if None not in values:
            listed = F.col(f"`{name}`").isin(list(values)) & listed
    return listed


def version_folder(place: str) -> str:
    """A fresh folder for a new version of a table that is in ``place``."""
    return f"{place.rstrip('/').split(VERSION)[0]}{VERSION}{uuid.uuid4().hex}"


def point_to(spark: SparkSession, table: str, folder: str) -> None:
    """Let an unpartitioned table be the files of another folder."""
    step(spark, f"ALTER TABLE {quoted(table)} SET LOCATION {text(folder)}")
    spark.catalog.refreshTable(quoted(table))


def _change_folder(spark: SparkSession, table: str) -> str:
    return f"{location(spark, table).rstrip('/')}{CHANGE}{uuid.uuid4().hex}"


def _stage(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").parquet(f"{folder}/rows")


def _staged(spark: SparkSession, table: str, folder: str) -> DataFrame | None:
    """What the partitions of a change are to hold."""
    path = f"{folder}/rows"
    return None if folder_is_empty(spark, path) else spark.read.schema(spark.table(quoted(table)).schema).parquet(path)


def _partitions(rows: DataFrame, parts: list[str]) -> list[Row]:
    """The partitions that rows lie in, by their values and a key of these."""
    return rows.select(*(F.col(f"`{p}`") for p in parts), _partition_key(parts).alias("_key")).distinct().collect()


def _commit(spark: SparkSession, table: str, folder: str, concerned: list[Row | dict[str, object]]) -> None:
    """Let partitions hold just the staged rows, as one change. Those that have none, of the ones concerned, are emptied.

    A dict of some of the partition columns, the first ones, stands for all partitions with these values.
    """
    parts = partition_columns(spark, table)
    rows = _staged(spark, table, folder)
    filled = [] if rows is None else _partitions(rows, parts)
    keys = {row["_key"] for row in filled}
    listed = [(row["_key"], None) for row in filled]
    for spec in concerned:
        values = spec.asDict() if isinstance(spec, Row) else spec
        key = values.get("_key")
        if key is None or key not in keys:
            listed.append((key, json.dumps({p: None if values[p] is None else str(values[p]) for p in parts if p in values})))
    spark.createDataFrame(listed, "key string, emptied string").coalesce(1).write.json(f"{folder}/partitions")
    step(spark, f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({text(INTENT)}={text(folder)})")
    _go_through(spark, table, folder)


def _concerned(spark: SparkSession, folder: str) -> list[Row]:
    return spark.read.schema("key string, emptied string").json(f"{folder}/partitions").collect()


def _go_through(spark: SparkSession, table: str, folder: str) -> None:
    """Make a table what a committed change says. It reads only the folder of the change, so doing it again ends the same."""
    for row in _concerned(spark, folder):
        if row["emptied"] is not None:
            _empty_partitions(spark, table, json.loads(row["emptied"]))
    rows = _staged(spark, table, folder)
    if rows is not None:
        _fill(spark, table, rows)
    step(spark, f"ALTER TABLE {quoted(table)} UNSET TBLPROPERTIES IF EXISTS ({text(INTENT)})")
    delete_folder(spark, folder)


def _fill(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Replace the partitions that rows lie in."""
    with _overwriting(spark, "dynamic"), counting_nulls(spark):
        rows.write.mode("overwrite").insertInto(quoted(table))


def _empty_partitions(spark: SparkSession, table: str, spec: dict[str, str | None]) -> None:
    """Drop all partitions with the given values, and their files, in one statement. An external table would keep the files of one that is just dropped.

    Spark's overwrite can't name a null of every type, so of a partition with one the files go first and then the name.
    """
    if None in spec.values():
        here = spark.table(quoted(table)).where(_with_values(spark, table, spec)).select("_metadata.file_path").limit(1).collect()
        if here:
            place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(here[0]["file_path"]))
            delete_folder(spark, place.getParent().toString())
        values = ", ".join(f"`{p}` = " + ("NULL" if v is None else text(v)) for p, v in spec.items())
        step(spark, f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({values})")
        return
    values = ", ".join(
        f"`{p}`" + ("" if p not in spec else " = NULL" if spec[p] is None else f" = {text(spec[p])}") for p in partition_columns(spark, table)
    )
    fields = [f for f in spark.table(quoted(table)).schema.fields if f.name not in spec]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    with _overwriting(spark, "static"):
        step(spark, f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION ({values}) SELECT {nothing} WHERE false")


def _with_values(spark: SparkSession, table: str, spec: dict[str, str | None]) -> Column:
    """A predicate on the partitions that have the given values."""
    kinds = {f.name: f.dataType for f in spark.table(quoted(table)).schema.fields}
    found = F.lit(True)
    for name, value in spec.items():
        found &= F.col(f"`{name}`").isNull() if value is None else F.col(f"`{name}`").eqNullSafe(F.lit(value).cast(kinds[name]))
    return found


def table_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table. Partitions of a change that is committed and not yet through come from the folder of the change."""
    rows = spark.table(quoted(table))
    folder = properties(spark, table).get(INTENT)
    if not folder:
        return rows
    concerned = _concerned(spark, folder)
    keys = [row["key"] for row in concerned if row["key"] is not None]
    if keys:
        rows = rows.where(~_partition_key(partition_columns(spark, table)).isin(keys))
    for row in concerned:
        if row["key"] is None:
            rows = rows.where(~_with_values(spark, table, json.loads(row["emptied"])))
    staged = _staged(spark, table, folder)
    return rows if staged is None else rows.unionByName(staged)


def change_folders(spark: SparkSession, table: str) -> list[str]:
    """Folders beside a table that changes have written, of jobs that died before their commit or after all was through."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{location(spark, table).rstrip('/')}{CHANGE}*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(status.getPath().toString() for status in found or ())


def rewrite(
    spark: SparkSession,
    table: str,
    touched: Column,
    change: Callable[[DataFrame], DataFrame],
    regroup: bool = False,
) -> dict[str, object]:
    """Apply ``change`` to the data that holds rows fitting ``touched``.

    Partitioned: only the partitions with such rows are read and replaced, all in one commit. Otherwise the whole table
    is written to a new folder and the table pointed to it; ``previous`` names the old folder, which is kept.
    A change that goes row by row leaves the rows of a partition together, so nothing is shuffled for the write;
    ``regroup`` brings them together again after one that joins or groups.
    """
    settle(spark, table)
    current = spark.table(quoted(table))
    parts = partition_columns(spark, table)
    if not parts:
        if current.where(touched).isEmpty():
            return {"changed": False}
        old = location(spark, table)
        new = version_folder(old)
        with counting_nulls(spark):
            change(current).select(*current.columns).write.parquet(new)
        point_to(spark, table, new)
        return {"changed": True, "previous": old}
    specs = _partitions(current.where(touched), parts)
    if not specs:
        return {"changed": False}
    rows = change(current.where(_in_partitions(specs))).select(*current.columns)
    folder = _change_folder(spark, table)
    _stage(rows.hint("rebalance", *parts) if regroup else rows, folder)
    _commit(spark, table, folder, specs)
    return {"changed": True, "partitions": len(specs)}


def purge_table(spark: SparkSession, table: str, column: str, day: dt.date | str) -> dict[str, object]:
    """Remove the rows of a date, in one commit. Partitions of just that date go without reading their rows, all in one statement.

    Rows that lie in the partition without a day, because an INSERT left it out, are looked at by their timestamp.
    """
    settle(spark, table)
    parts = partition_columns(spark, table)
    day_column = _leading_day(spark, table, column)
    if not day_column:
        return rewrite(spark, table, on_date(column, day), lambda df: purge(df, column, day))
    current = spark.table(quoted(table))
    concerned: list = [] if current.where(F.col(day_column) == day_literal(day)).isEmpty() else [{day_column: day}]
    strays = _strays(current, parts, day_column, column, day)
    if not concerned and not strays:
        return {"changed": False}
    folder = _change_folder(spark, table)
    if strays:
        _stage(purge(current.where(_in_partitions(strays)), column, day).select(*current.columns), folder)
    _commit(spark, table, folder, concerned + strays)
    return {"changed": True}


def _leading_day(spark: SparkSession, table: str, column: str) -> str | None:
    """The first partition column, if it holds the day of the given column."""
    parts = partition_columns(spark, table)
    named = _day_column(spark, table, column) or next((p for p in parts if p.lower() == column.lower()), None)
    return named if named and parts[0] == named and isinstance(spark.table(quoted(table)).schema[named].dataType, DateType) else None


def _strays(current: DataFrame, parts: list[str], day_column: str, column: str, day: dt.date | str) -> list[Row]:
    """Partitions without a day that hold rows of a date."""
    if day_column.lower() == column.lower():
        return []
    return _partitions(current.where(F.col(day_column).isNull() & on_date(column, day)), parts)


def replace_day(spark: SparkSession, df: DataFrame, table: str, column: str, day: dt.date | str) -> bool:
    """Put the rows of a frame in the place of a date's rows, in one commit; False if the table isn't partitioned.

    Rows of the frame that are of other dates are added to theirs. The frame runs once and must not read the table.
    """
    settle(spark, table)
    parts = partition_columns(spark, table)
    if not parts:
        return False
    folder = _change_folder(spark, table)
    _stage(fitted(spark, df, table), folder)
    current = spark.table(quoted(table))
    day_column = _leading_day(spark, table, column)
    concerned: list = []
    kept = current
    if day_column:
        whole = parts == [day_column]
        concerned = _partitions(current.where(F.col(day_column) == day_literal(day)).limit(1), parts) if whole else [{day_column: day}]
        old = _strays(current, parts, day_column, column, day)
        kept = current.where(F.coalesce(F.col(day_column) != day_literal(day), F.lit(True)))
    else:
        old = _partitions(current.where(on_date(column, day)), parts)
    fresh = _partitions(_staged(spark, table, folder), parts)
    mixed = list({row["_key"]: row for row in old + fresh}.values())
    if mixed:
        _stage(purge(kept.where(_in_partitions(mixed)), column, day).select(*current.columns), folder)
    _commit(spark, table, folder, concerned + old)
    return True


def remove_version(spark: SparkSession, table: str, previous: str) -> bool:
    """Delete an old version's folder that ``rewrite`` has named, unless the table points to it. Returns whether it was there."""
    place = location(spark, table)
    if place.rstrip("/") == previous.rstrip("/"):
        raise ValueError("the table is in this folder")
    if previous.split(VERSION)[0].rstrip("/") != place.split(VERSION)[0].rstrip("/"):
        raise ValueError(f"{previous} is no version of {table}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(previous)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def add_table_column(spark: SparkSession, table: str, name: str, kind: str) -> bool:
    """Add a column unless the table has it. Returns whether it was added."""
    if name.lower() in (c.lower() for c in spark.table(quoted(table)).columns):
        return False
    spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS (`{name}` {kind})")
    return True
