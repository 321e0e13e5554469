"""Replacing a table as a whole, without a moment in which its rows are lost.

The new version is built in full under a name of its own beside the table and read once. Only then it takes the table's place. An unpartitioned
table that keeps its columns is pointed to the new version's folder, one change of metadata. Otherwise the two names are changed in turn: the
new version is marked before, an error between the two renames takes the first back, and ``settle``, which every writer of the library begins with,
finishes the swap of a job that died there. A failure before leaves the old version, one after the new.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder, folder_is_empty
from ..sources import qualified_path
from .tables import (
    INTENT, NEW, OLD, REPLACES, VERSION, append_rows, change_folders, empty_table, location, partition_columns, point_to, properties, quoted, renamed, settle, sibling, siblings, step,
    text, version_folder,
)

_LOCATION = re.compile(r"\bLOCATION\s+(?:'([^']*)'|\"([^\"]*)\")", re.IGNORECASE)
_CREATED = re.compile(r"\s*CREATE\s+(?:OR\s+REPLACE\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?((?:`[^`]+`|[\w-]+)(?:\.(?:`[^`]+`|[\w-]+))*)", re.IGNORECASE)
_PROVIDER = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\b(USING\s+\w+)", re.IGNORECASE)
_REPLACE = re.compile(r"(\s*CREATE)\s+OR\s+REPLACE\b", re.IGNORECASE)


def defined_name(ddl: str) -> str | None:
    """The name in a CREATE statement, as it is written there."""
    found = _CREATED.match(ddl)
    return found.group(1) if found else None


def same_table(name: str | None, table: str) -> bool:
    """Whether two names are of one table, as far as both say; each needs a schema."""
    a, b = ((x or "").replace("`", "").lower().split(".") for x in (name, table))
    n = min(len(a), len(b))
    return n >= 2 and a[-n:] == b[-n:]


def _reads(spark: SparkSession, ddl: str, table: str) -> bool:
    """Whether what a CREATE statement selects reads the table, by its name or through a view."""
    plan = spark.sql(f"EXPLAIN EXTENDED {ddl}").first()[0]
    if plan.startswith("Error occurred during query planning"):
        raise ValueError(plan.split("\n", 1)[1])
    analysed = plan.split("== Analyzed Logical Plan ==")[-1].split("== Optimized Logical Plan ==")[0]
    return any(same_table(name, table) for name in re.findall(r"\b(?:Relation|SubqueryAlias|View \()\s*([\w.`-]+)", analysed.replace("(`", "(").replace("`", "")))


def _place_for(spark: SparkSession, wanted: str, old: str) -> str:
    """Where a definition with a location has its new version: there if nothing is there, beside the old version if that is there."""
    base = qualified_path(spark, wanted).rstrip("/")
    if base == unquote(qualified_path(spark, old)).rstrip("/").split(VERSION)[0]:
        return version_folder(base)
    if not folder_is_empty(spark, base):
        raise ValueError(f"the definition's location {wanted} holds files that aren't the table's")
    return base


def _placed(spark: SparkSession, ddl: str, old: str) -> tuple[str, str | None]:
    """A definition with its place for the new version, and that place. It is put behind the provider if none is named."""
    if wanted := _LOCATION.search(ddl):
        place = _place_for(spark, wanted.group(1) or wanted.group(2) or "", old)
        return f"{ddl[: wanted.start()]}LOCATION {text(place)}{ddl[wanted.end():]}", place
    provider = next((m for m in _PROVIDER.finditer(ddl) if m.group(1)), None)
    if provider is None:
        return ddl, None
    place = version_folder(old)
    return f"{ddl[: provider.end()]} LOCATION {text(place)}{ddl[provider.end():]}", place


def _same_shape(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two tables are unpartitioned Parquet of the same columns and properties."""
    def shape(name: str):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Provider'").first()
        props = {k: v for k, v in properties(spark, name).items() if k.startswith("landfall.") and k not in (REPLACES, INTENT)}
        return spark.table(quoted(name)).schema, props, rows and rows["data_type"].lower()

    return not partition_columns(spark, a) and not partition_columns(spark, b) and shape(a) == shape(b) and shape(a)[2] == "parquet"


def _is_external(spark: SparkSession, table: str) -> bool:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Type'").first()["data_type"] == "EXTERNAL"


def _like(spark: SparkSession, new: str, table: str) -> str:
    """An empty table of the same columns, partitions and properties, in a folder for versions, which is returned."""
    props = ", ".join(f"{text(k)}={text(v)}" for k, v in properties(spark, table).items() if k.startswith("landfall.") and k != INTENT)
    place = version_folder(location(spark, table))
    spark.sql(f"CREATE TABLE {renamed(new)} LIKE {renamed(table)} USING parquet LOCATION {text(place)}" + (f" TBLPROPERTIES ({props})" if props else ""))
    return place


def swap(spark: SparkSession, table: str, new: str) -> dict[str, object]:
    """Let a complete table take the place of another one; ``previous`` names the old version's folder if that is kept."""
    short = table.replace("`", "").split(".")[-1].lower()
    if _same_shape(spark, table, new) and _is_external(spark, new):
        previous, folder = location(spark, table), location(spark, new)
        point_to(spark, table, folder)
        step(spark, f"DROP TABLE {quoted(new)}")
        return {"changed": True, "previous": previous}
    old = sibling(table, OLD)
    step(spark, f"ALTER TABLE {quoted(new)} SET TBLPROPERTIES ({text(REPLACES)}={text(short)})")
    step(spark, f"ALTER TABLE {quoted(table)} RENAME TO {renamed(old)}")
    try:
        step(spark, f"ALTER TABLE {quoted(new)} RENAME TO {renamed(table)}")
    except Exception:
        spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {renamed(table)}")
        raise
    step(spark, f"ALTER TABLE {quoted(table)} UNSET TBLPROPERTIES IF EXISTS ({text(REPLACES)})")
    step(spark, f"DROP TABLE {quoted(old)}")
    return {"changed": True}


def full_refresh(spark: SparkSession, table: str, ddl: str | None = None, rows: DataFrame | None = None) -> dict[str, object]:
    """Replace the table by an empty one, or by one with ``rows``; with its registered definition, by what that makes.

    The definition must be of this table, have no placeholder left and not read the table. Its location must be the table's
    or hold no files; where it is the table's, the new version lies beside the old. ``CREATE OR REPLACE`` counts as ``CREATE``. A
    definition that doesn't work leaves the table with all its rows. ``rows`` may read the table.

    Without a definition a table that isn't there is left so, and one partitioned keeps its name while its partitions are emptied
    unless ``rows`` are given. A table whose columns or partitions change lies in a named folder from then on, so dropping it leaves its files.
    """
    settle(spark, table)
    name = table
    if ddl is not None:
        name = defined_name(ddl)
        if not same_table(name, table):
            raise ValueError(f"the definition is of {name or 'no table'}, not of {table}")
        if "${" in ddl:
            raise ValueError("the definition holds a placeholder without a value")
        ddl = _REPLACE.sub(r"\1", ddl, count=1)
    if not spark.catalog.tableExists(quoted(table)):
        if ddl is not None:
            step(spark, ddl)
        if rows is not None:
            append_rows(spark, rows, table)
        return {"changed": ddl is not None, "created": ddl is not None}
    if ddl is None and rows is None and partition_columns(spark, table):
        empty_table(spark, table)
        return {"changed": True}
    new, made = sibling(table, NEW), None
    try:
        if ddl is None:
            made = _like(spark, new, table)
        else:
            ddl = ddl.replace(name, quoted(new), 1)
            if _reads(spark, ddl, table):
                raise ValueError(f"the definition reads {table}, which it replaces")
            ddl, made = _placed(spark, ddl, location(spark, table))
            spark.sql(ddl)
        if rows is not None:
            append_rows(spark, rows, new)
        spark.table(quoted(new)).isEmpty()  # it can be read
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(new)}")
        if made:
            delete_folder(spark, made)
        raise
    return swap(spark, table, new)


def remove_leftovers(spark: SparkSession, table: str) -> int:
    """Drop what refreshes and changes that died have left beside a table; call it when none is under way. Returns how many names and folders went."""
    settle(spark, table)
    folders = change_folders(spark, table)
    for folder in folders:
        delete_folder(spark, folder)
    left = [*siblings(spark, table, NEW), *siblings(spark, table, OLD)]
    for name in left:
        place = location(spark, name) if _is_external(spark, name) else None
        spark.sql(f"DROP TABLE {quoted(name)}")
        if place and VERSION in place and qualified_path(spark, place).rstrip("/") != qualified_path(spark, location(spark, table)).rstrip("/"):
            delete_folder(spark, place)
    return len(left) + len(folders)


def replace_rows(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace everything the table holds by the rows of a frame, which may read it."""
    full_refresh(spark, table, rows=df)
