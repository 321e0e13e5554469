"""Configuration entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from ..functions import all_equal

_ENTRIES = "array<map<string,string>>"


def parse_entries(column: Column, kind) -> Column:
    """The entries of a params value as an array of maps; null when it cannot be read.

    The value may be JSON text of an object or of a list, or a record, a map, or a list of either.
    """
    if isinstance(kind, StringType):
        text = F.btrim(column)
        listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
        return F.from_json(listed, _ENTRIES)
    if isinstance(kind, MapType):
        return F.array(column).cast(_ENTRIES)
    if isinstance(kind, StructType):
        return F.array(F.from_json(F.to_json(column), "map<string,string>"))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        return F.from_json(F.to_json(column), _ENTRIES)
    return column.cast(_ENTRIES)


def explode_params(df: DataFrame, params: str = "params", entry: str = "entry") -> DataFrame:
    """One row per entry, in place of the params column, with its ``position``; unreadable values give no row."""
    others = [F.col(f"`{name}`") for name in df.columns if name != params]
    entries = parse_entries(F.col(f"`{params}`"), df.schema[params].dataType)
    return df.select(*others, F.posexplode(entries).alias("position", entry))


def rejected_params(df: DataFrame, params: str = "params") -> DataFrame:
    """Rows whose params value is there but cannot be read."""
    value = F.col(f"`{params}`")
    return df.where(value.isNotNull() & parse_entries(value, df.schema[params].dataType).isNull())


def process_entries(
    process_params: DataFrame, process_name: str, process_fn_name: str, arquetype_name: str
) -> DataFrame:
    """Entries of the active params rows for one process, function and archetype."""
    wanted = all_equal(
        {"process_name": process_name, "process_fn_name": process_fn_name, "arquetype_name": arquetype_name},
        active="active",
    )
    return explode_params(process_params.where(wanted))


def first_entry(entries: DataFrame) -> dict[str, str]:
    """The first entry as a mapping; none is an error.

    Which row comes first is settled by the entry's text, where the rows themselves have no order.
    """
    row = entries.orderBy("position", F.to_json("entry")).select("entry").limit(1).first()
    if row is None:
        raise LookupError("no active params for this process, function and archetype")
    return dict(row["entry"])


def each_entry(entries: DataFrame):
    """The entries one by one, in a fixed order. There is one per configured file or table."""
    rows = entries.orderBy("position", F.to_json("entry")).select("entry").toLocalIterator()
    return (dict(row["entry"]) for row in rows)
