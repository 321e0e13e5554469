"""Natural order, first rows and concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def natural_key(c: Column | str) -> Column:
    """A text whose plain order is the natural order of ``c``.

    Text parts compare in lower case. Each digit run becomes a low character, the number of its digits
    without leading zeros, and those digits, so runs of any length compare as numbers.
    """
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    runs = F.regexp_extract_all(text, F.lit(r"([^0-9]*)0*([0-9]*)"), F.lit(0))

    def encode(run: Column) -> Column:
        words = F.regexp_extract(run, r"(?s)\A([^0-9]*)", 1)
        digits = F.regexp_extract(run, r"([0-9]+)\z", 1)
        number = F.regexp_replace(digits, r"\A0+", "")
        return F.concat(
            words,
            F.when(
                digits != "",
                F.concat(F.lit("\u0001"), F.lpad(F.length(number).cast("string"), 9, "0"), number, F.lit("\u0001")),
            ).otherwise(F.lit("")),
        )

    return F.array_join(F.transform(runs, encode), "")


def natural_order(df: DataFrame, name: str, *ties: str) -> DataFrame:
    """Rows in natural order of ``name``. The ties let a range sort split a name that many rows share."""
    return df.orderBy(natural_key(name), name, *ties)


def natural_ends(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """First and last name of each group in natural order."""
    order = F.struct(natural_key(name), F.col(name))
    distinct = df.select(*keys, name).distinct()
    return distinct.groupBy(*keys).agg(
        F.min_by(name, order).alias("first_name"), F.max_by(name, order).alias("last_name")
    )


def first_row(df: DataFrame, *order: Column | str) -> DataFrame:
    """One row, settled by a full ordering. Each task keeps a single row, nothing is sorted as a whole."""
    return df.orderBy(*order).limit(1)


def concatenate(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name, duplicates kept; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
