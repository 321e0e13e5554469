"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import on_workers, scratch_path  # noqa: F401

#: Six ASCII blanks: fixed values of the contracts.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

NULL_ID = -(2**63)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read back, so that nothing before it is ever run again."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def keyed(docs: DataFrame, *columns: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``k`` (the doc_id) and ``c`` (128 bits of a digest of the whole text) name a row, ``text`` is never null.

    Only rows equal in both share a name, which is right, as they share every result. A checksum would not do: many rows may share a doc_id or have none.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("k"), F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)).alias("c"),
        F.col(doc_id).alias("doc_id"), whole.alias("text"), *columns,
    )


def least_of(docs: DataFrame, *named: str) -> Column:
    """An order of rows that are equal in the named columns: by the others, as JSON."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in named]
    return F.to_json(F.struct(*others)) if others else F.lit("")


def fold_case(column: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column without nulls, end to end, and the offsets of its rows."""
    raw = column.cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    ends = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def slices(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` bytes each."""
    begin, n = 0, len(ends) - 1
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + size, side="right")) - 1)
        yield begin, min(end, n)
        begin = min(end, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
