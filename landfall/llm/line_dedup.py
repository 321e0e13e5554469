"""Removal of repeated runs of lines, cut at places that the lines themselves choose.

Several chunkings are laid over each text, and what they remove is united. In the coarse one a rolling hash over the hashes of the last few lines
ends a chunk where it falls into one of ``mean`` classes; the cuts move along with the lines, so a long passage has the same chunks wherever
it stands, but for those at its ends. In each of the fine ones a line's hash says whether a chunk begins before it or ends after it, so a chunk of several
lines has its first and its last line to thank for its borders, and no line around it has a say: it is cut out of every text that holds it, also where the
text ends. A chunk of several lines that occurs again anywhere in the corpus is removed there; its first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, mixed, staged

_BASE = 0x9E3779B97F4A7C15


def chunk_ends(h: np.ndarray, mean: int, window: int, most: int) -> list[int]:
    """After which lines, told by their hashes, a coarse chunk ends: at least two lines each but for the last, and at most ``most``."""
    rolling = np.zeros(len(h), np.uint64)
    weight = 1
    for back in range(min(window, len(h))):
        rolling[back:] += h[: len(h) - back] * np.uint64(weight)
        weight = weight * _BASE % 2**64
    cut = mixed(rolling) % np.uint64(mean) == 0
    ends, begin = [], 0
    for i in np.flatnonzero(cut).tolist():
        while i + 1 - begin > most:
            begin += most
            ends.append(begin)
        if i + 1 - begin >= 2:
            begin = i + 1
            ends.append(begin)
    while len(h) - begin > most:
        begin += most
        ends.append(begin)
    if begin < len(h):
        ends.append(len(h))
    return ends


def fine_chunks(h: np.ndarray, fine: int) -> np.ndarray:
    """Where the chunks of several lines of the fine chunkings begin; each has two lines.

    Bit s of a line's mixed hash tells chunking s to cut before the line (set) or after it (not set), so lines stay together exactly where a set bit
    meets one that isn't.
    """
    bits = (mixed(h) >> np.uint64(20)) & np.uint64(2**fine - 1)
    return np.flatnonzero(bits[:-1] & ~bits[1:])


def lines_of(text: str) -> list[bytes]:
    """The lines without their ends; a newline at the end of the text begins no further line."""
    lines = text.encode().split(b"\n")
    return lines if lines[-1] else lines[:-1]


def places_of(lines: list[bytes], options: tuple[int, int, int, int]) -> list[tuple[int, int, bytes]]:
    """All chunks of several lines: where each begins, its number of lines, and 128 bits of a hash over the hashes of its lines."""
    if len(lines) < 2:
        return []
    *coarse, fine = options
    h = np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))
    places = {(begin, begin + 2) for begin in fine_chunks(h, fine).tolist()} if fine else set()
    ends = chunk_ends(h, *coarse)
    places.update((begin, end) for begin, end in zip([0, *ends], ends) if end - begin > 1)
    raw = h.tobytes()
    return [(begin, end - begin, xxhash.xxh3_128_digest(raw[8 * begin : 8 * end])) for begin, end in sorted(places)]


def _places(options: tuple[int, int, int, int]):
    kinds = {"h": pa.binary(), "k": pa.int64(), "c": pa.binary(), "at": pa.int32(), "size": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, c, texts = (batch.column(x) for x in ("k", "c", "text"))
            rows = []
            for i in range(len(batch)):
                rows += ((h, k[i].as_py(), c[i].as_py(), at, size) for at, size, h in places_of(lines_of(texts[i].as_py()), options))
                if len(rows) > 1 << 15 or i == len(batch) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds.values())], list(kinds))
                    rows = []

    return run


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k, c, texts, marks = (batch.column(x) for x in ("k", "c", "text", "marks"))
        rows, held = [], 0
        for i in range(len(batch)):
            lines = lines_of(texts[i].as_py())
            for mark in marks[i].as_py():
                chunk = b"\n".join(lines[mark["at"] : mark["at"] + mark["size"]])
                rows.append((mark["h"], chunk, k[i].as_py(), c[i].as_py(), mark["at"]))
                held += len(chunk)
                if held > 1 << 22:
                    yield _batch_of(rows)
                    rows, held = [], 0
        yield _batch_of(rows)


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"h": pa.binary(), "chunk": pa.binary(), "k": pa.int64(), "c": pa.binary(), "at": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds.values())], list(kinds))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_lines", "n_removed", "kept"]
    for batch in batches:
        ids, texts, gone = (batch.column(x) for x in ("doc_id", "text", "gone"))
        begin, kept, sizes, removed, held = 0, [], [], [], 0
        for i in range(len(batch)):
            text, spans = texts[i].as_py(), gone[i].as_py() or ()
            lines = lines_of(text)
            drop = np.zeros(len(lines), bool)
            for span in spans:
                drop[span["at"] : span["at"] + span["size"]] = True
            if spans:
                ends = [b"\n"] * len(lines)
                ends[-1] = b"\n" if text.endswith("\n") else b""
                text = b"".join(line + end for line, end, out in zip(lines, ends, drop.tolist()) if not out).decode()
            kept.append(text)
            sizes.append(len(lines))
            removed.append(int(drop.sum()))
            held += len(text)
            if held > 1 << 22 or i == len(batch) - 1:
                arrays = [ids.slice(begin, i + 1 - begin), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names)
                begin, kept, sizes, removed, held = i + 1, [], [], [], 0


def remove_repeated_lines(
    docs: DataFrame, mean: int = 4, window: int = 2, most: int = 256, fine: int = 8, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Remove every chunk of several lines that occurs before, in a document of smaller doc_id or further up in the same one.

    Returns one row per document: doc_id, n_lines, n_removed (lines) and ``kept``, the remaining text: the lines that stay, each with its end.
    Of a run of lines that repeats, ``fine`` chunkings (at most 32) leave a line at its border with a chance of 0.75 to that power and one inside it with 0.5 to it.
    The first occurrence of a line always stays. Hashes are counted first; the bytes of chunks (their lines without the last line's end) are
    fetched only where a hash repeats, and a hash that two different chunks share removes nothing. Single lines are
    never removed. Null texts count as empty. Rows with a null doc_id come first; rows that are equal in doc_id and text share all their
    results, so both keep what the first occurrence is. Other columns are not looked at; an empty table gives no rows.
    """
    rows = keyed(docs, text=text, doc_id=doc_id)
    plain = rows.select("k", "c", "text")
    places = plain.mapInArrow(_places((mean, window, most, fine)), "h binary, k long, c binary, at int, size int")
    often = places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    found = staged(places.join(often, "h"), "places")
    marks = found.groupBy("k", "c").agg(F.collect_set(F.struct("h", "at", "size")).alias("marks"))
    whole = plain.join(marks, ["k", "c"]).mapInArrow(_bytes, "h binary, chunk binary, k long, c binary, at int")
    equal = whole.groupBy("h", "chunk").agg(F.min(F.struct("k", "c", "at")).alias("first"), F.count("*").alias("n"))
    once = equal.groupBy("h").agg(F.count("*").alias("kinds"), F.min("first").alias("first"), F.sum("n").alias("n"))
    again = found.join(once.where("kinds = 1 and n > 1").select("h", "first"), "h").where(F.struct("k", "c", "at") != F.col("first"))
    gone = again.groupBy("k", "c").agg(F.collect_set(F.struct("at", "size")).alias("gone"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.join(gone, ["k", "c"], "left").select("doc_id", "text", "gone").mapInArrow(_cut, f"doc_id {kind}, n_lines long, n_removed long, kept string")
