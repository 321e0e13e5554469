"""SimHash fingerprints linked by bit distance, found at anchor points of a covering code.

The 64 bits are cut into three blocks of 22 (two bits of padding). Of up to four differing bits, some block has at most one. The anchors of a
block are the code words of a Hamming code of 15 bits and one of 7 bits side by side; every block value is within 2 bits of one (the covering
radius), its home. If two blocks differ in at most 1 bit, the second lies within 3 bits (radius plus threshold) of the home of the first. So a
fingerprint goes to its home and to every anchor within that distance, and at each anchor those at home are compared with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, least_of, staged
from .components import components

BLOCK, BLOCKS = 22, 3
_PART = 1 << 15


# fingerprints


def simhash(text: str, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text: a bit is set if it is set in over half of the hashes of its shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.append(0, ends[: n - 1] + 1).tolist()
    stops = ends[len(ends) - n :].tolist()
    counts = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for begin in range(0, n, _PART):
        part = [hashed(joined[a:b], 42) for a, b in zip(starts[begin : begin + _PART], stops[begin : begin + _PART])]
        counts += np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column("text")), np.uint64, len(batch))
            columns = [batch.column(c) for c in ("k", "c", "doc_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], ["k", "c", "doc_id", "fp"])

    return run


# anchors


def _syndromes() -> np.ndarray:
    """By block value: which parity checks fail; 4 bits for the long code, 3 for the short one."""
    columns = [*range(1, 16), *(i << 4 for i in range(1, 8))]
    out = np.zeros(1, np.uint8)
    for column in columns:
        out = np.concatenate([out, out ^ np.uint8(column)])
    return out


def _patterns(syndromes: np.ndarray, reach: int) -> list[np.ndarray]:
    """By syndrome: what leads from a value to the anchors within ``reach`` bits, nearest first."""
    weight = np.bitwise_count(np.arange(1 << BLOCK, dtype=np.uint32))
    near = np.flatnonzero(weight <= reach)
    near = near[np.argsort(weight[near], kind="stable")]
    return [near[syndromes[near] == s] for s in range(128)]


_code: list = []


def anchors(values: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For block values: home anchors, and rows of (which value, anchor within reach)."""
    if not _code:
        syndromes = _syndromes()
        _code.extend((syndromes, {}))
    syndromes, patterns = _code
    if threshold not in patterns:
        patterns[threshold] = _patterns(syndromes, 2 + threshold)
    kinds = syndromes[values]
    home = np.empty_like(values)
    which, reached = [], []
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        home[at] = values[at] ^ patterns[threshold][kind][0]
        which.append(np.repeat(at, len(patterns[threshold][kind])))
        reached.append((values[at, None] ^ patterns[threshold][kind][None, :]).ravel())
    return home, np.concatenate(which), np.concatenate(reached)


def _replicas(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for b in range(BLOCKS):
                values = (fp.view(np.uint64) >> np.uint64(BLOCK * b) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
                home, which, reached = anchors(values, threshold)
                key = np.concatenate([home, reached]) | b << BLOCK
                is_home = np.arange(len(key)) < len(home)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(is_home), pa.array(np.concatenate([fp, fp[which]]))], ["anchor", "home", "fp"])

    return run


def spanning_links(home: np.ndarray, reach: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what the links between home and reach connect, fewer than there are fingerprints."""
    nodes, at = np.unique(np.concatenate([home, reach]), return_inverse=True)
    label, links = np.arange(len(nodes)), []
    theirs = at[len(home) :]
    for i, x in zip(at[: len(home)], home):
        near = theirs[np.bitwise_count(x ^ reach) <= bits]
        found, first = np.unique(label[near], return_index=True)
        new = found != label[i]
        if new.any():
            links += [(x, nodes[near[j]]) for j in first[new]]
            label[np.isin(label, found)] = label[i]
    return links


def _compare(bits: int):
    """Cell after cell of rows in order; a cell is at most a few thousand fingerprints."""

    def cell(home: np.ndarray, fp: np.ndarray, out: list) -> None:
        if home.any() and not home.all():
            out += spanning_links(fp[home], fp[~home], bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "cell", "home", "fp")]
            if rest is not None:
                rows = [np.concatenate(pair) for pair in zip(rest, rows)]
            name = rows[0].astype(np.int64) << 32 | rows[1]
            cuts = np.append(0, np.flatnonzero(name[1:] != name[:-1]) + 1) if len(name) else np.zeros(1, int)
            out: list = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                cell(rows[2][a:b], rows[3][a:b].view(np.uint64), out)
            rest = [r[cuts[-1] :] for r in rows]
            yield _as_links(out)
        if rest is not None:
            out = []
            cell(rest[2], rest[3].view(np.uint64), out)
            yield _as_links(out)

    return run


def _as_links(out: list) -> pa.RecordBatch:
    a, b = (np.array([link[i] for link in out], np.uint64).view(np.int64) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_links(prints: DataFrame, bits: int = 4, cell: int = 4096) -> DataFrame:
    """Links between different fingerprints (``fp``, each once) at most ``bits`` bits apart: not all, but enough to connect the same.

    An anchor with more than ``cell`` fingerprints is dealt over cells: home and reach are cut into parts, and each pair of parts meets.
    """
    rows = prints.mapInArrow(_replicas(bits // BLOCKS), "anchor int, home boolean, fp long")
    large = staged(rows.groupBy("anchor").count().where(F.col("count") > cell).select("anchor", F.ceil(F.col("count") / cell).cast("int").alias("parts")), "large")
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    dealt = rows.join(large, "anchor", "left").select("anchor", "home", "fp", parts.alias("parts"), mine.alias("mine"), other.alias("other"))
    place = F.when(F.col("home"), F.col("mine") * F.col("parts") + F.col("other")).otherwise(F.col("other") * F.col("parts") + F.col("mine"))
    cells = dealt.select("anchor", place.alias("cell"), "home", "fp").repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    return cells.mapInArrow(_compare(bits), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, cell: int = 4096, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprint every whole text and find what is linked by fingerprints at most ``bits`` bits apart.

    Returns one row per document: k and c (a name of the row), doc_id, ``fp`` (as a long), ``root`` (a fingerprint that names the
    component) and ``component_id``, the smallest doc_id of the component, null if none has one. Texts with fewer words than a shingle
    have one shingle, those without words (and null) the fingerprint zero, which is linked like any other. Equal fingerprints are one node, so
    copies cost nothing; other columns are not looked at; an empty table gives no rows.
    """
    if not 0 <= bits < 2 * BLOCKS:
        raise ValueError("bits must be from 0 to 5")
    rows = staged(keyed(docs, text=text, doc_id=doc_id).mapInArrow(_prints(shingle), f"k long, c binary, doc_id {docs.schema[doc_id].dataType.simpleString()}, fp long"), "prints")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(near_links(nodes.select("fp"), bits, cell)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answers = staged(named.select("fp", "root").join(least, "root"), "classes")
    return rows.join(answers, "fp").select("k", "c", "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, bits: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, that with the smallest doc_id (null comes last), with all its columns.

    Of rows equal in doc_id and text that whose other columns are the least as JSON stays.
    """
    found = near_duplicates(docs, shingle, bits, text=text, doc_id=doc_id)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "k", "c")).alias("best"))
    kept = best.select(F.col("best.k").alias("__k"), F.col("best.c").alias("__c"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = keyed(docs, whole.alias("doc"), least_of(docs, text, doc_id).alias("__order"), text=text, doc_id=doc_id).select(F.col("k").alias("__k"), F.col("c").alias("__c"), "doc", "__order")
    return named.join(kept, ["__k", "__c"], "left_semi").groupBy("__k", "__c").agg(F.min_by("doc", "__order").alias("doc")).select("doc.*")
