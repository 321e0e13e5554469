"""Removal of long byte strings that occur more than once, by hash-compared suffix sorting.

Sorting every suffix of a corpus is out of reach, and needless: two equal strings of ``length`` bytes agree on everything, so also on the
place of their smallest ``gram`` (the *anchor*, chosen by hash among the grams of the string). So only suffixes at anchors are compared.

1. Each run of string starts with one anchor is a *segment*. Anchors that occur once in the corpus are dropped by a hash aggregation.
2. Equal segments, by two independent 64-bit hashes of which one covers the whole segment, collapse to one; a segment that occurs twice is
   covered whole. The bytes of all its places meet in an aggregation into a set: where that has several elements, the hash has misled, and the
   segments of that name get names by another hash.
3. What is left are segments at the ends of repeats. Those of one anchor meet, are sorted by the suffix after the anchor in a mergesort
   whose comparisons find the common extension by binary search over prefix polynomial hashes, and neighbours are compared byte by byte. In
   that order, strings are equal where the extensions to the right reach far enough and the bytes left of the anchor agree.
4. An anchor with more than ``group_limit`` different segments (6 MB of them) is not gathered: its strings are counted one by one in a hash
   aggregation, first by a hash and then, those that seem to repeat, by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_bytes, keyed, mixed, slices, staged

_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 18
_letters = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


class PrefixHashes:
    """Polynomial hashes of all prefixes of a byte string, and from them of any part of it."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_letters[data] * _power(_BASE, n), out=self.sums[1:])
        self.shift = _power(pow(_BASE, -1, 2**64), n + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.shift[begin]

    def windows(self, length: int) -> np.ndarray:
        return (self.sums[length:] - self.sums[:-length]) * self.shift[: len(self.sums) - length]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the parts from a and from b agree, ``most`` at most, by binary search."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.of(a, a + mid) == self.of(b, b + mid)
            low, high = np.where(same & open_, mid, low), np.where(same | ~open_, high, mid - 1)
        return low


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest value in each window."""
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[: len(x) - (width - k)], x[width - k :]) if k < width else x


def _segments(data: np.ndarray, ends: np.ndarray, length: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per slice: row, anchor hash, second hash, start in the row, strings, and place of the anchor after the start."""
    gram = length - width + 1
    rows, begins, sizes, held = [], [], [], 0

    def flush():
        row, begin, size = np.array(rows), np.array(begins), np.array(sizes)
        text = np.concatenate([data[b : b + s] for b, s in zip(begins, sizes)])
        hashes = PrefixHashes(text)
        grams = mixed(hashes.windows(gram))
        place = np.uint64((1 << 24) - 1)
        best = _slide(grams & ~place | np.arange(len(grams), dtype=np.uint64), width) & place
        starts = np.cumsum(size) - size
        first = np.zeros(len(best), bool)
        first[0], first[1:] = True, best[1:] != best[:-1]
        first[starts[starts < len(best)]] = True
        stops = starts + size - length + 1
        first[stops[stops < len(best)]] = True
        at = np.flatnonzero(first)
        to = np.append(at[1:], len(best))
        piece = np.searchsorted(starts, at, side="right") - 1
        inside = at < stops[piece]
        at, to, piece = at[inside], to[inside], piece[inside]
        anchor = best[at].astype(np.int64)
        raw = text.tobytes()
        second = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(at.tolist(), (to + (length - 1)).tolist())), np.uint64, len(at))
        return row[piece], grams[anchor].view(np.int64), second.view(np.int64), at - starts[piece] + begin[piece] - ends[row[piece]], to - at, anchor - at

    for row in range(len(ends) - 1):
        a, b = int(ends[row]), int(ends[row + 1])
        while b - a >= length:
            size = min(b - a, _PIECE + length - 1)
            rows.append(row), begins.append(a), sizes.append(size)
            held, a = held + size, a + _PIECE
            if held >= 2 * _PIECE:
                yield flush()
                rows, begins, sizes, held = [], [], [], 0
    if rows:
        yield flush()


def _anchors(length: int, width: int, combined: bool, bits: int = 64):
    """combined: only the anchors of each batch with their counts; otherwise every segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = in_bytes(batch.column("text"))
            k, c = (batch.column(x) for x in ("k", "c"))
            for row, h, g, start, n, off in _segments(data, ends, length, width):
                if combined:
                    value, count = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count.astype(np.int64))], ["h", "n"])
                else:
                    g = g if bits == 64 else g & ((1 << bits) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), k.take(pa.array(row)), c.take(pa.array(row)), pa.array(start * 65536 + n * 256 + off)], ["h", "g", "k", "c", "p"])

    return run


def _places(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, pa.StructArray, np.ndarray, list[bytes]]]:
    """Row, entry of the row's list, bytes from the start of the segment to its anchor, and the segment, some megabytes at a time."""
    data, ends = in_bytes(batch.column("text"))
    lists = batch.column("segs")
    row, entries = pa.compute.list_parent_indices(lists).to_numpy(), lists.flatten()
    p = entries.field("p").to_numpy()
    begin, size = ends[row] + (p >> 16), (p >> 8 & 255) - 1 + length
    step = max(1, (1 << 22) // (length + 256))
    for i in range(0, len(p), step):
        part = slice(i, i + step)
        yield row[part], entries.slice(i, step), p[part] & 255, [data[a : a + n].tobytes() for a, n in zip(begin[part].tolist(), size[part].tolist())]


def _fetch(length: int):
    """The bytes of the segments that a document's list names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, entries, off, segs in _places(batch, length):
                named = [entries.field(x) for x in ("h", "g", "n", "n_g")]
                yield pa.RecordBatch.from_arrays([*named, pa.array(off.astype(np.int32)), pa.array(segs, pa.binary())], ["h", "g", "n", "n_g", "off", "seg"])

    return run


def _rename(length: int, salt: int):
    """The places of a document's list with other names, by another hash of their bytes in each round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, entries, _, segs in _places(batch, length):
                names = [int.from_bytes(hashlib.blake2b(s, digest_size=8, salt=salt.to_bytes(8)).digest(), signed=True) for s in segs]
                keys = [batch.column(x).take(pa.array(row)) for x in ("k", "c")]
                yield pa.RecordBatch.from_arrays([entries.field("h"), pa.array(names, pa.int64()), *keys, entries.field("p")], ["h", "g", "k", "c", "p"])

    return run


def suffix_order(hashes: PrefixHashes, data: np.ndarray, group: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The suffixes in order of group and bytes: a mergesort of runs of doubling width, all runs of a round at once.

    Each suffix finds its place in the neighbouring run by binary search; a comparison is an extension by hashes and one byte after it.
    """

    def less(x, y, ties):
        most = np.minimum(size[x], size[y])
        ext = hashes.extension(begin[x], begin[y], most)
        ended = ext >= most
        next_x, next_y = (data[np.minimum(begin[z] + ext, len(data) - 1)] for z in (x, y))
        smaller = np.where(ended, np.where(size[x] == size[y], ties, size[x] < size[y]), next_x < next_y)
        return np.where(group[x] == group[y], smaller, group[x] < group[y])

    n = len(begin)
    order, width, index = np.arange(n), 1, np.arange(n)
    while width < n:
        pair = index // (2 * width) * (2 * width)
        left = index < pair + width
        low = np.where(left, np.minimum(pair + width, n), pair)
        high = np.where(left, np.minimum(pair + 2 * width, n), np.minimum(pair + width, n))
        base = low.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            mine, other = order[open_], order[mid]
            before = less(other, mine, ~left[open_])  # equal suffixes of the left run come first
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        merged = np.empty_like(order)
        merged[pair + (index - np.where(left, pair, np.minimum(pair + width, n))) + (low - base)] = order
        order, width = merged, 2 * width
    return order


def shared_strings(group: list[int], segs: list[bytes], offs: list[int], length: int) -> np.ndarray:
    """Which strings of each segment another segment of its group has as well; by segment and bytes before the anchor."""
    off, size = np.array(offs), np.array([len(s) for s in segs])
    data = np.frombuffer(b"".join(segs), np.uint8)
    starts = np.cumsum(size) - size
    anchor, right = starts + off, np.minimum(size - off, length)
    hashes = PrefixHashes(data)
    gid = np.unique(np.array(group), return_inverse=True)[1]
    order = suffix_order(hashes, data, gid, anchor, right)
    width = int(off.max()) + 1
    pad = np.concatenate([data, np.zeros(length, np.uint8)])
    after = pad[anchor[:, None] + np.arange(length)]
    after[np.arange(length) >= right[:, None]] = 0

    def common(order):
        """Bytes shared with the one before in the order, compared one by one; and if the order holds."""
        a, b = order[:-1], order[1:]
        most = np.where(gid[a] == gid[b], np.minimum(right[a], right[b]), 0)
        differ = after[a] != after[b]
        real = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), length), most)
        last = np.minimum(real, length - 1)
        fits = (gid[a] < gid[b]) | (gid[a] == gid[b]) & ((real >= most) & (right[a] <= right[b]) | (real < most) & (after[a, last] < after[b, last]))
        return np.append(0, real), bool(fits.all())

    shared, holds = common(order)
    if not holds:  # a hash collision misled a comparison: order by the bytes themselves
        order = np.array(sorted(range(len(segs)), key=lambda i: (gid[i], segs[i][offs[i] : offs[i] + length])))
        shared = common(order)[0]
    found = np.zeros((len(segs), width), bool)
    strings = size - length + 1
    for o in range(width):
        need = length - o
        cls = np.cumsum(np.append(True, (shared[1:] < need) | (gid[order[1:]] != gid[order[:-1]])))
        has = (off[order] >= o) & (off[order] - o < strings[order])
        x, cls = order[has], cls[has]
        if len(x) < 2:
            continue
        left = hashes.of(anchor[x] - o, anchor[x])
        by = np.lexsort((left, cls))
        a, b = x[by[:-1]], x[by[1:]]
        same = np.flatnonzero((cls[by[:-1]] == cls[by[1:]]) & (left[by[:-1]] == left[by[1:]]))
        if o and len(same):
            equal = (data[anchor[a[same], None] - o + np.arange(o)] == data[anchor[b[same], None] - o + np.arange(o)]).all(axis=1)
            if not equal.all():  # again: count by the bytes
                seen: dict = {}
                for i, q in zip(x.tolist(), cls.tolist()):
                    seen.setdefault((q, segs[i][offs[i] - o : offs[i]]), []).append(i)
                found[[i for v in seen.values() if len(v) > 1 for i in v], o] = True
                continue
        found[a[same], o] = True
        found[b[same], o] = True
    return found


def _solve(length: int, rows: int):
    """Group after group in the order of anchors; only whole groups, about ``rows`` segments at a time."""

    def answer(held):
        seen = dict.fromkeys(zip(held["h"], held["g"]))
        index = {key: i for i, key in reversed(list(enumerate(zip(held["h"], held["g"]))))}
        pick = [index[key] for key in seen]
        h, g, n, off, seg = ([held[x][i] for i in pick] for x in ("h", "g", "n", "off", "seg"))
        found = shared_strings(h, seg, off, length)
        out = [(h[i], g[i], (off[i] - np.flatnonzero(found[i]))[::-1].tolist()) for i in range(len(h)) if n[i] == 1 and found[i].any()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.int32()))], ["h", "g", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {x: [] for x in ("h", "g", "n", "off", "seg")}
        for batch in batches:
            for x in held:
                held[x] += batch.column(x).to_pylist()
            if len(held["h"]) >= rows:
                last = held["h"].index(held["h"][-1])
                if last:
                    yield answer({x: v[:last] for x, v in held.items()})
                    held = {x: v[last:] for x, v in held.items()}
        if held["h"]:
            yield answer(held)

    return run


def _strings(length: int, bits: int):
    """A row for each string of a segment, named by a hash of twice as many bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = batch.slice(part, 256).to_pylist()
                out = [(r["h"], r["g"], i, xxhash.xxh3_128_digest(r["seg"][i : i + length])[: max(1, bits // 4)]) for r in rows for i in range(len(r["seg"]) - length + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["h", "g", "i", "w"])

    return run


def _cut(length: int):
    """The spans of each document and what is left of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = in_bytes(batch.column("text"))
            lists, ids = batch.column("cover"), batch.column("doc_id")
            for begin, end in slices(ends, 1 << 21):
                spans, kept, sizes = [], [], []
                for i in range(begin, end):
                    text = data[ends[i] : ends[i + 1]]
                    edge = np.zeros(len(text) + 1, np.int32)
                    for s in lists[i].as_py() or ():
                        start, n = s["p"] >> 16, s["p"] >> 8 & 255
                        if s["at"] is None:
                            edge[start] += 1
                            edge[start + n - 1 + length] -= 1
                        else:
                            at = np.array(s["at"]) + start
                            edge[at] += 1
                            np.subtract.at(edge, at + length, 1)
                    covered = np.cumsum(edge[:-1]) > 0
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
                    kept.append(text[~covered].tobytes())
                    sizes.append(len(text))
                yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), pa.array(sizes, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, length: int = 200, width: int = 161, group_limit: int = 16384, text: str = "text", doc_id: str = "doc_id", hash_bits: int = 64) -> DataFrame:
    """Cut every byte covered by a ``length``-byte string that also starts at another place of the corpus.

    Returns one row per document: doc_id, n_bytes, ``spans`` (maximal removed runs of bytes, end exclusive) and ``kept`` (the remaining
    bytes, which need not be whole characters). Strings are judged on the input; overlaps in one document count; they never cross
    documents. Null texts count as empty, texts shorter than ``length`` are kept whole, equal texts of at least that length go whole. A null
    doc_id and repeated rows are kept, each row with its own result. Other columns are not looked at. An empty table gives no rows.

    ``width`` is how many grams compete for being the anchor, at most 255: fewer make more anchors, more make longer segments. All that is
    removed is compared by bytes, so ``hash_bits``, how many bits of a hash are kept, changes the work and not the result.
    """
    if not 1 <= width < min(256, length):
        raise ValueError("width must be from 1 to the smaller of 255 and length - 1")
    rows = keyed(docs, text=text, doc_id=doc_id)
    plain = rows.select("k", "c", "text").where(F.octet_length("text") >= length)
    counts = plain.mapInArrow(_anchors(length, width, True), "h long, n long")
    repeated = staged(counts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "anchors")
    every = plain.mapInArrow(_anchors(length, width, False, hash_bits), "h long, g long, k long, c binary, p long")
    found = staged(every.join(repeated, "h"), "segments")

    salt = 0
    while True:
        kinds = staged(found.groupBy("h", "g").agg(F.count("*").alias("n")), "kinds")
        mixed_ = kinds.groupBy("h").agg(F.count("*").alias("n_g"), F.min("n").alias("least")).where("least = 1").select("h", "n_g")
        wanted = kinds.join(staged(mixed_, "mixed"), "h", "left").where("n > 1 OR n_g IS NOT NULL")
        # Repeated rows give the same segments.
        named = found.join(wanted, ["h", "g"]).groupBy("k", "c").agg(F.collect_set(F.struct("h", "g", "n", "n_g", "p")).alias("segs"))
        fetched = rows.select("k", "c", "text").join(named, ["k", "c"]).select("text", "segs").mapInArrow(_fetch(length), "h long, g long, n long, n_g long, off int, seg binary")
        same = [F.max(x).alias(x) for x in ("n", "n_g", "off")]
        alike = fetched.groupBy("h", "g").agg(*same, F.collect_set("seg").alias("segs"))  # of one element, unless the hash misled
        ends = staged(alike.select("h", "g", "n", "n_g", "off", F.expr("if(n_g IS NULL, NULL, segs[0])").alias("seg"), F.expr("size(segs) > 1").alias("misled")), "ends")
        misled = ends.where("misled").select("h", "g")
        if misled.isEmpty():
            break
        salt += 1
        places = found.join(misled, ["h", "g"]).groupBy("k", "c").agg(F.collect_list(F.struct("h", "p")).alias("segs"))
        texts = rows.select("k", "c", "text").dropDuplicates(["k", "c"])
        other = texts.join(places, ["k", "c"]).mapInArrow(_rename(length, salt), "h long, g long, k long, c binary, p long")
        found = staged(found.join(misled, ["h", "g"], "left_anti").select("h", "g", "k", "c", "p").unionByName(other), "segments")

    few = ends.where(F.col("n_g") <= group_limit).repartition("h").sortWithinPartitions("h").mapInArrow(_solve(length, 2000), "h long, g long, at array<int>")
    strings = staged(ends.where(F.col("n_g") > group_limit).mapInArrow(_strings(length, hash_bits), "h long, g long, i int, w binary"), "strings")
    alike = strings.join(strings.groupBy("w").count().where("count > 1").select("w"), "w")
    seen = staged(alike.join(ends.select("h", "g", "seg"), ["h", "g"]).select("h", "g", "i", F.expr(f"substring(seg, i + 1, {length})").alias("s")), "alike")
    twice = seen.groupBy("s").count().where("count > 1").select("s")
    many = seen.join(twice, "s").groupBy("h", "g").agg(F.collect_list("i").alias("at"))
    some = many.join(kinds.where("n = 1").select("h", "g"), ["h", "g"], "left_semi")
    whole = kinds.where("n > 1").select("h", "g", F.lit(None).cast("array<int>").alias("at"))
    answers = staged(whole.unionByName(few).unionByName(some), "answers")

    cover = found.join(answers, ["h", "g"]).groupBy("k", "c").agg(F.collect_set(F.struct("p", "at")).alias("cover"))
    joined = rows.join(cover, ["k", "c"], "left").select("doc_id", "text", "cover")
    id_type = docs.schema[doc_id].dataType.simpleString()
    return joined.mapInArrow(_cut(length), f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
