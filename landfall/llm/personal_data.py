"""Personal data by fixed forms, and by patterns that the fixed forms bootstrap.

Entities of a fixed form (e-mail, IP, card, phone) are seeds. The words before a seed are its patterns: the last one, and the last two. A
pattern that stands before several different seeds may announce other identifiers too, written in ways that no fixed form covers. Patterns and
instances make a graph with a link where an instance follows a pattern. Its scores are found in rounds: a pattern is as trusted as the share of
trusted instances among all that follows it, plain words included; an instance is trusted if patterns are that it follows. At the end,
instances of high trust after patterns of high trust are new entities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, mixed, slices, staged

#: Kinds in the order of the contract.
KINDS = ("email", "ip", "card", "phone")

# The forms of the contract, written so that no text takes more than linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# What may be an entity after a good pattern.
_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[ ().:/-]{0,2}+[0-9])++")
_MARKED = re.compile(r"@|\(at\)|\[at\]")
_EDGES = ".,;:!?\"'()<>[]"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_SPACE = frozenset(" \t\n\x0b\f\r")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        if domain := _DOMAIN.match(text, at + 1):
            begin = at
            while begin > done and text[begin - 1] in _LOCALS:
                begin -= 1
            if begin < at:
                done = domain.end()
                yield begin, done
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all entities of a fixed form, in this order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def other_candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what looks like an identifier and overlaps no entity; one place may be of several kinds."""
    out, last = [], -1
    for m in _MARKED.finditer(text):
        a, b = m.start(), m.end()
        if a < last:
            continue
        while a > 0 and text[a - 1] not in _SPACE:
            a -= 1
        while b < len(text) and text[b] not in _SPACE:
            b += 1
        last = b
        a += len(text[a:b]) - len(text[a:b].lstrip(_EDGES))
        out.append((a, 0, a + len(text[a:b].rstrip(_EDGES))))
    for m in _NUMBER.finditer(text):
        digits, marks = len(_NO_DIGIT.sub("", m.group())), m.group()
        kinds = ((1, marks.count(".") >= 3 or marks.count(":") >= 2), (2, 12 <= digits <= 19), (3, 7 <= digits <= 15))
        out += [(m.start(), kind, m.end()) for kind, fits in kinds if fits]
    starts = np.array([s for s, _, _ in taken])
    ends = np.maximum.accumulate(np.array([e for _, _, e in taken])) if taken else starts
    free = lambda a, b: not taken or (i := int(np.searchsorted(starts, b))) == 0 or ends[i - 1] <= a
    return sorted((a, kind, b) for a, kind, b in out if b > a and free(a, b))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + mixed(second))


def patterns_before(text: str, at: int) -> list[int]:
    """Names of the patterns that end before a place: one word, two words; digits count as 0. A word may reach up to the place itself."""
    window = text[max(0, at - 200) : at]
    words = window.encode().lower().translate(_DIGITS).split()
    if at > 200 and window and text[at - 201] not in _SPACE and window[0] not in _SPACE:
        words = words[1:]
    if not words:
        return []
    glued = np.uint64(window[-1] not in _SPACE)
    h = _word_hashes(words[-2:])
    out = [mixed(h[-1:] + glued)]
    if len(h) > 1:
        out.append(_pair(h[:1], h[1:] + glued))
    return [int(x[0].view(np.int64)) for x in out]


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the entities of fixed form, each with its patterns and a name of its value."""
    for batch in batches:
        found = []
        for text in batch.column("text"):
            text = text.as_py()
            found.append([
                {"start": a, "kind": kind, "end": b, "value": xxhash.xxh64_intdigest(text[a:b].lower().encode()) >> 1, "patterns": patterns_before(text, a)}
                for a, kind, b in base_entities(text)])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k", "c", "doc_id")), pa.array(found, _FOUND)], ["k", "c", "doc_id", "base"])


_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))]))
_FOUND_SQL = "array<struct<start:long,kind:int,end:long,value:long,patterns:array<long>>>"


def _followers(maybe, bits: int):
    """What follows the patterns: the number of words of any sort per pattern, and every candidate. ``maybe`` marks the hashes of patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, mask = maybe.value, np.uint64((1 << bits) - 1)
        hit = lambda h: marks[(h & mask).astype(np.int64)]
        for batch in batches:
            k, c = (batch.column(x).to_pylist() for x in ("k", "c"))
            sizes = np.append(0, np.cumsum([len(t) for t in (batch.column("text").cast(pa.large_binary()).to_pylist())]))
            for begin, end in slices(sizes, 1 << 22):
                totals, rows = [], []
                for i in range(begin, end):
                    text = batch.column("text")[i].as_py()
                    h = _word_hashes(text.encode().lower().translate(_DIGITS).split())
                    names = (mixed(h[:-1]), _pair(h[:-2], h[1:-1])) if len(h) > 2 else (mixed(h[:-1]),)
                    totals += [n[hit(n)] for n in names]
                    for a, kind, b in other_candidates(text, base_entities(text)):
                        names = np.array(patterns_before(text, a), np.int64)
                        for name in names[hit(names.view(np.uint64))].tolist():
                            rows.append((name, None, k[i], c[i], a, b, kind, xxhash.xxh64_intdigest(text[a:b].lower().encode()) >> 1))
                name, count = np.unique(np.concatenate(totals), return_counts=True)
                rows += [(x, n, None, None, None, None, None, None) for x, n in zip(name.view(np.int64).tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(_FOLLOW)], [n for n, _ in _FOLLOW])

    return run


_FOLLOW = [("pattern", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("c", pa.binary()), ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())]


def _scored(links: DataFrame, plain: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Trust of patterns and of instances. links: pattern, kind, value, seed; plain: pattern, words that follow."""
    values = links.groupBy("pattern").agg(F.countDistinct("kind", "value").alias("values"), F.count("*").alias("links"))
    after = values.join(plain, "pattern", "left").select("pattern", (F.col("values") + F.greatest(F.coalesce("n", F.lit(0)) - F.col("links"), F.lit(0))).alias("after"))
    known = links.groupBy("kind", "value").agg(F.max("seed").cast("double").alias("trust"))
    first = known
    edges = staged(links.select("pattern", "kind", "value").distinct(), "edges")
    for _ in range(rounds):
        ranked = edges.join(known, ["kind", "value"]).groupBy("pattern", "kind").agg(F.sum("trust").alias("sum"))
        trusted = staged(ranked.join(after, "pattern").select("pattern", "kind", F.least(F.lit(1.0), F.col("sum") / F.col("after")).alias("pattern_trust")), "patterns")
        doubt = edges.join(trusted, ["pattern", "kind"]).groupBy("kind", "value").agg(F.sum(F.log1p(-F.least("pattern_trust", F.lit(0.999)))).alias("doubt"))
        known = staged(first.join(doubt, ["kind", "value"]).select("kind", "value", F.greatest("trust", 1 - F.exp("doubt")).alias("trust")), "instances")
    return trusted, known


def find_entities(
    docs: DataFrame, least_seeds: int = 5, trust: float = 0.8, rounds: int = 3, bits: int = 22, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Find personal data in every whole text.

    Returns one row per document: doc_id, ``base`` (entities of a fixed form) and ``found`` (those, and the ones found by patterns), both as
    arrays of start, kind (an index of KINDS) and end in code points, in this order. Null texts count as empty and have none. Entities that
    follow no pattern with ``least_seeds`` different seeds, or of trust below ``trust``, are not added. Repeated rows each have their own result;
    other columns are not looked at; an empty table gives no rows.

    ``bits`` is the size of a bitmap, sent to all tasks, that spares most words a look-up; what passes it is joined exactly.
    """
    rows = keyed(docs, text=text, doc_id=doc_id)
    kind = docs.schema[doc_id].dataType.simpleString()
    base = staged(rows.select("k", "c", "doc_id", "text").mapInArrow(_seeds, f"k long, c binary, doc_id {kind}, base {_FOUND_SQL}"), "base")
    seeds = base.select(F.explode("base").alias("e")).select("e.kind", "e.value", F.explode("e.patterns").alias("pattern"))
    good = seeds.groupBy("pattern", "kind").agg(F.countDistinct("value").alias("n")).where(F.col("n") >= least_seeds)
    patterns = staged(good.select("pattern").distinct(), "announced")

    marks = np.zeros(1 << bits, bool)  # at most 2 ** bits places come to the driver
    low = patterns.select(F.col("pattern").bitwiseAND(F.lit((1 << bits) - 1)).alias("low")).distinct()
    marks[[r.low for r in low.toLocalIterator()]] = True
    maybe = docs.sparkSession.sparkContext.broadcast(marks)
    followed = rows.select("k", "c", "text").mapInArrow(_followers(maybe, bits), "pattern long, n long, k long, c binary, start long, end long, kind int, value long")
    followed = staged(followed.join(patterns, "pattern", "left_semi"), "followers")
    plain = followed.where("n is not null").groupBy("pattern").agg(F.sum("n").alias("n"))
    candidates = followed.where("n is null")

    links = seeds.join(patterns, "pattern", "left_semi").select("pattern", "kind", "value", F.lit(1).alias("seed"))
    links = staged(links.unionByName(candidates.select("pattern", "kind", "value", F.lit(0).alias("seed"))), "links")
    pattern_trust, value_trust = _scored(links, plain, rounds)
    sure = candidates.join(pattern_trust.where(F.col("pattern_trust") >= trust), ["pattern", "kind"], "left_semi").join(
        value_trust.where(F.col("trust") >= trust), ["kind", "value"], "left_semi")
    new = sure.groupBy("k", "c").agg(F.collect_set(F.struct("start", "kind", "end")).alias("new"))
    plain_base = F.transform("base", lambda e: F.struct(e["start"].alias("start"), e["kind"].alias("kind"), e["end"].alias("end")))
    joined = base.join(new, ["k", "c"], "left").withColumn("base", F.array_sort(plain_base))
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("new", F.array().cast("array<struct<start:long,kind:int,end:long>>")))).alias("found"))
