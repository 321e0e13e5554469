"""Fingerprints that add up: a homomorphic hash of the multiset of a text's paragraphs; DataFrame functions only."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import NULL_ID

#: Lanes of 21 bits, three to a long; 63 lanes from the bits of each of four hashes.
BITS, SLOTS, HASHES = 21, 3, 4
LONGS = BITS * HASHES
LANES = LONGS * SLOTS
_FIELD = (1 << BITS) - 1
_ONES = sum(1 << BITS * s for s in range(SLOTS))
_PART = 1 << 20


def pieces(text: Column) -> Column:
    """Paragraphs: they end with a line break, and a sentence's end within a line ends one as well."""
    return F.split(text, r"(?<=\n)|(?<=[.!?])(?![.!?\n])")


def _fieldwise(a: Column, b: Column, sign: int) -> Column:
    """Longs added (or taken away) lane by lane modulo 2 ** 21."""
    out = F.lit(0).cast("long")
    for s in range(SLOTS):
        x, y = (F.shiftright(v, BITS * s).bitwiseAND(F.lit(_FIELD)) for v in (a, b))
        out = out.bitwiseOR(F.shiftleft((x + sign * y).bitwiseAND(F.lit(_FIELD)), BITS * s))
    return out


def added(a: Column, b: Column) -> Column:
    """The vector of two multisets put together; inserts pieces."""
    return F.zip_with(a, b, lambda x, y: _fieldwise(x, y, 1))


def removed(a: Column, b: Column) -> Column:
    """The vector of a multiset without another; deletes pieces."""
    return F.zip_with(a, b, lambda x, y: _fieldwise(x, y, -1))


def _sums(piece: Column) -> list[Column]:
    """The vector of the pieces in a group, at most 2 ** 20 of them: each bit of the hashes is counted in its lane."""
    sums = []
    for h in range(HASHES):
        code = F.xxhash64(F.lit(h), piece)
        for j in range(BITS):
            bits = F.shiftrightunsigned(code, j).bitwiseAND(F.lit(_ONES))
            sums.append(F.sum(F.when(piece != "", bits).otherwise(F.lit(0))))
    return sums


def vectors(rows: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """For each row, named by ``keys``, the vector and number of pieces of each of its texts (``<text>_lanes``, ``<text>_n``).

    Only the keys travel with the pieces. If the rows are partitioned by one of the keys, nothing is shuffled.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(t).alias("value")) for i, t in enumerate(texts)]))
    single = rows.select(*keys, kinds.alias("t")).select(*keys, "t.kind", F.posexplode(pieces(F.col("t.value"))).alias("at", "piece"))
    single = single.withColumn("part", F.shiftright("at", 20))
    names = [f"x{i}" for i in range(LONGS)]
    counted = single.groupBy(*keys, "kind", "part").agg(
        F.sum(F.when(F.col("piece") != "", 1).otherwise(0)).alias("n"), *[s.alias(n) for s, n in zip(_sums(F.col("piece")), names)])
    parts = counted.select(*keys, F.struct("kind", "n", F.array(*names).alias("lanes")).alias("one"))
    zero = F.array_repeat(F.lit(0).cast("long"), LONGS)
    gathered = parts.groupBy(*keys).agg(F.collect_list("one").alias("all"))
    out = []
    for i, t in enumerate(texts):
        kind = F.lit(i)
        mine = F.filter("all", lambda x: x["kind"] == kind)  # noqa: B023
        out.append(F.aggregate(mine, zero, lambda acc, x: added(acc, x["lanes"])).alias(f"{t}_lanes"))
        out.append(F.aggregate(mine, F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias(f"{t}_n"))
    return gathered.select(*keys, *out)


def centred(lanes: Column, n: Column) -> Column:
    """Each lane as a sum of +1 and -1."""
    spread = F.flatten(F.transform(lanes, lambda x: F.array(*[F.shiftright(x, BITS * s).bitwiseAND(F.lit(_FIELD)) for s in range(SLOTS)])))
    return F.transform(spread, lambda b: (2 * b - n).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def likeness(a: Column, b: Column, lanes_a: Column, lanes_b: Column) -> Column:
    """How much two multisets share, from their centred vectors: the cosine, not below 0. Equal vectors have 1; empty and other 0."""
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(lanes_a == lanes_b, 1.0).when(norm == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), _dot(a, b) / norm)))


def in_hex(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _bucketed(rows: DataFrame, rows_each: int, most: int) -> DataFrame:
    """The rows with ``bucket``, their stretch of the order by k and c; stretches hold about equally many rows, and there are at most 2 * most.

    A k with more rows than a stretch holds is at several quantiles. Its rows have as many stretches of their own, dealt by c.
    """
    n = rows.count()
    buckets = max(1, min(most, n // rows_each))
    times: Counter = Counter()
    if buckets > 1:
        fractions = [i / buckets for i in range(1, buckets)]
        times.update(rows.select(F.percentile_approx("k", F.array(*map(F.lit, fractions)), F.lit(4 * buckets))).head()[0])
    if not times:
        return rows.withColumn("bucket", F.lit(0))
    cuts = sorted(times)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    table, parts = F.lit(cuts), F.lit([times[k] for k in cuts])
    place = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.get(table, at + step - 1) < F.col("k")), at + step).otherwise(at))
    mine = F.get(parts, F.col("place"))
    many = (F.get(table, F.col("place")) == F.col("k")) & (mine > 1)
    part = F.when(many, 1 + F.floor(F.col("c") * mine / 2**32)).otherwise(0).cast("int")
    return rows.withColumn("place", place).withColumn("bucket", F.col("place") * (max(times.values()) + 1) + part).drop("place")


def fingerprints(docs: DataFrame, rows_each: int = 2000, most_buckets: int = 4096, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprint each text, and the text with its second half replaced by the beginning of the next document's.

    A text's vector has 252 lanes modulo 2 ** 21. A paragraph adds the bits of its wide hash to them, so vectors of paragraphs put together add
    up, in any order, and paragraphs can be inserted (``added``) and deleted (``removed``) without the rest. Equal texts, and texts with
    the same paragraphs in another order, have equal vectors.

    Returns one row per document: doc_id, n_chars, edited_sha256, lanes, n, edited_lanes, edited_n, next_lanes, next_n. The edited text is the text
    whose last floor(n_chars / 2) code points are replaced by the first as many (or all) of the next document, by descending doc_id; after the
    last comes the first. A null doc_id is the smallest, rows with equal doc_id are ordered by the CRC32 of
    the text and then by text. Null texts count as empty; an empty text
    has a vector of zeros. A lone document is its own next one. Other columns are not looked at; an empty table gives no rows.

    Documents are dealt to stretches of the order, cut at quantiles of the doc_id; rows that share one doc_id are dealt further. The first document of a stretch is also given to the
    stretch before it, so each text is shuffled once, and the paragraphs not at all.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("k"), F.crc32(whole.cast("binary")).alias("c"), F.col(doc_id).alias("doc_id"), whole.alias("text"))
    rows = _bucketed(rows, rows_each, most_buckets)
    heads = rows.groupBy("bucket").agg(F.max(F.struct("k", "c")).alias("head"))  # one row per stretch, at most 8192
    every = W.partitionBy()
    to = F.coalesce(F.lead("bucket").over(W.orderBy("bucket")), F.min("bucket").over(every))
    heads = heads.select(F.col("head.k").alias("k"), F.col("head.c").alias("c"), to.alias("to"))
    found = rows.drop("bucket").join(F.broadcast(heads), ["k", "c"]).groupBy("k", "c", "to").agg(F.first("doc_id").alias("doc_id"), F.max("text").alias("text"))
    more = found.select("k", "c", "doc_id", "text", F.col("to").alias("bucket"), F.lit(1).alias("extra"))
    dealt = rows.select("k", "c", "doc_id", "text", "bucket", F.lit(0).alias("extra")).unionByName(more)

    order = W.partitionBy("bucket").orderBy("extra", F.desc("k"), F.desc("c"), F.desc("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rest = (F.col("n_chars") - half).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), rest), F.coalesce(F.col("next"), F.lit("")).substr(F.lit(1), half))
    pairs = (
        dealt.select("*", F.lead("text").over(order).alias("next"), F.row_number().over(order).alias("rn"), F.char_length("text").cast("long").alias("n_chars"))
        .withColumn("edited", edited)
        .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    )
    keys = ["bucket", "rn", "extra", "doc_id", "n_chars", "edited_sha256"]
    follows = W.partitionBy("bucket").orderBy("rn")
    return (
        vectors(pairs, keys, ["text", "edited"])
        .withColumns({"next_lanes": F.lead("text_lanes").over(follows), "next_n": F.lead("text_n").over(follows)})
        .where("extra = 0")
        .select("doc_id", "n_chars", "edited_sha256", F.col("text_lanes").alias("lanes"), F.col("text_n").alias("n"), "edited_lanes", "edited_n", "next_lanes", "next_n")
    )
