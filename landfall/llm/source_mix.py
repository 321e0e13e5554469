"""Mixing sources to target weights by weighted fair queueing; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, least_of, staged

#: Weights of sources in code-point order, repeating: fixed values of the contract.
WEIGHTS = (3, 1, 2)

#: Words in a range of finish times; there are as many ranges as the budget needs.
RANGE = 1 << 22


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], budget: float, most: int) -> DataFrame:
    """Share ``budget`` times all sizes among the sources by weight; none gets more than ``most`` times its size.

    What a full source leaves is shared by the others. A source is full if the budget lasts beyond the level at which it fills up, where
    every source has its weight times the level or is full itself. One row per source in, so the windows over all of them are small.
    """
    by_name, all_rows = W.orderBy(F.col("src").asc_nulls_last()), W.partitionBy()
    up_to = W.orderBy("level").rangeBetween(W.unboundedPreceding, W.currentRow)
    order = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    shared = (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (order + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(all_rows) * F.lit(float(budget)))
        .withColumn("open_weight", F.sum("weight").over(all_rows) - F.sum("weight").over(up_to))
        .withColumn("full", F.sum("cap").over(up_to) + F.col("level") * F.col("open_weight") <= F.col("budget"))
    )
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(all_rows), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("weight"))).over(all_rows)
    return shared.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(left * F.col("weight") / open_))


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def mix_sources(
    docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, most: int = 2, digits: int = 3, source: str = "source", doc_id: str = "doc_id",
    digest: Column | None = None, width: int = RANGE,
) -> DataFrame:
    """Queue the documents of each source in shuffled order, ``most`` times over, and serve all queues in the order of virtual finish times.

    Returns ``most`` rows (copies 0, 1, ..) per document: ``doc``, all its columns, and ``mix``: size, source_size, target, stretch and number (which name the
    document within its source), copy, start and finish
    (virtual times: words of the source queued before, and with this copy, divided by its target) and taken (words served). Over all sources, copies are
    taken in the order of finish, source, place and copy until the budget is spent; the one in which that happens is cut there. As sources finish
    words in proportion to their targets, each gets its target but for about a document. Rows come range-sorted by finish.

    The place in a queue is the md5 of the doc_id and ``digest``, which is that of the column ``text`` if none is given; so reruns agree, also where many rows share a doc_id or have none, however
    the input is partitioned. Rows equal in all three are interchangeable. A null source is one of its own, a null
    text has size 0, and documents of size 0 are never taken. An empty table gives no rows.

    A source of any size is dealt over 16 ** ``digits`` stretches of the shuffled order: sums of stretches give where each begins, and only
    within a stretch rows are added up in order. Finish times are cut into ranges of about ``width`` words of the budget: sums of ranges give where
    the budget ends, and only in that range copies are added up in order. Queues are written to the scratch folder in between.
    """
    if digest is None:
        digest = text_digest(F.col("text")) if "text" in docs.columns else F.lit("")
    shuffled = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), digest).cast("binary"))
    rows = docs.select(F.struct("*").alias("doc"), size.alias("size"), F.col(source).cast("string").alias("src"), shuffled.alias("place"))
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("src")), F.lit(""))).withColumn("stretch", F.substring("place", 1, digits))
    sums = rows.groupBy("key", "src", "stretch").agg(F.sum("size").alias("words"))
    sources = targets(sums.groupBy("key", "src").agg(F.sum("words").alias("source_size")), weights, budget, most).select("key", "source_size", "target", "budget")
    before = W.partitionBy("key").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    stretches = sums.select("key", "stretch", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before")).join(sources, "key")

    inner = W.partitionBy("key", "stretch").orderBy("place", "size")
    inside = F.coalesce(F.sum("size").over(inner.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    queued = rows.withColumns({"inside": inside, "number": F.row_number().over(inner)}).join(stretches, ["key", "stretch"])
    copies = queued.withColumn("copy", F.explode(F.array(*map(F.lit, range(most))))).withColumn(
        "queued", F.col("before") + F.col("inside") + F.col("copy") * F.col("source_size"))
    time = lambda words: F.when(F.col("target") > 0, words / F.col("target"))
    timed = copies.withColumns({"start": time(F.col("queued")), "finish": time(F.col("queued") + F.col("size"))})
    timed = staged(timed.withColumn("range", F.coalesce(F.floor(F.col("finish") * F.col("budget") / width), F.lit(0))).drop("key", "before", "inside", "queued"), "queues")

    by_range = timed.groupBy("range").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    ahead = F.coalesce(F.sum("words").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row per range
    left = by_range.select("range", (F.floor("budget") - ahead).alias("left"), "words")
    ranged = timed.join(left, "range")
    open_ = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    whole = ranged.where(~open_).withColumn("taken", F.when(F.col("left") > 0, F.col("size")).otherwise(F.lit(0)))
    order = W.partitionBy("range").orderBy("finish", F.col("src").asc_nulls_last(), "place", "copy").rowsBetween(W.unboundedPreceding, -1)
    cut = ranged.where(open_).withColumn("left", F.col("left") - F.coalesce(F.sum("size").over(order), F.lit(0)))
    cut = cut.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left"))))
    mix = F.struct("size", "source_size", "target", "stretch", "number", "copy", "start", "finish", F.col("taken").cast("long").alias("taken"))
    served = whole.unionByName(cut).select("doc", mix.alias("mix"))
    return served.repartitionByRange("mix.finish").sortWithinPartitions("mix.finish")


def taken_documents(docs: DataFrame, mixed: DataFrame, keep: Column, source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of a mix over ``doc_id``, ``source`` and ``digest``, as often as copies are kept, with all their columns as they were.

    Texts are looked up by these three once the mix is made, so they are shuffled once. Of rows equal in all three but not in other columns, the one
    whose other columns are the least as JSON stands for all.
    """
    key = lambda s: F.coalesce(F.concat(F.lit("="), s.cast("string")), F.lit(""))
    name = lambda d, s, x: [key(d).alias("__d"), key(s).alias("__s"), x.alias("__x")]
    names = ["__d", "__s", "__x"]
    kept = mixed.where(keep).select(*name(F.col("doc.doc_id"), F.col("doc.source"), F.col("doc.digest"))).groupBy(*names).agg(F.count("*").alias("__n"))
    order = least_of(docs, text, doc_id, source)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(*name(F.col(doc_id), F.col(source), text_digest(F.col(text))), whole.alias("doc"), order.alias("__order"))
    one = rows.join(kept, names).groupBy(*names).agg(F.min_by("doc", "__order").alias("doc"), F.first("__n").alias("__n"))
    return one.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select("doc.*")


ORACLE = """
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size, md5(coalesce(doc_id::VARCHAR, '') || ':' || sha256(coalesce(text, ''))) AS place
    FROM documents
), s AS (
    SELECT source, sum(size) AS source_size, list_extract([3, 1, 2], 1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT) AS weight
    FROM d GROUP BY source
), l AS (
    SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS level, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s
), f AS (
    SELECT *, sum(cap) OVER u + level * (sum(weight) OVER () - sum(weight) OVER u) <= budget AS is_full
    FROM l WINDOW u AS (ORDER BY level RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), t AS (
    SELECT *, CASE WHEN is_full THEN cap::DOUBLE ELSE
        (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0)) * weight / sum(CASE WHEN NOT is_full THEN weight END) OVER () END AS target
    FROM f
), q AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS queued, row_number() OVER () AS r FROM d
), c AS (
    SELECT q.*, t.source_size::BIGINT AS source_size, t.target, t.budget, copy, CASE WHEN t.target > 0 THEN (queued + copy * t.source_size::BIGINT + size)::BIGINT::DOUBLE / t.target END AS finish
    FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) AS two(copy)
), b AS (
    SELECT *, coalesce(sum(size) OVER (ORDER BY finish NULLS FIRST, source NULLS LAST, place, copy, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM c
)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target, sum(greatest(0, least(size, floor(budget)::BIGINT - ahead)))::BIGINT AS taken
FROM b GROUP BY r, doc_id, size, source_size, target
"""
