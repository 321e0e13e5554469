"""Exact dedup by a tree of merges over sorted runs of digests; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, least_of, staged


def bare(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _digests(docs: DataFrame, text: str, doc_id: str, runs: int) -> DataFrame:
    """Two digests of each text, what decides which copy stays, and the run that the row belongs to."""
    plain = docs.select(
        bare(F.col(text)).cast("binary").alias("bare"), F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_chars"), F.col(doc_id).alias("doc_id"))
    return plain.select(
        F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(runs)).cast("int").alias("run"),
        F.xxhash64("bare").alias("digest"), F.sha2("bare", 256).alias("text_sha256"), "n_chars", "doc_id")


def merge_runs(rows: DataFrame, rounds: int, fan_in: int) -> DataFrame:
    """One row per text: the row that stays (``best``) and the number of copies.

    Round after round, ``fan_in`` neighbouring runs are merged into one, and of each text only its best row goes on. Rows of a run are
    ordered by the short digest; the long one tells texts apart whose short digests agree.
    """
    best = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    level = rows.select("run", "digest", "text_sha256", best.alias("best"), "copies")
    for _ in range(rounds + 1):
        level = level.groupBy("run", "digest", "text_sha256").agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
    return level


def exact_duplicates(docs: DataFrame, rounds: int = 3, fan_in: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Group texts that are equal without blanks and say which row of each group stays.

    Returns one row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chars. The row with the most code points stays, of those
    the one with the smallest doc_id; a null doc_id comes last. Of repeated rows with one doc_id and length, one stays. Null texts count as
    empty and are equal to each other and to blank ones. Other columns are not looked at. An empty table gives no rows.

    There are ``fan_in ** rounds`` runs at the start. Only digests are exchanged, and a run sends one row for each of its texts, however
    many copies it holds.
    """
    counted = _digests(docs, text, doc_id, fan_in**rounds).groupBy("run", "digest", "text_sha256", "n_chars", "doc_id").agg(F.count("*").alias("copies"))
    rows = staged(counted, "digests")
    groups = merge_runs(rows, rounds, fan_in).select("digest", "text_sha256", "best", F.col("copies").alias("group_size"))
    first = (F.col("n_chars") == -F.col("best.shorter")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    return (
        rows.join(staged(groups, "groups"), ["digest", "text_sha256"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (first & (F.col("copy") == 1)).alias("kept"), "text_sha256", "n_chars")
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without their copies, all columns as they were. Of rows equal in doc_id and text that whose other columns are the least as JSON stays."""
    name = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k")
    kept = exact_duplicates(docs, text=text, doc_id=doc_id).where("kept").select(name, "n_chars", "text_sha256")
    named = docs.select(F.struct("*").alias("doc"), F.concat(least_of(docs, text, doc_id), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("order"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "doc", "order", name, F.char_length("text").cast("long").alias("n_chars"), F.sha2(bare(F.col("text")).cast("binary"), 256).alias("text_sha256"))
    keys = ["k", "n_chars", "text_sha256"]
    return named.join(kept, keys, "left_semi").groupBy(*keys).agg(F.min_by("doc", "order").alias("doc")).select("doc.*")


ORACLE = """
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
    FROM documents
), r AS (
    SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""
