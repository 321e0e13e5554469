"""The operators that use DataFrame functions only."""

import hashlib
import math
import random
import re
import zlib

import pytest
from compare import compare, oracle_connection
from pyspark.sql import functions as F

from landfall.llm.exact_dedup import exact_duplicates, keep_one
from landfall.llm.multiset_fingerprint import LONGS, _bucketed, added, fingerprints, removed
from landfall.llm.queries import ORACLE, QUERIES
from landfall.llm.simhash_dedup import keep_one as near_keep_one
from landfall.llm.source_mix import mix_sources, taken_documents, text_digest, words

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op6_source_mix"])
def test_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op6_source_mix", "op9_multiset_fingerprint"])
def test_no_python(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", text)


# exact dedup


def test_exact_dedup_cases(spark):
    rows = [(5, "a b"), (4, "ab "), (3, "ab"), (2, None), (1, ""), (None, " \t\n\x0b\f\r"), (9, "x"), (9, "x"), (None, "x"), (8, "x ")]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, digest int, run string")
    got = sorted(exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept").collect(), key=str)
    assert got == sorted([
        (5, 4, 3, False), (4, 4, 3, True), (3, 4, 3, False), (2, None, 3, False), (1, None, 3, False), (None, None, 3, True),
        (9, 9, 3, True), (9, 9, 3, False), (None, 9, 3, False), (8, 8, 1, True)], key=str)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["4", "8", "9", "None"]
    assert exact_duplicates(docs.limit(0)).count() == 0


# mixing


def mixed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, key string, place int")
    return docs, mix_sources(docs.withColumn("w", words(F.col("text"))), F.col("w"), **options)


def test_mix_shares_and_limits(spark):
    pick = random.Random(3)
    rows = [(i, "w " * pick.randint(0, 30), "abc"[min(2, i % 7)], "k", 1) for i in range(2000)] + [(5000 + i, "x y", None, None, None) for i in range(9)]
    docs, out = mixed(spark, rows, digits=1)
    per = out.groupBy("doc.source").agg(F.sum("mix.taken").alias("taken"), F.first("mix.target").alias("target"), F.first("mix.source_size").alias("size")).collect()
    total = sum(r["size"] for r in per)
    assert math.isclose(sum(r.target for r in per), 1.5 * total)
    assert sum(r.taken for r in per) == math.floor(1.5 * total)
    for r in per:
        assert abs(r.taken - r.target) <= 30 and r.taken <= 2 * r["size"]  # the longest document has 30 words
    # By virtual finish time all before the cut are served whole, all after it not at all.
    served = sorted((r.mix.finish, r.mix.taken - r.mix.size, r.mix.taken) for r in out.where("mix.size > 0").select("mix").collect())
    cut = [f for f, lacks, taken in served if lacks]
    assert all(not lacks for f, lacks, _ in served if f < cut[0]) and all(taken == 0 for f, _, taken in served if f > cut[0])
    assert out.select("doc.*").columns == [*docs.columns, "w"]
    assert out.where("mix.taken > mix.size or mix.taken < 0").count() == 0
    finish = [r.f for r in out.select(F.col("mix.finish").alias("f")).collect() if r.f is not None]
    assert finish == sorted(finish)
    again = mixed(spark, rows[::-1], digits=2)[1].select("doc.doc_id", "mix.copy", "mix.taken")
    assert sorted(again.collect()) == sorted(out.select("doc.doc_id", "mix.copy", "mix.taken").collect())


@pytest.mark.parametrize("width", [7, 1 << 22])
def test_mix_does_not_depend_on_partitions(spark, width):
    """Rows without a doc_id, all of one size."""
    rows = [(None, f"a b{i} c", "xy"[i % 3 == 0], "k", i) for i in range(300)] + [(7, f"d{i}", "x", "k", i) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, key string, place int")
    got = []
    for parts in (1, 3, 8):
        light = docs.repartition(parts, "place").withColumn("w", words(F.col("text")))
        out = mix_sources(light, F.col("w"), width=width).select("doc.text", "mix.copy", "mix.taken")
        got.append(sorted(map(tuple, out.collect())))
        digest = light.select("doc_id", "source", text_digest(F.col("text")).alias("digest"), "w")
        kept = taken_documents(docs.repartition(parts), mix_sources(digest, F.col("w"), digest=F.col("digest"), width=width), F.col("mix.taken") > 0)
        assert kept.columns == docs.columns
        assert sorted(r.text for r in kept.collect()) == sorted(text for text, _, taken in got[-1] if taken)
    assert got[0] == got[1] == got[2] and len(got[0]) == 800


def test_ties_are_settled(spark):
    """Rows equal in doc_id and text but not in their source."""
    rows = [(1, "one two three four five", s, i) for i, s in enumerate("dbcae")] + [(None, "x", s, 1) for s in "zy"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    for keep in (keep_one, near_keep_one):
        got = {tuple(sorted((r.text, r.source) for r in keep(docs.repartition(parts, "n")).collect())) for parts in (1, 2, 5)}
        assert got == {(("one two three four five", "a"), ("x", "y"))}


def test_mix_odd_rows(spark):
    _, out = mixed(spark, [(None, None, "a", None, None), (1, "", "a", None, None), (2, "one two", "b", "k", 2), (2, "one two", "b", "k", 2)])
    assert sum(r.t for r in out.select(F.col("mix.taken").alias("t")).collect()) == 6
    assert out.count() == 8
    assert mixed(spark, [])[1].count() == 0
    assert mixed(spark, [(1, None, None, None, None)])[1].agg(F.sum("mix.taken")).head()[0] == 0


# fingerprints


def edited(texts):
    order = sorted(texts, reverse=True)
    out = {}
    for i, k in enumerate(order):
        text, following = texts[k] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        out[k] = text[: len(text) - half] + following[:half]
    return out


@pytest.mark.parametrize("rows_each", [2000, 30])
def test_edited_texts(spark, rows_each):
    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    want = {k: hashlib.sha256(t.encode()).hexdigest() for k, t in edited(rows).items()}
    got = fingerprints(docs, rows_each=rows_each).collect()
    assert {r.doc_id: r.edited_sha256 for r in got} == want
    assert {r.doc_id: r.n_chars for r in got} == {k: len(t) for k, t in rows.items()}


def test_vectors_are_sums(spark):
    texts = {1: "One. Two.\nThree.", 2: "Three. Two.\nOne.", 3: "Two.\nThree.One.", 4: "One. Two.\n", 5: "Three.", 6: None, 7: "", 8: "..." * 50}
    docs = spark.createDataFrame([(i, t, 0, "e") for i, t in texts.items()], "doc_id long, text string, n int, bucket string")
    got = {r.doc_id: r for r in fingerprints(docs).collect()}
    assert got[1].lanes == got[2].lanes != got[3].lanes  # " Two.\n" is not "Two.\n"
    assert len(got[1].lanes) == LONGS
    assert got[6].lanes == got[7].lanes == [0] * LONGS
    assert got[1].n == 3 and got[8].n == 1
    frame = spark.createDataFrame([(got[4].lanes, got[5].lanes, got[1].lanes)], "a array<long>, b array<long>, c array<long>")
    row = frame.select(added(F.col("a"), F.col("b")).alias("ab"), removed(F.col("c"), F.col("b")).alias("cb")).head()
    assert row.ab == got[1].lanes and row.cb == got[4].lanes


def test_order_does_not_matter(spark):
    lines = [f"line {i} of it\n" for i in range(40)]
    docs = spark.createDataFrame([(1, "".join(lines)), (2, "".join(lines[::-1])), (3, "".join(lines[:39]))], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints(docs).collect()}
    assert got[1].lanes == got[2].lanes != got[3].lanes


def test_fingerprint_query(spark):
    rows = QUERIES["op9_multiset_fingerprint"](spark, FOLDER).collect()
    assert len(rows) == 1000
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert all((r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1) for r in rows)
    long = [r for r in rows if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.98 * len(long)


def test_lone_and_equal_ids(spark):
    one = fingerprints(spark.createDataFrame([(7, "ab cd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()
    rows = fingerprints(spark.createDataFrame([(7, "ab"), (7, "ab"), (None, "xy"), (None, None)], "doc_id long, text string"), rows_each=1).collect()
    assert len(rows) == 4
    assert fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_of_one_id_are_dealt(spark):
    rows = [(None if i % 3 else i, f"text {i}. And {i * i}.") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], zlib.crc32(r[1].encode()), r[1]), reverse=True)
    want = []
    for (_, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        want.append(hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in fingerprints(docs, rows_each=20).collect()) == sorted(want)
    named = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), F.crc32(F.col("text").cast("binary")).alias("c"))
    assert max(r["count"] for r in _bucketed(named, 20, 4096).groupBy("bucket").count().collect()) < 60
