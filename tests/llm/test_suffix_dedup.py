"""Suffix dedup against a count of all strings."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm.queries import QUERIES
from landfall.llm.suffix_dedup import PrefixHashes, remove_repeats, shared_strings, suffix_order


def brute(texts, length):
    counts = Counter(b[i : i + length] for t in texts for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = []
    for t in texts:
        b = (t or "").encode()
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                mask[i : i + length] = True
        edge = np.diff(np.concatenate([[0], mask.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        out.append((len(b), spans, bytes(np.frombuffer(b, np.uint8)[~mask])))
    return out


def found(frame):
    return [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in frame.collect()]


def corpus(seed, n=60):
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdé ", k=pick.randint(1, 6))) for _ in range(80)]
    passage = " ".join(pick.choices(words, k=30))
    texts = [" ".join(pick.choices(words, k=pick.randint(0, 60))) for _ in range(n)]
    texts += [texts[3], texts[3], texts[4][:40] + "X" + texts[4][41:], None, "", "a" * 300, "a" * 170 + "b", "ab" * 100, passage * 3]
    return texts + [texts[i][:20] + passage[: 60 + i] + texts[i][20:] for i in range(0, n, 2)]


@pytest.mark.parametrize(("seed", "length", "width", "limit"), [(1, 40, 25, 2000), (2, 30, 20, 3), (3, 25, 1, 2000), (4, 60, 41, 1)])
def test_brute_force(spark, seed, length, width, limit):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, k string").repartition(4)
    result = sorted(found(remove_repeats(docs, length, width, limit)))
    assert result == [(i, *row) for i, row in enumerate(brute(texts, length))]


@pytest.mark.parametrize(("limit", "bits"), [(2000, 1), (2, 3), (1, 8)])
def test_misled_hashes_of_segments_and_strings(spark, limit, bits):
    """Names of a few bits are shared by many different segments and strings; the bytes decide in spite of them."""
    texts = corpus(6)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    docs = docs.unionByName(docs.where("doc_id = 3"))
    want = [(i, *row) for i, row in enumerate(brute([*texts, texts[3]], 30))]
    want[-1] = (3, *want[-1][1:])
    assert sorted(found(remove_repeats(docs, 30, 20, limit, hash_bits=bits))) == sorted(want)


def test_repeated_rows_and_null_ids(spark):
    text = "the same words in each of these rows, " * 2
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (1, "other"), (None, None)], "doc_id long, text string")
    result = found(remove_repeats(docs, 30, 10))
    assert sorted(len(r[3]) for r in result) == [0, 0, 0, 0, 5]
    assert sum(r[0] is None for r in result) == 2


def test_empty_table(spark):
    assert found(remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 30, 10)) == []


def test_suffix_order():
    pick = random.Random(5)
    segs = [bytes(pick.choices(b"ab", k=pick.randint(1, 12))) for _ in range(200)]
    group = np.array([pick.randint(0, 3) for _ in segs])
    data = np.frombuffer(b"".join(segs), np.uint8)
    size = np.array([len(s) for s in segs])
    order = suffix_order(PrefixHashes(data), data, group, np.cumsum(size) - size, size)
    assert [(group[i], segs[i]) for i in order] == sorted(zip(group, segs))


def test_collisions_are_verified(monkeypatch):
    """With hashes that say everything is equal, the bytes still decide."""
    segs = [b"xxABCDEFGHIJ", b"yyABCDEFGHIJ", b"xxABCDEFGHIK"]
    right = shared_strings([1, 1, 1], segs, [2, 2, 2], 10)
    monkeypatch.setattr(PrefixHashes, "of", lambda self, begin, end: np.zeros(len(begin), np.uint64))
    assert (shared_strings([1, 1, 1], segs, [2, 2, 2], 10) == right).all()
    assert right.tolist() == [[True, True, True], [True, False, False], [False, True, True]]


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    want = {i: (n, n - len(kept), len(spans)) for i, (n, spans, kept) in zip(texts, brute(texts.values(), 200))}
    rows = QUERIES["op1_suffix_dedup"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in rows} == want
    assert any(r.n_removed for r in rows)


def test_many_repeated_rows(spark):
    text = "the same words in each of these rows, and a little more of them. " * 3
    docs = spark.createDataFrame([(1, text)] * 3000 + [(2, text[10:] + "x" * 50)], "doc_id long, text string").repartition(4)
    rows = remove_repeats(docs, 60, 21).selectExpr("doc_id", "length(kept) AS n", "size(spans) AS s").distinct().collect()
    assert sorted((r.doc_id, r.n, r.s) for r in rows) == [(1, 0, 1), (2, 50, 1)]
