"""Scores against an automaton of dictionaries, walked token by token."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm.lm_scoring import Automaton, Block, pieces_of, score_texts, traverse
from landfall.llm.queries import QUERIES


def words(text):
    return [*(text or "").encode().lower().split(), None]


def plain(rows, order, strength):
    """rows: (text, learn). Tokens, known ones, training tokens, base and score of each."""
    counts = Counter()
    for text, learn in rows:
        if learn:
            t = words(text)
            counts.update(tuple(t[i : i + n]) for n in range(1, order + 1) for i in range(len(t) - n + 1))
    uni = {g: c for g, c in counts.items() if len(g) == 1}
    total, types = sum(uni.values()), len(uni)

    def arc(state, w):
        if not state:
            return (counts[(w,)] + 1) / (total + types + 1)
        return (counts[(*state, w)] + strength * arc(state[1:], w)) / (counts[state] + strength)

    out = []
    for text, _ in rows:
        t, state, score, base = words(text), (), 0.0, 0.0
        for w in t:
            at = state
            while at and not counts[(*at, w)]:
                score += math.log10(strength / (counts[at] + strength))
                at = at[1:]
            score += math.log10(arc(at, w))
            base += math.log10(arc((), w))
            state = (*state, w)[-(order - 1) :] if order > 1 else ()
            while state and not counts[state]:
                state = state[1:]
        out.append((len(t), sum(counts[(w,)] > 0 for w in t), total, base, score))
    return out


def check(got, want):
    assert got[:3] == want[:3]
    assert got[3:] == pytest.approx(want[3:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize(("order", "size"), [(1, 1 << 20), (2, 1 << 20), (2, 300), (3, 500), (3, 60)])
def test_brute_force(spark, order, size):
    pick = random.Random(order)
    vocabulary = ["the", "The", "of", "é", "É", "x", "yy", "z1"]
    rows = [(" ".join(pick.choices(vocabulary, k=pick.randint(0, 15))), i % 3 != 0) for i in range(80)] + [(None, True), ("new words", False), ("the of", None)]
    docs = spark.createDataFrame([(i, t, l, "q") for i, (t, l) in enumerate(rows)], "doc_id long, text string, learn boolean, score string")
    got = score_texts(docs, F.col("learn"), order=order, strength=3.0, block_bytes=size).collect()
    want = plain(rows, order, 3.0)
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    for r in got:
        check((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), want[r.doc_id])


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("most", [1, 2, 7, 1000])
def test_pieces_do_not_matter(order, most):
    # Long texts are walked in pieces; the state at a piece's begin is that of the whole walk.
    pick = random.Random(order)
    rows = [(" ".join(pick.choices("abcdef", k=k)), k % 2 == 0) for k in (0, 1, 2, 3, 50, 51, 400)]
    block = Block([t for t, _ in rows], np.array([x for _, x in rows]), order)
    totals, want = block.counts(), plain(rows, order, 2.0)
    types = len({w for t, x in rows if x for w in words(t)})
    model = Automaton(block, totals, want[0][2], types, 2.0)
    assert block.by_text(traverse(block, model, most)) == pytest.approx([w[4] for w in want], rel=1e-9)
    enter, begin, end = pieces_of(block.sizes, most, order - 1)
    assert sorted(i for a, b in zip(begin, end) for i in range(a, b)) == list(range(block.sizes.sum()))
    assert (end - begin).max() <= most and (begin - enter).max() < order
    # A failure arc leads to a state with one token less, and no unseen context is ever a state.
    states = np.unique(model.goto)
    assert all(model.length[model.fail[s]] == model.length[s] - 1 for s in states if s != model.root)
    assert all(totals[s] > 0 for s in states if s != model.root)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b", True), (1, "a b", True), (1, "a b", True)], "doc_id long, text string, learn boolean")
    assert {(r.n_tokens, r.train_tokens) for r in score_texts(docs, F.col("learn")).collect()} == {(3, 9)}
    assert score_texts(docs.limit(0), F.col("learn")).count() == 0
    assert {r.score for r in score_texts(docs, F.lit(False)).collect()} == {0.0}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    want = dict(zip(docs, plain([(t, not held[i]) for i, t in docs.items()], 2, 200.0)))
    rows = QUERIES["op2_lm_scoring"](spark, folder).collect()
    for r in rows:
        assert r.held_out == held[r.doc_id]
        check((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), want[r.doc_id])
    long = [r for r in rows if r.held_out and r.n_tokens > 50]
    assert sum(r.score for r in long) > sum(r.base_score for r in long)


def test_copies_are_spread_and_read_alike(spark):
    docs = spark.createDataFrame([(1, "a b c", True)] * 500, "doc_id long, text string, learn boolean").repartition(5)
    got = score_texts(docs, F.col("learn"), block_bytes=600).collect()
    assert len(got) == 500 and {(r.n_tokens, r.train_tokens) for r in got} == {(4, 2000)}
    frame = score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), F.lit(True), block_bytes=1 << 18)
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[0].count("FileScan") == 1  # the documents are shuffled once
