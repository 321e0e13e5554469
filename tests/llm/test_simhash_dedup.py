"""SimHash near-dedup against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from landfall.llm import simhash_dedup as S
from landfall.llm.components import components
from landfall.llm.queries import QUERIES


def plain_print(text, shingle=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, bits):
    """prints: a fingerprint by name; the smallest reachable name by name."""
    names = sorted(prints)
    values = np.array([prints[n] for n in names], np.uint64)
    label = list(range(len(names)))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(v ^ values) <= bits) for v in values]
    while changed:
        changed = False
        for i, n in enumerate(near):
            low = min(label[j] for j in n)
            if low < label[i]:
                label[i], changed = low, True
    return {n: names[label[i]] for i, n in enumerate(names)}


def test_spark_hashes_alike(spark):
    text = "the Words of É"
    row = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t").alias("h")).head()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("text", ["", "  ", "one", "A b", "a b c d", "a b c d e", "É x É x É x É x É", "w " * 70_000])
def test_simhash(text):
    assert S.simhash(text) == plain_print(text)


def test_anchors_cover():
    """Every value is within 2 bits of its home, and a value one bit off reaches that home."""
    pick = np.random.default_rng(1)
    values = pick.integers(0, 1 << S.BLOCK, 300)
    home, _, _ = S.anchors(values, 1)
    assert (np.bitwise_count(home ^ values) <= 2).all()
    for bit in range(S.BLOCK):
        _, which, reached = S.anchors(values ^ (1 << bit), 1)
        got = {(i, a) for i, a in zip(which.tolist(), reached.tolist())}
        assert all((i, h) in got for i, h in enumerate(home.tolist()))


@pytest.mark.parametrize(("bits", "cell"), [(4, 4096), (4, 20), (2, 5), (0, 4096), (5, 4096)])
def test_all_pairs(spark, bits, cell):
    pick = random.Random(bits)
    centres = [pick.getrandbits(64) for _ in range(25)]
    prints = {}
    for i in range(900):
        x = pick.choice(centres)
        for _ in range(pick.randint(0, 5)):
            x ^= 1 << pick.randrange(64)
        prints[i] = x
    want = plain_classes(prints, bits)
    frame = spark.createDataFrame([(int(np.array(x, np.uint64).view(np.int64)),) for x in set(prints.values())], "fp long")
    links = S.near_links(frame, bits, cell)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert all(1 <= bin((a ^ b) & (1 << 64) - 1).count("1") <= bits for a, b in pairs)
    roots = {r.node: r.root for r in components(links).collect()}
    root = {i: roots.get(int(np.array(x, np.uint64).view(np.int64)), int(np.array(x, np.uint64).view(np.int64))) for i, x in prints.items()}
    least = {}
    for i in sorted(root):
        least.setdefault(root[i], i)
    assert {i: least[root[i]] for i in prints} == want


def test_components(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({roots[i] for i in range(301)}) == 1
    assert len({roots[i] for i in range(1000, 1200)}) == 1
    assert len(set(roots.values())) == 2
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    docs = spark.createDataFrame([(3, "a b c d e", 1, "r"), (2, "a b c d e", 1, "r"), (2, "a b c d e", 1, "r"), (None, None, 2, None), (9, "", 2, None), (None, "zz", 3, "q")], "doc_id long, text string, fp int, root string")
    rows = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(3, 2), (2, 2), (2, 2), (None, 9), (9, 9), (None, None)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "a b c d e"), ("9", ""), ("None", "zz")]
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    want = plain_classes(prints, 4)
    rows = QUERIES["op5_simhash_dedup"](spark, folder).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{x:016x}" for i, x in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == want
