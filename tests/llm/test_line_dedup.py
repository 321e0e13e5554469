"""Line dedup against a single pass with a dictionary."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from landfall.llm import line_dedup
from landfall.llm.line_dedup import chunk_ends, lines_of, places_of, remove_repeated_lines
from landfall.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def opens(line, s):
    """Whether chunking s cuts before the line, and not after it; in plain numbers."""
    x = xxhash.xxh64_intdigest(line)
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 % 2**64
    return (x ^ x >> 32) >> 20 + s & 1


def runs(lines, options):
    """Borders of all chunks of several lines: of the coarse chunking, and of each fine one by its cuts."""
    *coarse, fine = options
    hashes = np.array([xxhash.xxh64_intdigest(line) for line in lines], np.uint64)
    chunkings = [chunk_ends(hashes, *coarse)]
    for s in range(fine):
        marks = [opens(line, s) for line in lines]
        chunkings.append([g for g in range(1, len(lines)) if marks[g] or not marks[g - 1]] + [len(lines)])
    return sorted({(a, b) for ends in chunkings for a, b in zip([0, *ends], ends) if b - a > 1})


def plain(texts, options):
    """texts by doc_id; what is left, in order of doc_id."""
    seen, out = set(), {}
    for i in sorted(texts):
        text = texts[i] or ""
        whole = re.findall(r"[^\n]*\n|[^\n]+", text)
        lines = [x.removesuffix("\n").encode() for x in whole]
        gone = set()
        for a, b in runs(lines, options):
            chunk = tuple(lines[a:b])
            if chunk in seen:
                gone.update(range(a, b))
            seen.add(chunk)
        out[i] = (len(lines), len(gone), "".join(x for n, x in enumerate(whole) if n not in gone))
    return out


@pytest.mark.parametrize("options", [(4, 2, 256, 8), (2, 1, 3, 1), (3, 4, 5, 0), (5, 2, 9, 32)])
def test_brute_force(spark, options):
    pick = random.Random(9)
    lines = [f"line {i}\n" for i in range(30)] + ["\n", "é\n"]
    passage = [f"shared {i}\n" for i in range(25)]
    texts = {i: "".join(pick.choices(lines, k=pick.randint(0, 12)) + passage * (i % 2) + pick.choices(lines, k=3)) + "x" * (i % 3) for i in range(60)}
    texts |= {100: None, 101: "", 102: "\n" * 2000, 103: "same\n" * 700}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, k int").repartition(3)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in remove_repeated_lines(docs, *options).collect()}
    assert got == plain(texts, options)


def test_chunks_hold_all_and_are_bounded():
    lines = np.array([i % 7 for i in range(3000)], np.uint64)
    for options in ((4, 2, 256), (1, 1, 2), (1000, 3, 10)):
        ends = chunk_ends(lines, *options)
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert ends[-1] == len(lines) and max(sizes) <= options[2] and all(s >= 2 for s in sizes[:-1])


def test_cuts_move_along():
    pick = random.Random(2)
    passage = [b"%d" % pick.getrandbits(40) for _ in range(60)]
    options = (4, 2, 256, 8)
    a = {h: size for _, size, h in places_of(passage, options)}
    b = {h: size for _, size, h in places_of([b"new", b"lines", b"ahead", *passage, b"behind"], options)}
    assert len(a.keys() & b.keys()) >= len(a) - 2
    assert {h for h, size in a.items() if size == 2} <= b.keys()


def test_lines():
    assert [lines_of(x) for x in ("", "\n", "a", "a\n", "a\n\n", "\na")] == [[], [b""], [b"a"], [b"a"], [b"a", b""], [b"", b"a"]]


@pytest.mark.parametrize("at_end", [False, True])
def test_short_passages(spark, at_end):
    # 300 passages of 3 to 8 lines, each twice, the second time between lines of its own or, without a newline, at the end of its text.
    pick = random.Random(5)
    line = lambda: " ".join("%x" % pick.getrandbits(40) for _ in range(20)) + "\n"
    passages = [[line() for _ in range(3 + i % 6)] for i in range(300)]
    some = lambda: [line() for _ in range(pick.randint(1, 4))]
    texts = {i: "".join(some() + passages[i % 300] + some()) for i in range(600)}
    if at_end:
        texts |= {i: "".join(some() + passages[i - 300])[:-1] for i in range(300, 600)}
    rows = {r.doc_id: r for r in remove_repeated_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert not any(rows[i].n_removed for i in range(300))
    for i in texts:
        left, all_lines = rows[i].kept.split("\n"), texts[i].split("\n")
        assert set(all_lines) - set(left) <= {x[:-1] for x in passages[i % 300]}
        assert sum(map(bool, all_lines)) - sum(map(bool, left)) == rows[i].n_removed
    assert sum(r.n_removed for r in rows.values()) >= sum(map(len, passages)) * 0.9
    assert all(rows[i].n_removed for i in range(300, 600) if len(passages[i - 300]) > 4)


def test_collisions_remove_nothing(spark, monkeypatch):
    # One hash for all chunks: bytes tell them apart, so nothing goes, unless all chunks are equal.
    make = line_dedup._places

    def forced(options):
        run, all_same = make(options), b"0" * 16

        def changed(batches):
            for batch in run(batches):
                yield batch.set_column(0, "h", line_dedup.pa.array([all_same] * len(batch), line_dedup.pa.binary()))

        return changed

    monkeypatch.setattr(line_dedup, "_places", forced)
    docs = [(i, "".join(f"line {j}\n" for j in range(20))) for i in range(3)]
    assert [r.n_removed for r in remove_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()] == [0, 0, 0]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a\nb\n"), (1, "a\nb\n"), (None, "a\nb\n")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.kept) for r in remove_repeated_lines(docs).collect()) == [("1", ""), ("1", ""), ("None", "a\nb\n")]
    assert remove_repeated_lines(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = plain(texts, (4, 2, 256, 8))
    rows = QUERIES["op7_line_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in rows} == {i: (a, b, hashlib.sha256(t.encode()).hexdigest()) for i, (a, b, t) in want.items()}
    assert sum(r.n_removed for r in rows) > 0
