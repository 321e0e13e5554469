"""Rows without a doc_id whose texts differ but have one crc32."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from landfall.llm import simhash_dedup
from landfall.llm.common import keyed
from landfall.llm.line_dedup import remove_repeated_lines
from landfall.llm.suffix_dedup import remove_repeats


def twins():
    """Two texts of one checksum: the first repeats a long passage of its own, the second repeats nothing."""
    pick = random.Random(1)
    line = lambda: " ".join("%x" % pick.getrandbits(30) for _ in range(12)) + "\n"
    passage = "".join(line() for _ in range(40))
    a, b = passage + line() + passage, "".join(line() for _ in range(100))
    ends = [hashlib.md5(b"%d" % i).hexdigest() for i in range(400_000)]
    of = {zlib.crc32(end.encode(), zlib.crc32(a.encode())): end for end in ends}
    start = zlib.crc32(b.encode())
    one, other = next((of[c], end) for end in ends if (c := zlib.crc32(end.encode(), start)) in of)
    return a + one, b + other


def test_rows_of_one_checksum_stay_apart(spark):
    a, b = twins()
    assert zlib.crc32(a.encode()) == zlib.crc32(b.encode())
    docs = spark.createDataFrame([(None, a), (None, b)], "doc_id long, text string")
    assert keyed(docs).select("k", "c").distinct().count() == 2
    size = F.octet_length("kept")
    assert {r.n_bytes: r.size for r in remove_repeats(docs).select("n_bytes", size.alias("size")).collect()}[len(b)] == len(b)
    removed = {r.n_lines: r.n_removed for r in remove_repeated_lines(docs).collect()}
    assert removed[101] == 0 and removed[82] > 0
    assert {r.text for r in simhash_dedup.keep_one(docs).collect()} == {a, b}
