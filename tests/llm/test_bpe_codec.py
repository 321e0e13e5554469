"""The codec against the library on whole texts, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from landfall.llm.bpe_codec import Codec, encode_texts
from landfall.llm.queries import QUERIES, VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return Codec(open(PATH, "rb").read(), public_tokenizers.PATTERN)


def test_chunks_change_nothing(plain, codec):
    pick = random.Random(1)
    for _ in range(300):
        text = "".join(pick.choices(["a", "Z", "é", "7", " ", "  ", "\n", "\t", ".", "'s", "'", " ", "　", "\x1c", "\x85", "漢", "🙂", "́", "don't"], k=pick.randint(0, 80)))
        for chunk in (1, 2, 5, 1 << 16):
            assert codec.encode(text, chunk) == plain.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_long_texts(plain, codec):
    for text in ("a" * 300_000, "word " * 60_000, " " * 30_000 + "x", "　" * 15_000 + " y" + "\n" * 12_000 + "z", "é" * 100_000):
        assert codec.encode(text) == plain.encode_ordinary(text)
    assert codec.decode(codec.encode(" " * 2_000_000 + "x")) == b" " * 2_000_000 + b"x"


def test_each_match_separately(codec):
    text = "It's 12 o'clock,  they'll\n\n come!"
    assert codec.encode(text) == [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in codec.encode(m)]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, "y"), (2, "", None)], "doc_id long, text string, ids string")
    rows = encode_texts(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc.ids or "", len(r.ids), bytes(r.decoded)) for r in rows) == [("", 0, b""), ("x", 2, b"a b"), ("x", 2, b"a b"), ("y", 0, b"")]
    assert encode_texts(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, plain):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op10_bpe_codec"](spark, folder).collect():
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
