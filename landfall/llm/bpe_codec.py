"""Byte-level BPE by tiktoken with a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A blank after a visible ASCII character always begins a new match: no alternative of the pattern goes on from a visible character to a
#: blank, and none looks back. So a text may be cut there.
_SAFE = regex.compile(r"(?<=[!-~])[ \n]")
_LONG_BLANK = 10_000
_encodings: dict[tuple[bytes, str], tiktoken.Encoding] = {}


class Codec:
    """Encodes and decodes texts by a vocabulary, given as the content of a rank file."""

    def __init__(self, content: bytes, pattern: str):
        if (content, pattern) not in _encodings:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
            _encodings[content, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encoding = _encodings[content, pattern]
        self.pattern = regex.compile(pattern)
        self.blanks = regex.compile(rf"\s{{{_LONG_BLANK}}}")

    def encode(self, text: str, chunk: int = 1 << 16) -> list[int]:
        """The ids of a text; long texts go in chunks of about ``chunk`` characters that end at safe places."""
        ids: list[int] = []
        begin = 0
        while begin < len(text):
            cut = _SAFE.search(text, begin + chunk) if len(text) - begin > chunk else None
            end = cut.start() if cut else len(text)
            ids += self._chunk(text[begin:end])
            begin = end
        return ids

    def _chunk(self, text: str) -> list[int]:
        if len(text) >= _LONG_BLANK and self.blanks.search(text):  # the library's own matcher overflows its stack on very long blanks
            return [i for m in self.pattern.finditer(text) for i in self.encoding._encode_single_piece(m.group())]
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


def _run(content, pattern: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value, pattern)
        for batch in batches:
            docs, texts = batch.column("doc"), batch.column("text")
            begin, ids, raw, held = 0, [], [], 0
            for i in range(len(batch)):
                ids.append(codec.encode(texts[i].as_py()))
                raw.append(codec.decode(ids[-1]))
                held += len(raw[-1])
                if held >= size or i == len(batch) - 1:
                    yield pa.RecordBatch.from_arrays([docs.slice(begin, i + 1 - begin), pa.array(ids, pa.list_(pa.int32())), pa.array(raw, pa.binary())], ["doc", "ids", "decoded"])
                    begin, ids, raw, held = i + 1, [], [], 0

    return run


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", size: int = 4 << 20) -> DataFrame:
    """Encode each whole text and decode the ids again.

    Returns ``doc`` (all columns of the document), ``ids`` and ``decoded`` (bytes). ``vocabulary`` is the path of a rank file on the driver,
    which is a few MB at most and sent along. Special tokens are ordinary text. Null texts count as empty and have no ids. Rows are
    independent, so repeated rows and ties need nothing special; an empty table gives no rows.
    """
    with open(vocabulary, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_run(content, pattern, size), f"doc {kind}, ids array<int>, decoded binary")
