"""Language identification by a string kernel.

The blended-spectrum presence kernel of two texts counts the character n-grams (n from 1 to 3) that occur in both, divided by the geometric
mean of how many occur in each. Nyström landmarks map a text to its kernel values with a few training texts; a ridge regression for each
language against the rest works on those. N-grams are hashed to a fixed number of places, so a part of a text is a row of zeros and ones,
and a batch of parts is scored by matrix products. Presence says less the longer a text is, since a long one has nearly all n-grams; so texts are
scored in parts of bounded length, whose margins are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PLACES = 1 << 14
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_PART = 1 << 20

#: The most code points that are scored at once.
PART = 1 << 13
_letter: list[np.ndarray] = []


def _codes() -> np.ndarray:
    """A number for each code point: 0 if it is no letter."""
    if not _letter:
        table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _letter.append(np.where(table, np.arange(0x110000, dtype=np.uint32) * np.uint32(2654435761) | np.uint32(1), np.uint32(0)))
    return _letter[0]


def mark(text: str, row: np.ndarray) -> None:
    """Set the places of the n-grams of a text, n from 1 to 3; anything between letters counts as one blank."""
    codes = _codes()
    for begin in range(0, len(text), _PART):
        part = text[max(0, begin - 2) : begin + _PART].lower()
        x = codes[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not x.any():
            continue
        padded = np.concatenate([[0], x, [0]]).astype(np.uint32)
        x = padded[np.append(True, (padded[1:] != 0) | (padded[:-1] != 0))]
        sums = np.zeros(len(x), np.uint32)
        for n, factor in enumerate(_FACTORS):
            if len(x) <= n:
                break
            sums = sums[: len(x) - n] + (x[n:] + np.uint32(n)) * np.uint32(factor)
            spread = sums ^ (sums >> np.uint32(15))
            place = (spread * np.uint32(0x2C1B3C6D)) >> np.uint32(18)
            row[place[x[: len(x) - n] != 0] if n == 0 else place] = 1


@dataclass
class Model:
    """Landmarks, one row of marks each; weights and bias by language."""

    langs: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def kernel(self, marks: np.ndarray) -> np.ndarray:
        return _kernel(marks, self.landmarks)

    def margins(self, marks: np.ndarray) -> np.ndarray:
        return self.kernel(marks) @ self.weights + self.bias

    def scores(self, marks: np.ndarray) -> np.ndarray:
        return shares(self.margins(marks))


def shares(margins: np.ndarray) -> np.ndarray:
    """Margins as scores that add up to 1."""
    e = np.exp((margins - margins.max(axis=1, keepdims=True)) * 4)
    return e / e.sum(axis=1, keepdims=True)


def parts(text: str, most: int) -> Iterator[str]:
    """A text in equal parts of at most ``most`` code points; a short one is one part."""
    size = -(-len(text) // max(1, -(-len(text) // most))) or 1
    return (text[begin : begin + size] for begin in range(0, len(text), size))


NOTHING = Model([], np.zeros((1, PLACES), np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32))


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(a.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(b.sum(axis=1), 1))[None, :]
    return (a @ b.T) / norm


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marks of each training text, of its first part and of some of its words, as texts to be told apart may be short."""
    for batch in batches:
        lang, text, place = (batch.column(c) for c in ("lang", "text", "place"))
        for i in range(len(batch)):
            first, words = next(parts(text[i].as_py(), PART), ""), text[i].as_py().split()
            for part, t in enumerate((first, " ".join(words[:3]), " ".join(words[len(words) // 2 :][:8]))):
                row = np.zeros(PLACES, np.uint8)
                mark(t, row)
                if row.any():
                    yield pa.RecordBatch.from_arrays(
                        [lang.slice(i, 1), place.slice(i, 1), pa.array([part], pa.int32()), pa.array([np.packbits(row).tobytes()], pa.binary())], ["lang", "place", "part", "marks"])


def train(docs: DataFrame, per_language: int = 300, landmarks: int = 24, ridge: float = 0.01, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Fit a model to a sample of at most ``per_language`` documents of each language, ``landmarks`` of them landmarks.

    The sample is those with the smallest hash of doc_id and text, so it doesn't depend on order; rows equal in both count once, so copies don't crowd out
    others, and every lang is learned. Only marks come to the driver, 2 KB for each
    of three views of a sampled text. Rows without a text or a lang are passed over. Without any rows there is nothing to learn: a model without languages.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("place"))
    counts = {r["lang"]: r["count"] for r in rows.select("lang", "place").distinct().groupBy("lang").count().collect()}
    if not counts:
        return NOTHING
    # twice the sample by a threshold on the hash, and at least some: then few rows are left to be ordered
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, (2.0 * per_language + 50) / n))])
    near = rows.where(F.shiftrightunsigned("place", 1) < F.element_at(share, F.col("lang")) * float(2**63)).groupBy("lang", "place").agg(F.min("text").alias("text"))
    first = W.partitionBy("lang").orderBy("place")
    sample = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_language).select("lang", "text", "place")
    got = sample.mapInArrow(_marked, "lang string, place long, part int, marks binary").toPandas().sort_values(["lang", "place", "part"])
    if got.empty:
        return NOTHING
    marks = np.unpackbits(np.frombuffer(b"".join(map(bytes, got["marks"])), np.uint8).reshape(len(got), -1), axis=1).astype(np.float32)
    langs = sorted(got["lang"].unique())
    label = np.array([langs.index(x) for x in got["lang"]])
    chosen = np.concatenate([np.flatnonzero((label == i) & (got["part"].to_numpy() == 0))[:landmarks] for i in range(len(langs))])
    base = marks[chosen]
    values, axes = np.linalg.eigh(_kernel(base, base).astype(np.float64))
    root = axes @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ axes.T
    mapped = _kernel(marks, base) @ root
    mean = mapped.mean(axis=0)
    y = np.where(label[:, None] == np.arange(len(langs)), 1.0, -1.0)
    weight = (1 / np.bincount(label, minlength=len(langs)))[label][:, None]  # each language counts the same
    centre = (y * weight).sum(axis=0) / weight.sum()
    x = mapped - mean
    solved = np.linalg.solve(x.T @ (x * weight) + ridge * np.eye(len(base)), x.T @ ((y - centre) * weight))
    return Model(langs, base, (root @ solved).astype(np.float32), (centre - mean @ solved).astype(np.float32))


def _score(model, rows: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = model.value
        marks = np.zeros((rows, PLACES), np.float32)
        for batch in batches:
            docs, texts = batch.column("doc"), batch.column("text")
            sums, counts = np.zeros((len(batch), fitted.bias.shape[0])), np.zeros(len(batch), np.int64)
            held: list[int] = []

            def add() -> None:
                if held:
                    np.add.at(sums, held, fitted.margins(marks[: len(held)]))
                    np.add.at(counts, held, 1)
                    held.clear()

            for i in range(len(batch)):
                for part in parts(texts[i].as_py(), most):
                    row = marks[len(held)]
                    row[:] = 0
                    mark(part, row)
                    if row.any():  # a part without a letter says nothing
                        held.append(i)
                    if len(held) == rows:
                        add()
            add()
            scores = shares(sums / np.maximum(counts, 1)[:, None])
            best = scores.argmax(axis=1)
            letters = (counts > 0) & bool(fitted.langs)
            lang = [fitted.langs[b] if has else "und" for b, has in zip(best, letters)]
            score = np.where(letters, scores[np.arange(len(batch)), best], 0.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([docs, pa.array(lang, pa.string()), pa.array(score)], ["doc", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model, text: str = "text", part: int = PART) -> DataFrame:
    """Predict the language of every whole text.

    Returns ``doc`` (all columns of the document), ``lang_pred`` and ``score`` (from 0 to 1, over all languages 1 together). A text is scored in equal parts
    of at most ``part`` code points, and the mean of their margins decides, so neither the language nor the score depends on the length. Null texts and
    texts without a letter are ``und`` with score 0, as is all if the model knows no language; of equal scores the first language by name wins. Nothing but the text is looked at.
    An empty table gives no rows, repeated rows are predicted alike. The model, well under 10 MB, is sent to the executors.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), 64, part), f"doc {kind}, lang_pred string, score double")
