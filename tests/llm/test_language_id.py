"""Language identification on held-out documents."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landfall.llm.language_id import PART, PLACES, _kernel, identify, mark, parts, train
from landfall.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, FOLDER).join(truth, "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert 180 < len(held) < 320
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_marks_of_parts_are_those_of_the_whole(monkeypatch):
    text = "Ça va, l'été? 12 für Straße — ja. " * 20
    whole, parts = np.zeros(PLACES), np.zeros(PLACES)
    mark(text, whole)
    monkeypatch.setattr("landfall.llm.language_id._PART", 13)
    mark(text, parts)
    assert (parts >= whole).all() and parts.sum() <= whole.sum() * 1.6


def test_kernel_is_that_of_sets():
    a, b = np.zeros((1, PLACES)), np.zeros((1, PLACES))
    mark("abc", a[0]), mark("abd", b[0])
    # blank, a, ab, blank-a, blank-ab and so on: grams of " abc " and " abd "
    assert 0 < _kernel(a, b)[0, 0] < _kernel(a, a)[0, 0] == pytest.approx(1)


def test_odd_rows(spark, model):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " 12 !? 34", "x"), (None, "the and of the", None), (4, "x" * 2_500_000, None)], "doc_id long, text string, score string")
    rows = {r.doc.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    assert rows[1] == rows[2] == rows[3] == ("und", 0.0)
    assert rows[None][0] == "en"
    assert rows[4][0] in model.langs
    assert identify(docs.limit(0), model).count() == 0
    nothing = train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in identify(docs, nothing).collect()} == {("und", 0.0)}


def test_parts():
    for n, most in ((0, 4), (1, 4), (4, 4), (5, 4), (9, 4), (8, 4), (1001, 10)):
        text = "".join(chr(97 + i % 26) for i in range(n))
        cut = list(parts(text, most))
        assert "".join(cut) == text and all(0 < len(p) <= most for p in cut) and len(cut) == -(-n // most)


def test_predictions_as_plain(spark, model):
    """Kernel values by counting common places, margins by sums, averaged over the parts of each text."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 5 = 0 or n_chars > 9000")
    rows = {r.doc.doc_id: r for r in identify(docs, model).collect()}
    base = [set(np.flatnonzero(row)) for row in model.landmarks]
    assert max(len(r.doc.text) for r in rows.values()) > 2 * PART
    for r in rows.values():
        margins = []
        for part in parts(r.doc.text, PART):
            row = np.zeros(PLACES)
            mark(part, row)
            own = set(np.flatnonzero(row))
            if own:
                kernel = np.array([len(own & b) / np.sqrt(len(own) * len(b)) for b in base])
                margins.append([sum(k * w for k, w in zip(kernel, model.weights[:, j])) + model.bias[j] for j in range(len(model.langs))])
        mean = np.mean(margins, axis=0)
        share = np.exp(4 * mean) / np.exp(4 * mean).sum()
        assert r.lang_pred == model.langs[share.argmax()] and r.score == pytest.approx(share.max(), abs=1e-3)


def test_long_clean_texts_are_known_and_kept(spark):
    """Whole documents of one language joined to 1, 3 and 10 MB."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("quality = 1").orderBy("doc_id").collect()
    long = []
    for lang in ("de", "en", "es", "fr"):
        own = [r.text for r in rows if r.lang == lang]
        for n, size in enumerate((28_000, 200_000, 1_000_000, 3_000_000, 10_000_000)):
            text = "\n".join(own)
            text = (text + "\n") * (size // len(text) + 1)
            long.append((10**9 + len(long), text[:size], lang, "long", size))
    model = train(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    docs = spark.createDataFrame(long, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = identify(docs, model).select("doc.doc_id", "doc.lang", "lang_pred", "score").collect()
    assert len(got) == 20 and all(r.lang == r.lang_pred and r.score > 0.8 for r in got), got
    both = docs.unionByName(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    kept = corpus_pipeline.language_id(spark, both, FOLDER)
    assert kept.where("source = 'long'").count() == 20


def test_a_language_of_equal_rows_is_learned(spark):
    some = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    for key in (1, 2, 3):
        copies = spark.range(20_000).select(F.lit(key).cast("long").alias("doc_id"), F.lit("zzyx qoph wuzz kzy " * 9).alias("text"), F.lit("zz").alias("lang"))
        model = train(some.unionByName(copies))
        assert model.langs == ["de", "en", "es", "fr", "zz"]
        row = identify(spark.createDataFrame([("wuzz zzyx kzy qoph",)], "text string"), model).first()
        assert row.lang_pred == "zz"
