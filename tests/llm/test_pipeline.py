"""The pipeline, stage by stage, against plain versions of its decisions."""

import re

import pytest
from compare import oracle_connection
from pyspark.sql import functions as F
from test_bpe_codec import PATH, plain  # noqa: F401
from test_simhash_dedup import plain_classes, plain_print

import __spark_entry__
import corpus_pipeline
from landfall.llm.common import read_documents, staged
from landfall.llm.source_mix import ORACLE

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    out = [read_documents(spark, FOLDER)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], FOLDER), "test"))
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing sources", "BPE encoding"]
    assert all(s.columns == steps[0].columns for s in steps[1:-1])
    assert "pipeline" in __spark_entry__.queries()


def test_language(steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert all(any(c.isalpha() for c in before[i].text) for i in after)
    assert len(after) > 0.97 * len(before)


def test_exact(steps):
    before, after = rows(steps[1]), rows(steps[2])
    best = {}
    for i in sorted(before):
        key = re.sub(r"[\x20\x09-\x0D]", "", before[i].text)
        if key not in best or len(before[i].text) > len(before[best[key]].text):
            best[key] = i
    assert set(after) == set(best.values())


def test_near(steps):
    prints = {i: plain_print(r.text) for i, r in rows(steps[2]).items()}
    classes = plain_classes(prints, 4)
    assert set(rows(steps[3])) == {i for i, least in classes.items() if i == least}


def test_mix(steps):
    con = oracle_connection(FOLDER)
    table = steps[3].toArrow()
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet($p)".replace("$p", "'" + steps[3].inputFiles()[0].rsplit("/", 1)[0] + "/*.parquet'"))
    want = {r[0]: r for r in con.execute(ORACLE).fetchall()}
    copies = {r.doc_id: r["count"] for r in steps[4].groupBy("doc_id").count().collect()}
    assert len(table) == len(want)
    for i, (_, size, _, _, taken) in want.items():
        first, second = min(size, taken), max(0, taken - size)
        assert copies.get(i, 0) == sum(t > 0 and 2 * t >= size for t in (first, second))


def test_tokens(steps, plain):  # noqa: F811
    texts = rows(steps[3])
    got = steps[5].collect()
    assert len(got) == steps[4].count()
    for r in got:
        assert r.decodes and r.ids == plain.encode_ordinary(texts[r.doc_id].text) and r.n_tokens == len(r.ids)


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, FOLDER).groupBy("doc_id", "n_tokens").count().exceptAll(steps[5].groupBy("doc_id", "n_tokens").count()).count() == 0


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, mix string, doc string, k int"
    for data in ([], [(None, None, None, None, None, None, None, None)], [(1, "the and of", "en", "a", 1, "m", "d", 1), (1, "the and of", "en", "a", 1, "m", "d", 1), (2, "", None, None, 0, None, None, None)]):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, FOLDER), "odd")
        assert docs.count() == (len({d[0] for d in data if d[1]}))
        assert docs.where(~F.col("decodes")).count() == 0
