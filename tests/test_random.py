"""Operators against plain Python on random input."""

import csv
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from landfall import functions as L
from landfall import operators as O
from landfall import sources as S


@pytest.mark.parametrize("seed", range(3))
def test_csv(spark, tmp_path, seed):
    rng = random.Random(seed)
    pieces = ['"', '""', ",", "\n", "a", "é", " ", "b\n\nc", ";", "'", "\\"]
    rows = [
        (i, *("x" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) + "y" for _ in range(2)))
        for i in range(300)
    ]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["id", "a", "b"])
    writer.writerows(rows)
    (tmp_path / "a.csv").write_text(out.getvalue())
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for split in (rng.randint(20, 400), 1 << 27):
            spark.conf.set(key, split)
            frame = S.read_csv(spark, str(tmp_path / "a.csv"))
            assert sorted(map(tuple, frame.collect())) == rows
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("seed", range(4))
def test_csv_as_the_plain_parser(spark, tmp_path, seed):
    """Quotes within unquoted fields, blank lines and control characters."""
    rng = random.Random(seed)
    pieces = ["a", "5\"", " ", "\x01", "\x05", "é", "'", "\t"]
    field = lambda: "x" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))
    quoted = lambda: '"' + field().replace('"', '""') + rng.choice(["", "\n", "\n\n", ',"",']) + '"'
    lines = [f"{i},{rng.choice((field, quoted))()},{rng.choice((field, quoted))()}" + "\n" * rng.randint(1, 3) for i in range(200)]
    (tmp_path / "a.csv").write_text("\n" * rng.randint(0, 2) + "id,a,b\n" + "".join(lines))
    plain = spark.read.options(header="true", quote='"', escape='"', multiLine="true", inferSchema="true").csv(str(tmp_path / "a.csv"))
    assert sorted(map(tuple, S.read_csv(spark, str(tmp_path / "a.csv")).collect())) == sorted(map(tuple, plain.collect()))
    assert plain.count() == 200


def test_vars_map(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab|; |;") for _ in range(rng.randint(0, 20))) for _ in range(400)]

    def model(text):
        result = {}
        for item in text.split(";"):
            key, value, *_ = [*item.split("|"), "", ""]
            if key and value:
                result[key.strip()] = value.strip()
        return result

    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in frame.select(L.vars_map("x")).collect()] == [model(t) for t in texts]


def test_render(spark):
    rng = random.Random(2)
    variables = {"a": "1$0", "bb": "\\2", "c": ""}
    texts = ["".join(rng.choice(["{{", "}}", " ", "a", "bb", "c", "{", "$", "\\"]) for _ in range(12)) for _ in range(400)]
    texts += [f"{{{{{' ' * i}{name}{' ' * j}}}}}" for name in (*variables, "d") for i in range(3) for j in range(3)]

    def model(text):
        for name, value in sorted(variables.items()):
            text = re.sub(r"\{\{\s*" + re.escape(name) + r"\s*\}\}", lambda _: value, text)
        return text

    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    column = F.create_map(*(F.lit(x) for pair in variables.items() for x in pair))
    for variant in (variables, column):
        assert [r[0] for r in frame.select(L.render("x", variant)).collect()] == [model(t) for t in texts]


def test_newest_and_close_runs(spark):
    rng = random.Random(3)
    rows = [(rng.choice("kkkkmno"), f"f{i:03}", rng.randint(0, 40), rng.random() < 0.5) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, name string, t int, open boolean").withColumn(
        "ts", F.timestamp_seconds("t")
    )
    newest = {}
    for k, name, t, _ in rows:
        newest[k] = min(newest.get(k, (1, "")), (-t, name))
    found = {r["k"]: r["name"] for r in O.newest(frame, ["k"], "name", "ts").collect()}
    assert found == {k: name for k, (_, name) in newest.items()}

    log = frame.withColumn("end", F.when(~F.col("open"), F.col("ts"))).withColumn("n", F.lit(-1).cast("bigint"))
    counts = spark.createDataFrame([("k", 7), ("m", 8)], "k string, row_count bigint")
    stamp = F.timestamp_seconds(F.lit(1000))
    closed = O.close_runs(log, counts, stamp, ["k"], start="ts", end="end", count="n").where(F.col("end") == stamp)
    last = {k: max((t for g, _, t, o in rows if g == k and o), default=None) for k in "km"}
    expected = {name for k, name, t, o in rows if o and k in last and t == last[k]}
    assert {r["name"] for r in closed.collect()} == expected
    assert {(r["k"], r["n"]) for r in closed.collect()} == {("k", 7), ("m", 8)}


def test_purge(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "2024-01-01 00:00:00", "2024-01-01 23:59:59.999999", "2024-01-02 00:00:00"])) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, t string")
    for kind in ("timestamp", "timestamp_ntz", "date"):
        kept = O.purge(frame.withColumn("d", F.col("t").cast(kind)), "d", "2024-01-01")
        assert sorted(r["id"] for r in kept.collect()) == [i for i, t in rows if not (t or "").startswith("2024-01-01")]


def test_expected_files(spark):
    rng = random.Random(5)
    files = ["/".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) + f"/{i}.parquet" for i in range(200)]
    folders = sorted({f.rsplit("/", 1)[0] for f in files} | {"z", "a/z"})
    frame = O.expected_counts(
        spark.createDataFrame([(f + "/",) for f in folders], "path string"),
        spark.createDataFrame([(f,) for f in files], "path string"),
    )
    found = {r["path"][:-1]: r["files"] for r in frame.collect()}
    assert found == {folder: sum(f.startswith(folder + "/") for f in files) for folder in folders}
