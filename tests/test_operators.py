import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from landfall import functions as L
from landfall import operators as O


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_natural_order_agrees_with_number_aware_sorting(spark):
    rng = random.Random(7)
    names = ["001_x", "02_y", "10_z", "a", "a1", "a01b", "A2", "a10", "a b", "a-1", "", "9" * 30, "1" + "0" * 30, "x0", "x00y", "x"]
    names += ["".join(rng.choice("ab01 9_B") for _ in range(rng.randint(0, 8))) for _ in range(300)]
    names = sorted(set(names))

    def key(text):
        return [int(t) if t.isdigit() else t.lower() for t in re.split(r"(\d+)", text)]

    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(4)
    ordered = [r["name"] for r in O.natural_order(frame, "name").collect()]
    assert ordered == sorted(names, key=lambda n: (key(n), n))


def test_newest_takes_smallest_name_on_ties(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES ('g', 'b', TIMESTAMP'2024-01-02'), ('g', 'a', TIMESTAMP'2024-01-02'), ('g', '0', TIMESTAMP'2024-01-01'),
        ('h', 'z', TIMESTAMP'1960-01-01'), (NULL, 'n', TIMESTAMP'2024-01-01'), ('h', 'a', NULL) AS t(k, path, modified)"""
    )
    found = O.newest(rows, ["k"], "path", "modified")
    assert set(map(tuple, found.collect())) == {("g", "a"), ("h", "z"), (None, "n")}
    assert O.newest_path(rows) == "a"
    with pytest.raises(FileNotFoundError):
        O.newest_path(rows.where("false"))


def test_purge_keeps_nulls_and_complements(spark):
    rows = spark.sql("SELECT id, IF(id % 3 = 0, NULL, DATE'2024-01-01' + INT(id % 2)) AS d FROM range(30)")
    kept, removed = O.purge(rows, "d", "2024-01-01"), O.purged(rows, "d", "2024-01-01")
    assert kept.where("d IS NULL").count() == 10
    assert sorted(r["id"] for r in kept.unionByName(removed).collect()) == list(range(30))
    assert kept.where("d = '2024-01-01'").isEmpty()


def test_close_runs(spark):
    log = spark.sql(
        """SELECT * FROM VALUES
        ('p', 'z', 'd', 't', TIMESTAMP_NTZ'2024-01-01', CAST(NULL AS TIMESTAMP_NTZ), CAST(NULL AS BIGINT)),
        ('p', 'z', 'd', 't', TIMESTAMP_NTZ'2024-01-02', NULL, NULL),
        ('p', 'z', 'd', 't', TIMESTAMP_NTZ'2024-01-02', TIMESTAMP_NTZ'2024-01-05', 9),
        ('p', 'z', 'd', 't', TIMESTAMP_NTZ'2024-01-03', TIMESTAMP_NTZ'2024-01-04', 1),
        ('p', 'z', 'd', 'closed', TIMESTAMP_NTZ'2024-01-03', TIMESTAMP_NTZ'2024-01-04', 1),
        ('p', 'z', 'd', 'other', TIMESTAMP_NTZ'2024-01-03', NULL, NULL)
        AS l(process_name, zone_name, dataset_name, table_name, start_process, end_process, qantity_of_records)"""
    )
    counts = spark.sql("SELECT 'p' AS process_name, 'z' AS zone_name, 'd' AS dataset_name, explode(array('t', 'closed')) AS table_name, 5L AS row_count")
    stamp = dt.datetime(2024, 2, 1, 9)
    closed = O.close_runs(log, counts, L.load_stamp("2024-02-01 12:00:00"))
    assert closed.columns == log.columns and closed.count() == log.count()
    changed = closed.where(F.col("end_process") == F.lit(str(stamp)).cast("timestamp_ntz")).collect()
    assert [(r["table_name"], r["start_process"], r["qantity_of_records"]) for r in changed] == [("t", dt.datetime(2024, 1, 2), 5)]
    assert closed.where("end_process IS NULL").count() == 2
    # The oldest open run is next; a run that is closed never changes.
    again = O.close_runs(closed, counts, L.load_stamp("2024-02-02 12:00:00"))
    assert again.exceptAll(closed).count() == 1 and again.where("end_process IS NULL").count() == 1
    assert "Window" not in plan(closed)
    # Counting a table twice must not double its runs.
    assert O.close_runs(log, counts.unionByName(counts), F.lit(str(stamp))).count() == log.count()


def test_stamp_nulls(spark):
    rows = spark.sql("SELECT 1 AS a, CAST(NULL AS TIMESTAMP_NTZ) AS s UNION ALL SELECT 2, TIMESTAMP_NTZ'2020-01-01'")
    stamped = O.stamp_nulls(rows, "s", L.load_stamp("2024-07-01 12:00:00")).orderBy("a").collect()
    assert [r["s"] for r in stamped] == [dt.datetime(2024, 7, 1, 8), dt.datetime(2020, 1, 1)]


def test_route_required_modes(spark):
    rows = spark.sql("SELECT 1 AS id, '' AS a, 'x' AS b UNION ALL SELECT 2, NULL, '' UNION ALL SELECT 3, 'x', 'x'")
    kept, skipped = O.route_required(rows, ["a", "b"])
    assert [r["id"] for r in kept.collect()] == [3]
    assert sorted((r["id"], r["reason"]) for r in skipped.collect()) == [(1, "missing: a"), (2, "missing: a, b")]
    kept, skipped = O.route_required(rows, ["a", "b"], "null")
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]
    assert [(r["id"], r["reason"]) for r in skipped.collect()] == [(2, "missing: a")]


def test_pick_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="y, z"):
        O.pick(spark.range(1), ["id", "y", "z"])


def test_period_values(spark):
    rows = spark.sql("SELECT DATE'2024-01-01' + INT(id % 3) AS periodo_dia FROM range(10)")
    assert tuple(O.period_values(rows, "periodo_dia").first()) == ("2024-01-01", 3)
    assert tuple(O.period_values(rows.where("false"), "periodo_dia").first()) == (None, 0)


def test_struct_type_and_violations(spark):
    schema = O.struct_type([
        {"name": "a", "type": "int64", "mode": "REQUIRED"},
        {"name": "b", "type": "STRING", "mode": "REPEATED"},
        {"name": "c", "type": "NUMERIC", "mode": "NULLABLE"},
    ])
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("a", "bigint", False), ("b", "array<string>", True), ("c", "decimal(38,9)", True),
    ]
    rows = spark.sql("SELECT id AS a, 1 AS c FROM range(2) UNION ALL SELECT NULL, 2")
    fitted = O.apply_schema(rows, schema)
    assert fitted.columns == ["a", "b", "c"]
    assert [r["null_columns"] for r in O.required_violations(fitted, schema).collect()] == [["a"]]
    with pytest.raises(Exception, match="null in required column 'a'"):
        O.enforce_required(fitted, schema).collect()
    with pytest.raises(ValueError, match="RECORD"):
        O.struct_type([{"name": "a", "type": "RECORD", "mode": "NULLABLE"}])
    with pytest.raises(ValueError, match="mode"):
        O.struct_type([{"name": "a", "type": "DATE", "mode": "x"}])


@pytest.mark.parametrize("text, error", [
    ('{"name": 1}', "not a list"), ("[1]", "not a record"), ('[{"name": "a", "mode": "x"}]', "type"),
])
def test_check_document(text, error):
    with pytest.raises(ValueError, match=error):
        O.check_document(text)


def test_due_schedules_reasons(spark):
    requests = spark.sql(
        """SELECT * FROM VALUES ('p', DATE'2024-01-01'), ('p', DATE'2024-01-02'), ('p', DATE'2024-01-06'), ('q', DATE'2024-01-01'), ('p', DATE'2030-01-01')
        AS t(process_name, run_date)"""
    )
    schedules = spark.sql(
        """SELECT 'p' AS process_name, array(1) AS dias_semana, true AS active, array(map('a', 'x ${fecha_param}', 'n', CAST(NULL AS STRING))) AS json_config_raw
        UNION ALL SELECT 'q', array(1), false, array(map('a', 'y'))""".replace("${", "$").replace("$fecha_param}", "@")
    ).withColumn("json_config_raw", F.transform("json_config_raw", lambda m: F.transform_values(m, lambda _, v: F.replace(v, F.lit("@"), F.lit("${fecha_param}")))))
    calendar = spark.sql("SELECT 0 AS position, explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) AS day, 'S' AS flag")
    rows = {(r["process_name"], r["run_date"]): r for r in O.due_schedules(requests, schedules, calendar).collect()}
    monday = rows["p", dt.date(2024, 1, 1)]
    assert monday["due"] and monday["config"] == {"a": "x 2024-01-01", "n": None}
    assert rows["p", dt.date(2024, 1, 2)]["reason"] == "weekday not scheduled"
    assert rows["p", dt.date(2024, 1, 6)]["reason"] == "not a business day"
    assert rows["q", dt.date(2024, 1, 1)]["reason"] == "no active schedule"
    assert rows["p", dt.date(2030, 1, 1)]["reason"] == "not a business day"


def test_business_day_without_broadcast(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-10')) AS day")
    calendar = days.where("day < '2024-01-08'").select(F.lit(0).alias("position"), "day", F.when(F.dayofmonth("day") < 6, "S").otherwise("N").alias("flag"))
    expected = O.with_business_day(days, "day", calendar).orderBy("day").collect()
    assert O.with_business_day(days, "day", calendar.hint("merge")).orderBy("day").collect() == expected
    assert [r["is_business_day"] for r in expected] == [True] * 5 + [False] * 5


def test_expected_folders_are_matched_before_the_shuffle(spark):
    """No exchange of files by folder but behind the join with the expected ones."""
    expected = spark.createDataFrame([("r/a",)], "path string")
    files = spark.createDataFrame([(f"r/a/{i}.parquet",) for i in range(50)], "path string").repartition(4)
    plan = O.expected_files(expected, files)._jdf.queryExecution().optimizedPlan().toString()
    generate = plan.index("Generate explode")
    assert "Join Inner" in plan[:generate] and plan[:generate].rindex("Join Inner") > plan[:generate].rindex("LeftOuter")


def test_expected_files(spark):
    expected = spark.createDataFrame([("r/a/",), ("r/b",), ("r",)], "path string")
    files = spark.createDataFrame([("r/a/x/1.parquet",), ("r/a2/2.parquet",)], "path string")
    rows = sorted((r["path"], r["file_path"]) for r in O.expected_files(expected, files).where("file_path IS NOT NULL").collect())
    assert rows == [("r", "r/a/x/1.parquet"), ("r", "r/a2/2.parquet"), ("r/a/", "r/a/x/1.parquet")]
    assert {r["path"]: r["files"] for r in O.expected_counts(expected, files).collect()} == {"r/a/": 1, "r/b": 0, "r": 2}


def test_date_equality_is_pushed_down(tables):
    text = plan(tables.orders.where(L.on_date("o_orderdate", "1998-08-03")).select("o_orderkey"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "o_totalprice" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_row_count_reads_no_column(tables):
    assert "ReadSchema: struct<>" in plan(O.row_count(tables.lineitem))


def test_no_query_uses_python_workers(spark):
    from conftest import SMALL

    from landfall.queries import QUERIES
    from landfall.queries import columns, rows

    for module in (columns, rows):
        for name in (n for n, f in vars(module).items() if n in QUERIES and callable(f) and f.__module__ == module.__name__):
            text = plan(QUERIES[name](spark, SMALL))
            assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name
