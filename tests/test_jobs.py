import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from landfall import plans as P
from landfall import sinks as K
from landfall import sources as S
from landfall.operators import struct_type
from landfall.plans.statements import run_sql
from landfall.session import remove_scratch, scratch_path

NOW = dt.datetime(2024, 7, 1, 12, tzinfo=dt.timezone.utc)
STAMP = dt.datetime(2024, 7, 1, 8)


@pytest.fixture()
def schema(tables):
    return f"spark_catalog.{tables.schema()}"


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def write(path, text, modified=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if modified:
        os.utime(path, (modified, modified))


def test_load_csv_picks_the_newest_and_stamps(spark, schema, tmp_path):
    write(tmp_path / "in" / "sales_1.csv", "id,day\n1,2024-01-01\n", 1_700_000_000)
    write(tmp_path / "in" / "sub" / "sales_3.csv", "id,day\n003,2024-01-03\n", 1_700_000_900)
    write(tmp_path / "in" / "sub" / "sales_2.csv", "id,day\n002,2024-01-02\n", 1_700_000_900)
    write(tmp_path / "in" / "other.csv", "x\n9\n", 1_800_000_000)
    write(tmp_path / "in" / "sales_9.CSV", "x\n9\n", 1_800_000_000)
    params = {"input": f"{tmp_path}/in/sales.csv", "output": f"{schema}.sales", "periodicidad": "Diario"}
    result = P.load_csv(spark, params, NOW)
    assert result["file"].endswith("sub/sales_2.csv") and result["created"]
    assert rows_of(spark.table(params["output"])) == [("2", dt.date(2024, 1, 2), STAMP)]
    # A row without a stamp from elsewhere gets one with the next load.
    spark.sql(f"INSERT INTO {params['output']} VALUES ('x', NULL, NULL)")
    P.load_csv(spark, params, NOW + dt.timedelta(hours=1))
    later = STAMP + dt.timedelta(hours=1)
    rows = spark.table(params["output"]).orderBy("fecha_carga", "id").collect()
    assert [(r["id"], r["fecha_carga"]) for r in rows] == [("2", STAMP), ("2", later), ("x", later)]


def test_load_csv_does_not_pass_over_an_empty_file(spark, schema, tmp_path):
    write(tmp_path / "in" / "a_1.csv", "id\n1\n", 1_700_000_000)
    write(tmp_path / "in" / "a_2.csv", "", 1_700_000_900)
    params = {"input": f"{tmp_path}/in/a.csv", "output": f"{schema}.t", "periodicidad": "mensual"}
    with pytest.raises(Exception, match="a_2.csv"):
        P.load_csv(spark, params, NOW)
    assert not spark.catalog.tableExists(f"{schema}.t")


def rows_scanned(frame):
    """How many rows the scan of a frame gives on, once it has run."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    return sum(plan.collectLeaves().apply(i).metrics().apply("numOutputRows").value() for i in range(plan.collectLeaves().size()))


def test_a_stamped_table_is_not_looked_through(spark, schema, tmp_path):
    # Files whose footers count no nulls are skipped, whatever form of timestamps the session is set to; one file with unstamped rows is read.
    table, params = f"{schema}.zones", {"periodicidad": "esporadica", "campo_fecha": "stamped"}
    for i in range(3):
        write(tmp_path / f"{i}.csv", "id\n" + "".join(f"{i * 100 + j}\n" for j in range(50)))
        P.load_csv(spark, {"input": str(tmp_path / f"{i}.csv"), "output": table, **params}, NOW)
    unstamped = lambda: spark.table(table).where(F.col("stamped").isNull()).select("stamped")
    assert spark.table(table).count() == 150 and spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    assert "IsNull(stamped)" in unstamped()._jdf.queryExecution().executedPlan().toString()
    assert rows_scanned(unstamped()) == 0
    assert rows_scanned(spark.table(table).where(F.to_date("stamped") == "2023-01-01")) == 0
    K.append_rows(spark, spark.createDataFrame([(str(i),) for i in range(7)], "id string").coalesce(1), table)
    assert rows_scanned(unstamped()) == 7
    P.load_csv(spark, {"input": str(tmp_path / "0.csv"), "output": table, **params}, NOW)
    assert spark.table(table).count() == 207 and rows_scanned(unstamped()) == 0


def test_load_csv_adds_the_stamp_to_an_older_table(spark, schema, tmp_path):
    write(tmp_path / "a.csv", "b;a\n1;x\n")
    spark.sql(f"CREATE TABLE {schema}.t (a STRING, c STRING, b STRING) USING parquet")
    spark.sql(f"INSERT INTO {schema}.t VALUES ('old', 'c', '0')")
    params = {"input": f"{tmp_path}/a.csv", "output": f"{schema}.t", "csv_delimiter": ";", "campo_fecha": "cargado"}
    P.load_csv(spark, params, NOW)
    assert rows_of(spark.table(f"{schema}.t").fillna("-")) == [("old", "c", "0", STAMP), ("x", "-", "1", STAMP)]


def test_load_csv_that_fails_leaves_the_table(spark, schema, tmp_path):
    write(tmp_path / "a.csv", "a\n1\n")
    params = {"input": f"{tmp_path}/a.csv", "output": f"{schema}.t", "campo_fecha": ""}
    P.load_csv(spark, params, NOW)
    write(tmp_path / "a.csv", "a\n2\n3,4\n")
    with pytest.raises(Exception, match="too many fields"):
        P.load_csv(spark, params, NOW)
    assert rows_of(spark.table(f"{schema}.t")) == [("1",)]


def test_load_csv_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="input"):
        P.load_csv(spark, {"output": "a.b.c"}, NOW)
    with pytest.raises(ValueError, match="catalog.schema.table"):
        P.load_csv(spark, {"input": "x", "output": "b.c"}, NOW)
    write(tmp_path / "in" / "b.csv", "a\n")
    with pytest.raises(FileNotFoundError):
        P.load_csv(spark, {"input": f"{tmp_path}/in/a.csv", "output": "a.b.c", "periodicidad": "mensual"}, NOW)


def test_load_parquet(spark, schema, tmp_path):
    for name, n in (("d_2024-07-01.parquet", 1), ("d_2024-06-01.parquet", 2)):
        spark.range(n).withColumn("v", F.lit("x")).coalesce(1).write.parquet(str(tmp_path / name))
    params = {"input": f"{tmp_path}/d.parquet", "output": f"{schema}.d", "periodicidad": "diario"}
    P.load_parquet(spark, params, NOW)
    assert spark.table(params["output"]).count() == 1


def test_append_by_name_rejects_unknown_columns(spark, schema):
    K.ensure_table(spark, f"{schema}.t", struct_type([{"name": "a", "type": "INT64", "mode": "REQUIRED"}]))
    with pytest.raises(ValueError, match="zz"):
        K.append_rows(spark, spark.sql("SELECT 1 AS a, 2 AS zz"), f"{schema}.t")
    with pytest.raises(Exception, match="null in required column"):
        K.append_rows(spark, spark.sql("SELECT CAST(NULL AS BIGINT) AS a"), f"{schema}.t")
    assert spark.table(f"{schema}.t").isEmpty()


EVENTS = "SELECT id, TIMESTAMP_NTZ'2024-01-01 23:59:59' + MAKE_DT_INTERVAL(INT(id % 4)) AS ts, id % 2 AS k FROM range(40)"


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("by", [None, "ts", "k", "k+day"])
def test_purge_table(spark, schema, tmp_path, by, external):
    table, frame = f"{schema}.t", spark.sql(EVENTS)
    frame = frame.unionByName(spark.sql("SELECT 100L AS id, CAST(NULL AS TIMESTAMP_NTZ) AS ts, CAST(NULL AS BIGINT) AS k"))
    path = str(tmp_path / "t") if external else None
    place = f"LOCATION '{path}'" if external else ""
    if by in (None, "ts"):
        K.ensure_table(spark, table, frame.schema, by, path)
    elif by == "k":
        spark.sql(f"CREATE TABLE {table} (id BIGINT, ts TIMESTAMP_NTZ, k BIGINT) USING parquet PARTITIONED BY (k) {place}")
    else:
        spark.sql(f"CREATE TABLE {table} (id BIGINT, ts TIMESTAMP_NTZ, k BIGINT, ts_day DATE) USING parquet PARTITIONED BY (k, ts_day) {place}")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('landfall.day_of.ts_day' = 'ts')")
    K.append_rows(spark, frame, table)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    # Date 2 holds ids 1 mod 4; purge twice, then load the date again.
    for _ in range(2):
        K.purge_table(spark, table, "ts", "2024-01-02")
        assert sorted(r["id"] for r in spark.table(table).collect()) == sorted([i for i in range(40) if i % 4 != 1] + [100])
    K.append_rows(spark, frame.where("id % 4 = 1"), table)
    assert sorted(r["id"] for r in spark.table(table).collect()) == sorted([*range(40), 100])
    assert rows_of(K.table_on_date(spark, table, "ts", "2024-01-02").select("id")) == [(i,) for i in range(1, 40, 4)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_purge_empties_a_partition_of_another_column(spark, schema):
    table = f"{schema}.t"
    spark.sql(f"CREATE TABLE {table} (id BIGINT, d DATE, k BIGINT) USING parquet PARTITIONED BY (k)")
    K.append_rows(spark, spark.sql("SELECT id, DATE'2024-01-01' + INT(id % 2) AS d, id AS k FROM range(4)"), table)
    assert K.purge_table(spark, table, "d", "2024-01-01") == {"changed": True, "partitions": 2}
    assert rows_of(spark.table(table).select("id")) == [(1,), (3,)]
    assert K.purge_table(spark, table, "d", "2024-01-01") == {"changed": False}


def test_day_partition_prunes(spark, schema):
    table = f"{schema}.t"
    K.ensure_table(spark, table, spark.sql(EVENTS).schema, "ts")
    K.append_rows(spark, spark.sql(EVENTS), table)
    plan = K.table_on_date(spark, table, "ts", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-02" in filters and "isnull(ts_day" in filters
    assert not K.ensure_table(spark, table, spark.range(1).schema)
    assert rows_of(spark.sql(f"SHOW PARTITIONS {table}")) == [(f"ts_day=2024-01-0{i}",) for i in range(1, 5)]


@pytest.mark.parametrize("by", [None, "ts"])
def test_reload_twice_equals_once(spark, schema, by):
    table, frame = f"{schema}.t", spark.sql(EVENTS)
    K.ensure_table(spark, table, frame.schema, by)
    K.append_rows(spark, frame, table)
    fresh = frame.where("DATE(ts) = '2024-01-03'").withColumn("k", F.lit(9).cast("bigint"))
    P.reload_date(spark, table, fresh, "ts", "2024-01-03")
    once = rows_of(spark.table(table))
    P.reload_date(spark, table, fresh, "ts", "2024-01-03")
    assert rows_of(spark.table(table)) == once and len(once) == 40
    # A date that the table does not hold is simply added.
    other = frame.where("id = 0").withColumn("ts", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    P.reload_date(spark, table, other, "ts", "2025-01-01")
    assert spark.table(table).count() == 41


def test_full_refresh(spark, schema, tmp_path):
    table = f"{schema}.t"
    ddl = f"CREATE TABLE {table} (a INT) USING parquet LOCATION '{tmp_path}/t'"
    K.full_refresh(spark, table, ddl)
    spark.sql(f"INSERT INTO {table} VALUES (1)")
    K.full_refresh(spark, table, ddl.replace("a INT", "a INT, b INT"))
    assert spark.table(table).columns == ["a", "b"] and spark.table(table).isEmpty()


@pytest.mark.parametrize("external", [False, True])
def test_full_refresh_after_a_rewrite(spark, schema, tmp_path, external):
    table = f"{schema}.t"
    ddl = f"CREATE TABLE {table} (a INT, d DATE) USING parquet" + (f" LOCATION '{tmp_path}/t'" if external else "")
    K.full_refresh(spark, table, ddl)
    spark.sql(f"INSERT INTO {table} VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-02')")
    assert K.purge_table(spark, table, "d", "2024-01-01")["changed"]
    assert K.purge_table(spark, table, "d", "2024-01-02")["changed"] and spark.table(table).isEmpty()
    spark.sql(f"INSERT INTO {table} VALUES (3, NULL)")
    K.full_refresh(spark, table)
    assert spark.table(table).isEmpty()
    spark.sql(f"INSERT INTO {table} VALUES (3, NULL)")
    K.full_refresh(spark, table, ddl)
    assert spark.table(table).isEmpty()
    spark.sql(f"INSERT INTO {table} VALUES (4, NULL)")
    assert rows_of(spark.table(table).select("a")) == [(4,)]


def test_archive(spark, tmp_path):
    root, today = str(tmp_path), dt.date(2024, 7, 1)
    one = spark.sql("SELECT 1 AS a, DATE'2024-05-01' AS periodo_mes")
    assert K.archive_rows(one, root, "f.v1.parquet", "Mensual", today) == f"{root}/f.v1_2024-05-01.parquet"
    assert K.archive_rows(one, root, "f.parquet", "esporadica", today) == f"{root}/f_2024-07-01.parquet"
    two = one.unionByName(spark.sql("SELECT 2 AS a, DATE'2024-04-01' AS periodo_mes"))
    with pytest.raises(ValueError, match="2 periods"):
        K.archive_rows(two, root, "g.parquet", "mensual", today)
    assert K.archive_rows(two, root, "g.parquet", "mensual", today, "first").endswith("g_2024-04-01.parquet")
    path = K.archive_rows(two, root, "g.parquet", "mensual", today, "split")
    assert rows_of(spark.read.parquet(path)) == [(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 4, 1))]
    with pytest.raises(ValueError, match="no period column"):
        K.archive_rows(one, root, "f.parquet", "diaria", today)


def test_landing_report(spark, tmp_path):
    now = dt.datetime.now(dt.timezone.utc)
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/full/x")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/empty")
    write(tmp_path / "bad" / "b.parquet", "not parquet")
    write(tmp_path / "zero" / "z.parquet", "")
    spark.range(2).coalesce(1).write.parquet(f"{tmp_path}/a b+c%d")
    write(tmp_path / "old" / "o.parquet", "x", now.timestamp() - 3600)
    write(tmp_path / "full" / "y.txt", "x")
    paths = [(f"{tmp_path}/{name}", "diaria") for name in ("full", "empty/", "bad", "zero", "a b+c%d", "old", "missing")]
    expected = spark.createDataFrame(paths, "path string, periodicidad string")
    report = {os.path.basename(r["path"].rstrip("/")): r for r in P.landing_report(spark, expected, now).collect()}
    assert (report["full"]["exists"], report["full"]["has_records"], report["full"]["row_count"]) == (True, True, 3)
    assert (report["empty"]["exists"], report["empty"]["has_records"], report["empty"]["error"]) == (True, False, None)
    for name in ("bad", "zero"):
        assert report[name]["exists"] and not report[name]["has_records"] and report[name]["error"]
    assert report["a b+c%d"]["row_count"] == 2
    for name in ("old", "missing"):
        assert (report[name]["exists"], report[name]["error"]) == (False, "no recent file")
    with pytest.raises(FileNotFoundError, match="missing"):
        P.landing_report(spark, expected, now, strict=True)
    gone = spark.createDataFrame([(f"{tmp_path}/missing",)], "path string")
    assert not P.landing_report(spark, gone, now).first()["exists"]


def test_scripts(spark, schema, tmp_path):
    folder = tmp_path / "sql" / "proc"
    write(folder / "10_c.sql", f"INSERT INTO {schema}.t SELECT max(a) + 1, '${{fecha_param}}' FROM {schema}.t")
    write(folder / "2_b.sql", f"INSERT INTO {schema}.t VALUES (1, 'a;b'); INSERT INTO {schema}.t VALUES (2, 'x'); -- end")
    write(folder / "001_a.SQL", f"CREATE TABLE {schema}.t (a INT, b STRING) USING parquet;\n")
    write(folder / "3_bad.sql", "SELECT * FROM nowhere")
    write(folder / "4_empty.sql", " \n")
    write(folder / "6_one.sql", f"INSERT INTO {schema}.t VALUES (2, 'y;z')")
    write(folder / "5_unfilled.sql", "SELECT '${other}'")
    write(tmp_path / "sql" / "process2" / "1.sql", "SELECT 1")
    results = P.run_script_folder(spark, f"{tmp_path}/sql", "proc", variables={"fecha_param": "2024-01-01"})
    rows = results.collect()
    assert [(r["file"], r["status"]) for r in rows] == [
        ("001_a.SQL", "done"), ("2_b.sql", "done"), ("3_bad.sql", "error"), ("4_empty.sql", "skipped"),
        ("5_unfilled.sql", "error"), ("6_one.sql", "done"), ("10_c.sql", "done"),
    ]
    assert rows_of(spark.table(f"{schema}.t")) == [(1, "a;b"), (2, "x"), (2, "y;z"), (3, "2024-01-01")]
    assert tuple(P.summary(results).first()) == (7, 4, "partial")
    K.write_results(results, f"{tmp_path}/sql/proc/_logs", P.step_line())
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/sql/proc/_logs/text").collect()]
    assert "[OK] 001_a.SQL" in lines and "[SKIP] 4_empty.sql -> empty file" in lines
    assert spark.read.json(f"{tmp_path}/sql/proc/_logs/json").count() == 7
    dry = P.run_script_folder(spark, f"{tmp_path}/sql", "proc", dry_run=True, variables={"fecha_param": "2024-01-01"})
    assert [r["status"] for r in dry.collect()] == ["dry-run", "dry-run", "error", "skipped", "error", "dry-run", "dry-run"]
    assert {r["reason"] for r in dry.where("status = 'dry-run'").collect()} == {None}
    assert spark.table(f"{schema}.t").count() == 4
    with pytest.raises(Exception):
        P.run_script_folder(spark, f"{tmp_path}/sql", "nobody")


def test_registered_statements(spark, schema):
    ddl = spark.createDataFrame(
        [
            ("p", "hub", f"CREATE TABLE {schema}.h (a STRING, d STRING) USING parquet", True),
            ("p", "link", "CREATE TABLE broken", True),
            ("p", "raw", f"CREATE TABLE {schema}.h (a STRING) USING parquet", True),
        ],
        "process_name string, table_type string, ddl_statement string, is_active boolean",
    )
    run = P.run_definitions(spark, ddl, "p", ["hub", "link"], skip_existing=True)
    assert [(r["table_type"], r["status"]) for r in run.collect()] == [("hub", "CREATED"), ("link", "ERROR")]
    run = P.run_definitions(spark, ddl, "p", ["hub"], skip_existing=True)
    assert [r["status"] for r in run.collect()] == ["SKIPPED"]
    run = P.run_definitions(spark, ddl, "p", ["raw"])
    assert [r["status"] for r in run.collect()] == ["ERROR"]
    with pytest.raises(LookupError):
        P.run_definitions(spark, ddl, "q", ["hub"])
    inserts = spark.createDataFrame(
        [("p", "hub", f"INSERT INTO {schema}.h VALUES ('x', '${{fecha_param}}')", True)],
        "process_name string, table_type string, insert_statement string, is_active boolean",
    )
    P.run_insert(spark, inserts, "p", "hub", "2024-01-05")
    assert rows_of(spark.table(f"{schema}.h")) == [("x", "2024-01-05")]
    with pytest.raises(LookupError):
        P.run_insert(spark, inserts, "p", "link", "2024-01-05")
    with pytest.raises(ValueError):
        P.run_insert(spark, inserts, "p", "hub", "2024-01-05' OR true")


def test_purge_entries(spark, schema):
    short = schema.split(".")[1]
    for name in ("a", "b"):
        spark.sql(f"CREATE TABLE {schema}.{name} (id BIGINT, d DATE) USING parquet")
        spark.sql(f"INSERT INTO {schema}.{name} VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-02'), (3, NULL)")
    ddl = spark.createDataFrame(
        [("p", "raw", f"CREATE TABLE {schema}.b (id BIGINT, d DATE, more INT) USING parquet", True)],
        "process_name string, table_type string, ddl_statement string, is_active boolean",
    )
    entries = [
        {"table_name": f"{short}.a", "fecha_param": " 2024-01-01 ", "fecha_columna": "d", "periodicidad": "diaria"},
        {"table_name": "b", "dataset_name": short, "fecha_param": "", "fecha_columna": "d", "periodicidad": "diaria"},
        {"table_name": "x.y.z", "periodicidad": "diaria"},
        {"periodicidad": "diaria"},
    ]
    result = P.purge_entries(spark, entries, ddl, "p")
    assert [r["status"] for r in result.collect()] == ["OK", "OK", "ERROR", "ERROR"]
    assert rows_of(spark.table(f"{schema}.a").select("id")) == [(2,), (3,)]
    assert spark.table(f"{schema}.b").columns == ["id", "d", "more"] and spark.table(f"{schema}.b").isEmpty()


def test_render_scripts(spark):
    texts = spark.createDataFrame([("a/x.sql", "{{ proyecto }}.{{secret}}"), ("b.json", "plain")], "path string, body string")
    values = spark.createDataFrame([("proyecto", "p$1"), ("secret", "no"), ("periodicidad", None)], "name string, value string")
    rows = rows_of(P.render_scripts(texts, values).select("file", "body", "changed"))
    assert rows == [("b.json", "plain", False), ("x.sql", "p$1.{{secret}}", True)]
    with pytest.raises(ValueError):
        P.render_scripts(texts, values.where("name = 'secret'"))


def test_documents_and_schema(spark, tmp_path):
    write(tmp_path / "landed" / "uf.json", json.dumps({"codigo": "uf", "serie": [{"fecha": "2024-01-02T03:00:00.000Z", "valor": 2.5}]}))
    write(tmp_path / "landed" / "empty.json", json.dumps({"codigo": "x", "serie": []}))
    entries = [
        {"url": "u", "filename": "uf", "vars": "codigo;serie.fecha;serie.valor"},
        {"url": "u", "filename": "empty.parquet", "vars": "codigo;serie.fecha"},
        {"url": "u", "filename": "uf", "vars": "nombre"},
        {"url": "u", "filename": "gone", "vars": "a"},
        {"url": "u", "filename": "x"},
    ]
    results = P.load_documents(spark, entries, f"{tmp_path}/landed", f"{tmp_path}/out")
    assert [r["status"] for r in results] == ["OK", "ERROR", "ERROR", "ERROR", "SKIPPED"]
    assert rows_of(S.read_parquet(spark, f"{tmp_path}/out/uf.parquet")) == [(dt.date(2024, 1, 2), 2.5, "uf")]
    schemas = spark.sql(
        """SELECT 'p' AS process_name, array(named_struct('name', 'a', 'type', 'STRING', 'mode', 'NULLABLE')) AS params
        UNION ALL SELECT 'q', array(named_struct('name', 'a', 'type', CAST(NULL AS STRING), 'mode', 'NULLABLE'))"""
    )
    path = P.publish_schema(spark, schemas, "p", f"{tmp_path}/schemas/p.json")
    text = spark.read.text(path, wholetext=True).first()[0]
    assert [f.simpleString() for f in struct_type(json.loads(text)).fields] == ["a:string"]
    with pytest.raises(LookupError):
        P.publish_schema(spark, schemas, "z", f"{tmp_path}/schemas/z.json")


@pytest.mark.parametrize("lines", [False, True])
def test_each_document_is_judged_by_its_own_fields(spark, tmp_path, lines):
    good = {"codigo": None, "unidad": "x", "serie": [{"fecha": "2024-01-02T03:00:00.000Z", "valor": None}, {"valor": 1}]}
    cases = {
        "good": (good, "OK"), "flat": ({k: v for k, v in good.items() if k != "codigo"}, "codigo"), "array": ({**good, "serie": []}, "serie"),
        "none": ({k: v for k, v in good.items() if k != "serie"}, "serie"), "inner": ({**good, "serie": [{"valor": 1}, {}]}, "fecha"), "null": ({**good, "serie": None}, "serie"),
    }
    for name, (other, _) in cases.items():
        docs = [good, other]
        write(tmp_path / "landed" / f"{name}.json", "\n".join(map(json.dumps, docs)) + "\n" if lines else json.dumps(docs, indent=1))
    entries = [{"url": "u", "filename": name, "vars": "codigo;serie.fecha;serie.valor"} for name in cases]
    for result in P.load_documents(spark, entries, f"{tmp_path}/landed", f"{tmp_path}/out", lines=lines):
        want = cases[result["filename"]][1]
        assert (result["status"] == "OK") == (want == "OK") and (want == "OK" or want in result["error"]), result
    rows = S.read_parquet(spark, f"{tmp_path}/out/good.parquet").select(F.coalesce("valor", F.lit(-1)), F.coalesce("codigo", F.lit("null")), F.col("fecha").isNull())
    assert rows_of(rows) == [(-1, "null", False)] * 2 + [(1, "null", True)] * 2
    one = P.load_documents(spark, [{"url": "u", "filename": "flat", "vars": "unidad"}], f"{tmp_path}/landed", f"{tmp_path}/out", lines=lines)
    assert one[0]["status"] == "OK" and rows_of(S.read_parquet(spark, one[0]["path"])) == [("x",), ("x",)]


def test_documents_are_bounded(spark, tmp_path):
    from landfall.queries.jobs import _MOST_RECORDS, _documents_of

    n = 4 * _MOST_RECORDS
    when = F.to_timestamp(F.lit("2024-01-02 03:00:00"))
    events = spark.range(0, n, 1, 3).select(when.alias("ts"), F.lit("hot").alias("event_type"), F.col("id").cast("double").alias("value"))
    docs = _documents_of(events, "event_type")
    sizes = [r[0] for r in docs.select(F.size("serie")).collect()]
    assert sum(sizes) == n and max(sizes) <= _MOST_RECORDS
    docs.select(F.to_json(F.struct(F.col("event_type").alias("codigo"), "serie")).alias("value")).write.text(f"{tmp_path}/landed/hot.json")
    done = P.load_documents(spark, [{"url": "u", "filename": "hot", "vars": "codigo;serie.valor"}], f"{tmp_path}/landed", f"{tmp_path}/out", lines=True)
    rows = S.read_parquet(spark, done[0]["path"])
    assert (rows.count(), rows.select("valor").distinct().count()) == (n, n)


def test_export_query(spark, tmp_path):
    result = P.export_query(spark, "SELECT 1 AS a", "05-03-2024", "mensual", "DIM_P.parquet", str(tmp_path))
    assert result["output_path"] == f"{tmp_path}/files/DIM_P/periodo_dia=2024-03-01"
    assert result["params_path"] == f"{tmp_path}/jobs-params/dim-p.json"
    written = json.loads(spark.read.text(result["params_path"], wholetext=True).first()[0])
    assert written == {"query": "SELECT 1 AS a", "output_path": result["output_path"]}
    assert spark.read.parquet(result["output_path"]).first()["a"] == 1
    for day, period, reason in (("2024-03-05", "mensual", "bad date"), ("05-03-2024", "anual", "bad periodicity")):
        with pytest.raises(ValueError, match=reason):
            P.period_day(day, period)


def test_open_runs_without_valid_entries(spark, schema):
    entries = spark.createDataFrame([({"dataset_name": "d"},)], "entry map<string,string>")
    assert P.open_process_runs(spark, entries, "p", NOW, f"{schema}.log") == {"status": "WARNING", "opened": 0}


def test_completeness(spark):
    requests = spark.sql(
        """SELECT * FROM VALUES ('p', 'raw', 'a', 'ze', 'zd'), ('p', 'Cleansed', 'a', 'ze', 'zd'), ('p', 'raw', 'b', 'ze', 'zd'), ('p', 'x', 'a', 'ze', 'zd')
        AS t(process_name, arquetipo_type, arquetype_name, zone_email, zone_ddl)"""
    )
    one = "SELECT 'p' AS process_name, "
    result = P.completeness(
        requests, spark.sql(one + "'a' AS arquetype_name"), spark.sql(one + "'ze' AS zone_name"),
        spark.sql(one + "'zd' AS zone_name"), spark.sql(one + "'other' AS table_type"),
    )
    lines = {r[0] for r in result.select(P.completeness_line()).collect()}
    assert "[VALIDATION] proc=p type=raw process_params=1 process_email=1 process_ddl=1 process_insert=0 status: ok" in lines
    found = rows_of(result.select("arquetipo_type", "arquetype_name", "status"))
    assert found == [("cleansed", "a", "fail"), ("raw", "a", "ok"), ("raw", "b", "fail"), ("x", "a", "fail")]


def test_dry_run_checks_each_statement(spark, schema):
    with pytest.raises(Exception, match="nowhere"):
        run_sql(spark, "SELECT 1; SELECT * FROM nowhere;", dry_run=True)
    assert run_sql(spark, "SELECT ';--' AS a; -- ; nothing\nSELECT 2", dry_run=True) is None
    text = f"CREATE TABLE {schema}.made (a INT) USING parquet; INSERT INTO {schema}.made VALUES (1);"
    assert run_sql(spark, text, dry_run=True) == "1 statements use what earlier ones make"
    assert not spark.catalog.tableExists(f"{schema}.made")


@pytest.mark.parametrize("ddl", [
    "CREATE TABLE {s}.t (a INT USING parquet", "CREATE TABLE {s}.other (a INT) USING parquet", "CREATE TABLE {s}.t (a INT) USING nothing",
    "CREATE TABLE {s}.t USING parquet AS SELECT ${{x}}", "SELECT 1",
])
def test_full_refresh_leaves_the_table_if_the_definition_is_bad(spark, schema, ddl):
    spark.sql(f"CREATE TABLE {schema}.t (a INT) USING parquet")
    spark.sql(f"INSERT INTO {schema}.t VALUES (1), (2)")
    with pytest.raises(Exception):
        K.full_refresh(spark, f"{schema}.t", ddl.format(s=schema))
    assert rows_of(spark.table(f"{schema}.t")) == [(1,), (2,)]
    assert not spark.catalog.tableExists(f"{schema}.other")
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema}").collect()] == ["t"]


def test_purge_entries_take_only_their_own_definition(spark, schema):
    short = schema.split(".")[1]
    spark.sql(f"CREATE TABLE {schema}.a (id BIGINT) USING parquet")
    spark.sql(f"INSERT INTO {schema}.a VALUES (1)")
    ddl = spark.createDataFrame(
        [("p", "raw", f"CREATE TABLE {schema}.b (id BIGINT) USING parquet", True)], "process_name string, table_type string, ddl_statement string, is_active boolean")
    row = P.purge_entries(spark, [{"table_name": "a", "dataset_name": short, "periodicidad": "esporadica"}], ddl, "p").first()
    assert row["status"] == "ERROR" and "no definition" in row["error"]
    assert spark.table(f"{schema}.a").count() == 1 and not spark.catalog.tableExists(f"{schema}.b")


def test_rows_without_a_day_are_counted_and_purged(spark, schema):
    table = f"{schema}.t"
    K.ensure_table(spark, table, spark.sql(EVENTS).schema, "ts")
    K.append_rows(spark, spark.sql(EVENTS).withColumnRenamed("ts", "TS"), table)
    assert spark.table(table).where("ts_day IS NULL AND ts IS NOT NULL").isEmpty()
    before = K.table_on_date(spark, table, "ts", "2024-01-02").count()
    spark.sql(f"INSERT INTO {table} (id, ts) VALUES (900, TIMESTAMP_NTZ'2024-01-02 01:00:00'), (901, TIMESTAMP_NTZ'2024-01-03 01:00:00'), (902, NULL)")
    assert K.table_on_date(spark, table, "TS", "2024-01-02").count() == before + 1
    total = spark.table(table).count()
    fresh = spark.sql(EVENTS).where("to_date(ts) = '2024-01-02'").withColumn("id", F.lit(7).cast("bigint"))
    P.reload_date(spark, table, fresh, "ts", "2024-01-02")
    P.reload_date(spark, table, fresh, "ts", "2024-01-02")
    assert spark.table(table).count() == total - 1
    assert K.purge_table(spark, table, "ts", "2024-01-02")["changed"]
    assert not K.purge_table(spark, table, "ts", "2024-01-02")["changed"]
    assert spark.table(table).count() == total - 1 - before
    assert {r["id"] for r in spark.table(table).where("id >= 900").collect()} == {901, 902}


def test_purge_of_a_day_with_a_second_partition_column(spark, schema):
    table = f"{schema}.t"
    spark.sql(f"CREATE TABLE {table} (id BIGINT, d DATE, region STRING) USING parquet PARTITIONED BY (d, region)")
    spark.sql(f"INSERT INTO {table} SELECT id, DATE'2024-01-01' + cast(id % 2 AS INT), concat('r', id % 10) FROM range(40)")
    assert K.purge_table(spark, table, "d", "2024-01-01")["changed"]
    assert spark.table(table).count() == 20 and spark.table(table).where("d = '2024-01-01'").isEmpty()
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 5


def test_rewrite_runs_its_change_once(spark, schema):
    table, seen = f"{schema}.t", spark.sparkContext.accumulator(0)
    spark.sql(f"CREATE TABLE {table} (id BIGINT, p INT) USING parquet PARTITIONED BY (p)")
    spark.sql(f"INSERT INTO {table} SELECT id, cast(id % 3 AS INT) FROM range(30)")

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    K.rewrite(spark, table, F.col("p") < 2, lambda df: df.mapInArrow(count, df.schema))
    assert seen.value == 20 and spark.table(table).count() == 30


def test_old_versions_and_scratch_can_be_removed(spark, schema):
    table = f"{schema}.t"
    spark.sql(f"CREATE TABLE {table} (id BIGINT, d DATE) USING parquet")
    spark.sql(f"INSERT INTO {table} VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-02')")
    done = K.purge_table(spark, table, "d", "2024-01-01")
    assert K.remove_version(spark, table, done["previous"]) and not K.remove_version(spark, table, done["previous"])
    assert spark.table(table).count() == 1
    with pytest.raises(ValueError):
        K.remove_version(spark, table, K.location(spark, table))
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert remove_scratch(spark, path) and not remove_scratch(spark, path)
    with pytest.raises(ValueError):
        remove_scratch(spark, "/tmp/elsewhere")


def test_landing_report_reads_the_pages(spark, tmp_path):
    now = dt.datetime.now(dt.timezone.utc)
    for name in ("good", "bad"):
        spark.range(20000).select("id", F.expr("uuid()").alias("u")).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    for i in range(4):
        spark.range(0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/empty")
    (path,) = (tmp_path / "bad").glob("*.parquet")
    content = bytearray(path.read_bytes())
    content[1000 : len(content) // 2] = bytes(len(content) // 2 - 1000)
    path.write_bytes(content)
    (tmp_path / "bad" / f".{path.name}.crc").unlink()
    expected = spark.createDataFrame([(f"{tmp_path}/{n}",) for n in ("good", "bad", "empty")], "path string")
    rows = {r["file_path"].rsplit("/", 2)[1]: r for r in P.landing_report(spark, expected, now).collect()}
    assert rows["good"]["error"] is None and rows["good"]["row_count"] == 20000
    assert "rows can be read" in rows["bad"]["error"]
    assert rows["empty"]["error"] is None and not rows["empty"]["has_records"]
    assert {r["error"] for r in P.landing_report(spark, expected, now, thorough=False).collect()} == {None}


def test_landing_report_of_files_of_different_types(spark, tmp_path, monkeypatch):
    now = dt.datetime.now(dt.timezone.utc)
    kinds = {"int": "1 AS a", "text": "'x' AS a, 2 AS b", "date": "DATE'2024-01-01' AS a, 3L AS b", "big": "5L AS a, NULL AS c", "other": "7 AS d", "nested": "named_struct('x', 1) AS a"}
    for i in range(2):
        for name, columns in kinds.items():
            spark.sql(f"SELECT {columns.replace('NULL', 'CAST(NULL AS INT)')} FROM range(5000)").coalesce(1).write.parquet(f"{tmp_path}/in/{name}{i}")
    spark.sql("SELECT uuid() AS a FROM range(20000)").coalesce(1).write.parquet(f"{tmp_path}/in/bad")
    (path,) = (tmp_path / "in" / "bad").glob("*.parquet")
    content = bytearray(path.read_bytes())
    content[1000 : len(content) // 2] = bytes(len(content) // 2 - 1000)
    path.write_bytes(content)
    (tmp_path / "in" / "bad" / f".{path.name}.crc").unlink()
    expected = spark.createDataFrame([(f"{tmp_path}/in",)], "path string")
    rows = {r["file_path"].rsplit("/", 2)[1]: r for r in P.landing_report(spark, expected, now).collect()}
    assert len(rows) == 13 and all(r["has_records"] for r in rows.values())
    assert {name for name, r in rows.items() if r["error"]} == {"bad"} and "rows can be read" in rows["bad"]["error"]

    # Four times as many files take no more jobs.
    def jobs(root):
        from landfall.sources import schemas

        calls = []
        whole, merge = schemas._readable, schemas.merged_schema
        with monkeypatch.context() as patch:
            patch.setattr(schemas, "_readable", lambda *a: calls.append(0) or whole(*a))
            patch.setattr(schemas, "merged_schema", lambda *a: calls.append(1) or merge(*a))
            counts = S.parquet_row_counts(spark, root)
            classes = S.schema_classes(lambda: S.recent_parquet(spark), counts, [r["path"] for r in counts.collect()])
        return len(calls), len(classes)

    for i in range(8):
        for name in ("int", "text"):
            where = "few" if i < 2 else "many"
            spark.sql(f"SELECT {kinds[name]}").coalesce(1).write.parquet(f"{tmp_path}/{where}/{name}{i}")
    assert jobs(f"{tmp_path}/few") == jobs(f"{tmp_path}/many") == (4, 2)


def test_one_unreadable_table_does_not_end_the_count(spark, schema, tmp_path):
    short = schema.split(".")[1]
    for name in ("a", "b"):
        spark.sql(f"CREATE TABLE {schema}.{name} (id BIGINT) USING parquet LOCATION '{tmp_path}/{name}'")
        spark.sql(f"INSERT INTO {schema}.{name} VALUES (1)")
    write(tmp_path / "b" / "junk.parquet", "not parquet")
    spark.sql(f"REFRESH TABLE {schema}.b")
    found = P.table_counts(spark, [{"dataset_name": schema, "table_name": n, "periodicidad": "esporadica"} for n in "ab"])
    assert [r["row_count"] for r in found] == [1, None] and found[0]["error"] is None and found[1]["error"]
    del short


def test_raw_tables_are_partitioned_by_a_named_column(spark, schema, tmp_path):
    write(tmp_path / "s.csv", "id,sold\n1,2024-01-02\n2,2024-01-03\n")
    params = {"input": f"{tmp_path}/s.csv", "output": f"{schema}.s", "periodicidad": "esporadica", "campo_particion": "sold"}
    P.load_csv(spark, params, NOW)
    assert K.partition_columns(spark, f"{schema}.s") == ["sold"]
    assert K.purge_table(spark, f"{schema}.s", "sold", "2024-01-02")["changed"] and spark.table(f"{schema}.s").count() == 1


def test_bad_files_among_empty_ones_are_found_by_halves(spark, tmp_path, monkeypatch):
    from landfall.plans import checks

    for i in range(16):
        spark.range(0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/empty")
    good = sorted(map(str, (tmp_path / "empty").glob("*.parquet")))
    write(tmp_path / "junk.parquet", "not a Parquet file, but long enough")
    files = [{"path": p, "length": os.path.getsize(p)} for p in [*good[:9], f"{tmp_path}/junk.parquet", *good[9:]]]
    tried, read = [], checks._read_error
    monkeypatch.setattr(checks, "_read_error", lambda spark, *paths: tried.append(paths) or read(spark, *paths))
    assert [p for p, _ in checks._empty_errors(spark, files)] == [f"{tmp_path}/junk.parquet"]
    assert len(tried) <= 11
    assert checks._empty_errors(spark, [f for f in files if "junk" not in f["path"]]) == []


class Killed(BaseException):
    """The end of a process, which no handler sees."""


def _killed_at(monkeypatch, n, kind):
    """Let the process die before the n-th change of metadata."""
    from landfall.sinks import refresh
    from landfall.sinks import tables as T

    done, whole = [], T.step

    def step(spark, sql):
        done.append(sql)
        if len(done) == n:
            raise kind("killed")
        whole(spark, sql)

    monkeypatch.setattr(T, "step", step)
    monkeypatch.setattr(refresh, "step", step)
    return done


_OLD = [(1, "a"), (2, "b")]
_DEFINITIONS = {
    "plain": ("CREATE TABLE {t} (id INT, v STRING) USING parquet", []),
    "other columns": ("CREATE TABLE IF NOT EXISTS {t} (id INT) USING parquet", []),
    "selected": ("CREATE OR REPLACE TABLE {t} USING parquet AS SELECT 7 AS id, 'x' AS v", [(7, "x")]),
    "located": ("CREATE TABLE {t} USING parquet LOCATION '{place}' AS SELECT 7 AS id, 'x' AS v", [(7, "x")]),
    "elsewhere": ("CREATE TABLE {t} USING parquet LOCATION '{place}-2' AS SELECT 7 AS id, 'x' AS v", [(7, "x")]),
    "partitioned": ("CREATE TABLE {t} USING parquet PARTITIONED BY (v) AS SELECT 7 AS id, 'x' AS v", [(7, "x")]),
}


@pytest.mark.parametrize("by", ["", "PARTITIONED BY (v)"])
@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("kind", sorted(_DEFINITIONS))
def test_full_refresh_swaps(spark, schema, tmp_path, kind, external, by):
    table, place = f"{schema}.t", f"{tmp_path}/t"
    spark.sql(f"CREATE TABLE {table} (id INT, v STRING) USING parquet {by} " + (f"LOCATION '{place}'" if external else ""))
    spark.sql(f"INSERT INTO {table} VALUES (1, 'a'), (2, 'b')")
    ddl, rows = _DEFINITIONS[kind]
    for _ in range(2):
        K.full_refresh(spark, table, ddl.format(t=table, place=place))
        assert rows_of(spark.table(table)) == rows
        K.remove_leftovers(spark, table)
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema}").collect()] == ["t"]
    assert "landfall.replaces" not in K.properties(spark, table)


@pytest.mark.parametrize("kind, by, end", [
    ("plain", "", Killed), ("selected", "PARTITIONED BY (v)", Killed), ("other columns", "", Killed), ("other columns", "PARTITIONED BY (v)", RuntimeError)])
def test_full_refresh_killed_anywhere_leaves_old_or_new(spark, schema, monkeypatch, kind, by, end):
    ddl, rows = _DEFINITIONS[kind]
    n = 0
    while True:
        n += 1
        table = f"{schema}.t{n}"
        spark.sql(f"CREATE TABLE {table} (id INT, v STRING) USING parquet {by}")
        spark.sql(f"INSERT INTO {table} VALUES (1, 'a'), (2, 'b')")
        with monkeypatch.context() as patch:
            done = _killed_at(patch, n, end)
            try:
                K.full_refresh(spark, table, ddl.format(t=table))
            except end:
                pass
        K.settle(spark, table)
        got = rows_of(spark.table(table))
        assert got in (_OLD, rows), n
        K.remove_leftovers(spark, table)
        assert rows_of(spark.table(table)) == got
        K.append_rows(spark, spark.createDataFrame([(9,)], "id int"), table)
        assert spark.table(table).count() == len(got) + 1
        if len(done) < n:
            assert got == rows and n > 1
            break


def test_a_writer_finishes_the_swap(spark, schema, monkeypatch):
    table = f"{schema}.t"
    spark.sql(f"CREATE TABLE {table} (id INT, v STRING) USING parquet PARTITIONED BY (v)")
    spark.sql(f"INSERT INTO {table} VALUES (1, 'a')")
    with monkeypatch.context() as patch:
        _killed_at(patch, 3, Killed)
        with pytest.raises(Killed):
            K.full_refresh(spark, table, rows=spark.createDataFrame([(5, "n")], "id int, v string"))
    assert not spark.catalog.tableExists(table)
    assert not K.ensure_table(spark, table, struct_type([{"name": "id", "type": "INT64", "mode": "NULLABLE"}]))
    assert rows_of(spark.table(table)) == [(5, "n")]


def test_full_refresh_of_probes(spark, schema, tmp_path):
    write(tmp_path / "full" / "x.txt", "x")
    spark.sql(f"CREATE TABLE {schema}.t USING parquet AS SELECT id FROM range(10)")
    spark.sql(f"CREATE VIEW {schema}.seen AS SELECT * FROM {schema}.t")
    for rest in ("AS SELECT * FROM {s}.t WHERE id < 0", "AS SELECT * FROM {s}.seen", "LOCATION '{p}' AS SELECT 1 AS id", "LOCATION '{p}'"):
        columns = "" if " AS " in rest or rest.startswith("AS") else "(id BIGINT) "
        with pytest.raises(Exception):
            K.full_refresh(spark, f"{schema}.t", f"CREATE TABLE {schema}.t {columns}USING parquet " + rest.format(s=schema, p=tmp_path / "full"))
        assert spark.table(f"{schema}.t").count() == 10
    assert (tmp_path / "full" / "x.txt").exists()
    assert sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema}").collect()) == ["seen", "t"]


@pytest.mark.parametrize("by", [None, "ts"])
def test_replaced_rows_may_read_the_table(spark, schema, by):
    table = f"{schema}.t"
    frame = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id int, ts timestamp_ntz")
    K.ensure_table(spark, table, frame.schema, by)
    K.append_rows(spark, frame, table)
    K.replace_rows(spark, spark.table(table).where("id = 2").select("id", "ts"), table)
    P.reload_date(spark, table, spark.table(table).select("id", "ts").unionByName(frame.where("id = 1")), None, None)
    assert rows_of(spark.table(table).select("id")) == [(1,), (2,)]
    assert K.day_columns(spark, table) == ({"ts": "ts_day"} if by else {})


_DAYS = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (0, 9)]


def _by_day(spark, table):
    """Two rows on each of three days, one of them in the partition without a day, and two values of a second column."""
    frame = spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in enumerate(_DAYS)], "id int, ts timestamp_ntz, kind string")
    K.ensure_table(spark, table, frame.schema, "ts")
    K.append_rows(spark, frame, table)
    spark.sql(f"INSERT INTO {table} (id, ts, kind, ts_day) VALUES (6, TIMESTAMP_NTZ'2024-01-02 05:00:00', 'x', NULL), (7, TIMESTAMP_NTZ'2024-01-03 05:00:00', 'y', NULL)")


def _ids(rows):
    return sorted(r["id"] for r in rows.select("id").collect())


_CHANGES = {
    "purge of a date": (lambda spark, t: K.purge_table(spark, t, "ts", "2024-01-02"), [0, 1, 4, 5, 7]),
    "purge that empties some": (lambda spark, t: K.rewrite(spark, t, F.col("id").isin(2, 3, 4), lambda df: df.where(~F.col("id").isin(2, 3, 4))), [0, 1, 5, 6, 7]),
    "reload with other dates": (lambda spark, t: P.reload_date(spark, t, spark.createDataFrame(
        [(12, _DAYS[2], "n"), (10, _DAYS[0], "n"), (19, dt.datetime(2024, 2, 1), "n"), (20, None, "n")], "id int, ts timestamp_ntz, kind string"), "ts", "2024-01-02"), [0, 1, 4, 5, 7, 10, 12, 19, 20]),
    "reload without rows": (lambda spark, t: P.reload_date(spark, t, spark.createDataFrame([], "id int, ts timestamp_ntz, kind string"), "ts", "2024-01-02"), [0, 1, 4, 5, 7]),
    "emptying": (lambda spark, t: K.empty_table(spark, t), []),
}


@pytest.mark.parametrize("kind", sorted(_CHANGES))
def test_changes_of_partitions_killed_anywhere_leave_old_or_new(spark, schema, monkeypatch, kind):
    from landfall.sinks import tables as T

    change, new = _CHANGES[kind]
    fill = T._fill

    def half(spark, table, rows):
        """Some of the partitions are in place when the job dies."""
        one = T._partitions(rows, T.partition_columns(spark, table))[:1]
        if one:
            fill(spark, table, rows.where(T._in_partitions(one)))
        raise Killed("killed")

    n, ended = 0, False
    while not ended:
        table = f"{schema}.t{n}"
        _by_day(spark, table)
        with monkeypatch.context() as patch:
            done = _killed_at(patch, n, Killed) if n else []
            if not n:
                patch.setattr(T, "_fill", half)
            try:
                change(spark, table)
                ended = n > 0
            except Killed:
                pass
        committed = "landfall.intent" in K.properties(spark, table)
        seen = _ids(K.table_rows(spark, table))
        assert seen == (new if committed or ended or n == 0 and kind == "emptying" else list(range(8))), n
        K.append_rows(spark, spark.createDataFrame([(99,)], "id int"), table)
        assert _ids(spark.table(table)) == sorted([*seen, 99])
        K.remove_leftovers(spark, table)
        assert K.properties(spark, table).get("landfall.intent") is None and T.change_folders(spark, table) == []
        assert _ids(spark.table(table)) == sorted([*seen, 99])
        assert ended or n == 0 or len(done) == n
        n += 1
    assert n >= 4


@pytest.mark.parametrize("by", ["kind", "ts_day, kind", "kind, n"])
def test_reload_of_other_partitions(spark, schema, by):
    """A date over several partitions, of which some are left without rows, some get new ones, some have no value."""
    table = f"{schema}.t"
    spark.sql(f"CREATE TABLE {table} (id INT, ts_day DATE, kind STRING, n INT) USING parquet PARTITIONED BY ({by})")
    spark.sql(f"INSERT INTO {table} (id, ts_day, kind, n) VALUES (1, DATE'2024-01-01', 'a', 1), (2, DATE'2024-01-01', 'it''s', 2), (3, DATE'2024-01-02', 'a', NULL), (4, DATE'2024-01-02', NULL, 2), (5, NULL, 'a', 1)")
    fresh = spark.sql("SELECT 6 AS id, DATE'2024-01-02' AS ts_day, 'new' AS kind, 5 AS n UNION ALL SELECT 7, DATE'2024-01-01', 'a', 1")
    P.reload_date(spark, table, fresh, "ts_day", "2024-01-02")
    assert _ids(spark.table(table)) == [1, 2, 5, 6, 7]
    P.reload_date(spark, table, fresh.where("id = 6"), "ts_day", dt.date(2024, 1, 1))
    assert _ids(spark.table(table)) == [5, 6, 6]
    assert _ids(K.table_on_date(spark, table, "ts_day", "2024-01-02")) == [6, 6]


def test_a_frame_is_read_once_by_a_reload(spark, schema):
    table = f"{schema}.t"
    _by_day(spark, table)
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame([(12, _DAYS[2], "n"), (10, _DAYS[0], "n")], "id int, ts timestamp_ntz, kind string")
    P.reload_date(spark, table, frame.mapInArrow(noted, frame.schema), "ts", "2024-01-02")
    assert seen.value == 2 and _ids(spark.table(table)) == [0, 1, 4, 5, 7, 10, 12]


def test_load_takes_a_folder_of_part_files_for_a_landed_file(spark, schema, tmp_path):
    rows = spark.range(100).select("id", F.col("id").cast("string").alias("v")).repartition(4)
    for name, days in (("a/items_1.parquet", 0), ("b/items_2.parquet", 1), ("c/other.parquet", 2), ("c/items_3.csv", 2)):
        part = rows if "2" in name else rows.where("id < 3")
        path = f"{tmp_path}/in.parquet/items/{name}"
        part.write.option("header", True).format(name[-3:] if name.endswith("csv") else "parquet").save(path)
        K.set_modified(spark, path, NOW + dt.timedelta(days=days))
    params = {"input": f"{tmp_path}/in.parquet/items/items.parquet", "output": f"{schema}.items", "periodicidad": "mensual"}
    done = P.load_parquet(spark, params, NOW)
    assert done["file"].endswith("b/items_2.parquet")
    assert sorted(r["id"] for r in spark.table(params["output"]).collect()) == list(range(100))
    # A newer file by itself, also below a folder of such a name, is taken as before.
    write(tmp_path / "in.parquet" / "items" / "a" / "items_0.csv" / "items_9.csv", "id,v\n7,x\n", NOW.timestamp() + 10 * 86400)
    params = {"input": f"{tmp_path}/in.parquet/items/items.csv", "output": f"{schema}.texts", "periodicidad": "mensual"}
    assert P.load_csv(spark, params, NOW)["file"].endswith("items_0.csv/items_9.csv")
    with pytest.raises(FileNotFoundError):
        P.load_parquet(spark, {"input": f"{tmp_path}/in.parquet/items/none.parquet", "output": f"{schema}.none", "periodicidad": "mensual"}, NOW)


def test_newest_landed_files_are_written_by_many_tasks(spark, tmp_path):
    from landfall.queries import QUERIES

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(4000).select(*(F.col("id").alias(c) for c in ("l_orderkey", "l_linenumber"))).repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    try:
        loaded = QUERIES["load_newest_parquet"](spark, str(tmp_path))
        assert loaded.count() == 4000 and len(loaded.inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
