import datetime as dt

import pytest
from pyspark.sql import functions as F

from landfall import functions as L


def values(spark, column, *rows):
    frame = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in frame.select(column).collect()]


def test_lenient_bool(spark):
    words = [None, "TRUE", " si ", "SÍ", "y", "1", "t", "2", "", "false", "\tyes "]
    expected = [False, True, True, True, True, True, True, False, False, False, True]
    assert values(spark, L.lenient_bool("x"), *words) == expected
    assert values(spark, L.lenient_bool("x", True), None, "n") == [True, False]
    numbers = spark.sql("SELECT 2 AS i, 0.0D AS d, CAST(0.5 AS DECIMAL(3,1)) AS c, true AS b, CAST(NULL AS INT) AS n")
    row = numbers.select(*(L.lenient_bool(c) for c in numbers.columns)).first()
    assert tuple(row) == (True, False, True, True, False)


def test_clean_name(spark):
    assert values(spark, L.clean_name("x"), "a-b c", "9x", "ñ", "") == ["a_b_c", "_9x", "_", ""]


def test_file_names(spark):
    assert values(spark, L.file_slug("x"), "DIM_A.v1.parquet", "no_ext", ".hidden") == ["dim-a.v1", "no-ext", ""]
    assert values(spark, L.folder_name("x"), "dim-a.parquet") == ["DIM_A"]
    assert values(spark, L.dated_name("x", F.lit(dt.date(2024, 1, 2))), "a.b.csv", "x", "d/e.f/g.csv") == [
        "a.b_2024-01-02.csv", "x_2024-01-02", "g_2024-01-02.csv",
    ]
    assert values(spark, L.export_path("x", F.lit("2024-01-01"), "s3://b/"), "A_b.parquet") == [
        "s3://b/files/A_B/periodo_dia=2024-01-01/A_b.parquet"
    ]


@pytest.mark.parametrize("path", ["a/b.csv", "/b", "b", "a/", "//", "a//b.c", ".bashrc", "..a.b", "a.", "x/.y.z", "", "/a/b.tar.gz"])
def test_path_parts_agree_with_posixpath(spark, path):
    import posixpath

    directory, name = posixpath.split(path)
    stem, extension = posixpath.splitext(name)
    assert tuple(values(spark, L.path_parts("x"), path)[0]) == (directory, name, stem, extension)


def test_uri_parts(spark):
    found = values(spark, L.uri_parts("x"), " gs://b/a/b// ", "gs://b", "gs:/b", None, "s3://b/")
    assert [tuple(r) for r in found] == [
        ("gs", "b", "a/b", True), ("gs", "b", "", True), (None, None, None, False), (None, None, None, False), ("s3", "b", "", True),
    ]
    assert [r["valid"] for r in values(spark, L.uri_parts("x", "gs"), "gs://b", "s3://b")] == [True, False]


def test_repository_parts(spark):
    urls = ["https://github.com/o/r.git", "http://github.com/o/r/", "https://github.com/o/r.x", "https://example.org/o/r"]
    found = [tuple(r) for r in values(spark, L.repository_parts("x"), *urls)]
    assert found == [("o", "r", True), ("o", "r", True), (None, None, False), (None, None, False)]


def test_render_keeps_special_characters_and_unknown_names(spark):
    text = "{{a}} {{ b }} {{  a}} {{c}} {a}"
    expected = r"$1 \n $1 \n {{c}} {a}".replace(r"$1 \n $1 \n", r"$1\n X $1\n")
    assert values(spark, L.render("x", {"a": r"$1\n", "b": "X"}), text) == [expected]
    variables = F.create_map(F.lit("a"), F.lit(r"$1\n"), F.lit("b"), F.lit("X"))
    assert values(spark, L.render("x", variables), text, None) == [expected, None]
    assert values(spark, L.render("x", F.lit(None).cast("map<string,string>")), text) == [text]


def test_render_takes_names_in_order(spark):
    assert values(spark, L.render("x", {"b": "end", "a": "{{b}}"}), "{{a}}") == ["end"]
    assert values(spark, L.render("x", {"a": "end", "b": "{{a}}"}), "{{b}}") == ["{{a}}"]


def test_ddl(spark):
    statements = [
        "CREATE TABLE `p-1.d.t` (a INT64)", "create table p.d.t(a int)", "CREATE TABLE IF NOT EXISTS p.d.t (a INT)",
        "CREATE OR REPLACE TABLE `p`.`d`.`t` (a INT)", "CREATE TABLE d.t (a INT)", "SELECT 1",
    ]
    found = [tuple(r) for r in values(spark, L.ddl_table("x"), *statements)]
    assert found == [("p-1", "d", "t"), ("p", "d", "t"), ("p", "d", "t"), ("p", "d", "t"), (None,) * 3, (None,) * 3]
    assert values(spark, L.ddl_replace("x"), statements[2], statements[0]) == [
        "CREATE OR REPLACE TABLE p.d.t (a INT)", "CREATE OR REPLACE TABLE `p-1.d.t` (a INT64)",
    ]


def test_qualified_name(spark):
    rows = spark.createDataFrame([("t", "d"), ("d.t", None), ("a.b.c", ""), ("t", ""), (None, "d")], "t string, d string")
    found = [tuple(r[0]) for r in rows.select(L.qualified_name("t", "d")).collect()]
    missing = "table or dataset missing"
    assert found == [("d", "t", None), ("d", "t", None), (None, None, "bad table name"), (None, None, missing), (None, None, missing)]


def test_vars_map(spark):
    found = values(spark, L.vars_map("x"), "A|1; B | 2 ;C;|3;D|;A|9|x", "", None, " |v")
    assert found == [{"A": "9", "B": "2"}, {}, None, {"": "v"}]


def test_field_list(spark):
    found = values(spark, L.field_list("x"), "a;serie.b;serie.c", "serie.b", "")
    assert [tuple(r) for r in found] == [(["a"], ["b", "c"]), ([], ["b"]), ([""], [])]


def test_plain_text(spark):
    rows = spark.createDataFrame([(v,) for v in (1.5, 12345678.9, 1e7, -2.5e9, 0.0, None, 0.0001, -1.2e-4, 1.25e-7, 1e15, 1.5e16, 123456789012345680.0)], "x double")
    found = [r[0] for r in rows.select(L.plain_text("x")).collect()]
    assert found == ["1.5", "12345678.9", "10000000.0", "-2500000000.0", "0.0", None, "0.0001", "-0.00012", "0.000000125", "1000000000000000.0", "15000000000000000.0", "123456789012345680.0"]
    odd = spark.createDataFrame([(v,) for v in (1e300, float("nan"), float("inf"), 5e-324)], "x double")
    texts = [r[0] for r in odd.select(L.plain_text("x")).collect()]
    assert texts[:3] == ["1" + "0" * 300 + ".0", "NaN", "Infinity"] and float(texts[3]) == 5e-324


def test_period_date(spark):
    cases = [("15-03-2024", "diaria"), ("15-3-2024", "Mensual"), ("31-02-2024", "diario"), ("2024-03-15", "diaria"), ("15-03-2024", "x"), (None, "diaria")]
    rows = spark.createDataFrame(cases, "d string, p string")
    found = [tuple(r[0]) for r in rows.select(L.period_date("d", "p")).collect()]
    assert found == [
        ("2024-03-15", None), ("2024-03-01", None), (None, "bad date"), (None, "bad date"), (None, "bad periodicity"), (None, "bad date"),
    ]


def test_load_stamp_follows_daylight_saving(spark):
    def stamp(now):
        return spark.range(1).select(L.load_stamp(now)).first()[0]

    assert stamp("2024-07-01 12:00:00") == dt.datetime(2024, 7, 1, 8)
    assert stamp(dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)) == dt.datetime(2024, 1, 1, 9)
    east = dt.timezone(dt.timedelta(hours=2))
    assert stamp(dt.datetime(2024, 1, 1, 14, tzinfo=east)) == dt.datetime(2024, 1, 1, 9)


def test_recent_includes_the_limit(spark):
    rows = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ'2024-01-01 11:50:00', TIMESTAMP_NTZ'2024-01-01 11:49:59', TIMESTAMP_NTZ'2024-01-02 00:00:00')) AS t"
    )
    assert [r[0] for r in rows.select(L.recent("t", "2024-01-01 12:00:00")).collect()] == [True, False, True]


def test_defaults_and_missing(spark):
    rows = spark.sql("SELECT map('a', null) AS m, ' ' AS b, '' AS e, CAST(NULL AS STRING) AS n")
    row = rows.select(
        L.default_if_absent("m", "a", "d"), L.default_if_absent("m", "z", "d"), L.default_if_blank("b", "d"),
        L.default_if_blank("n", "d"), L.missing("e"), L.missing("e", "null"), L.missing("n", "null"),
    ).first()
    assert tuple(row) == (None, "d", "d", "d", True, False, True)


def test_text_date_and_weekday(spark):
    assert values(spark, L.text_date("x"), "2024-03-01T23:30:00.000Z", "no", None) == [dt.date(2024, 3, 1), None, None]
    assert values(spark, L.iso_weekday(F.to_date("x")), "2024-03-03", "2024-03-04") == [7, 1]


def test_periodicity(spark):
    words = ["diario", "DIARIA", "mensual", "esporadica", "Esporádica", "x", None]
    expected = ["daily", "daily", "monthly", "sporadic", "sporadic", None, None]
    assert values(spark, L.periodicity("x"), *words) == expected
    from landfall.functions.dates import normal_period

    assert [normal_period(w) for w in words] == expected
