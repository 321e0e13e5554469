"""Scalar functions and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as L
from .. import operators as O
from .registry import query


@query(r"""
SELECT o_orderkey,
       coalesce(lower(trim(CASE o_orderpriority WHEN '1-URGENT' THEN ' TRUE ' WHEN '2-HIGH' THEN 'Sí'
                WHEN '3-MEDIUM' THEN 'no' WHEN '4-NOT SPECIFIED' THEN '1' END)) IN ('true', 'sí', '1'), true) AS from_text,
       (o_custkey - 7) <> 0 AS from_number,
       o_totalprice > 100000 AS from_bool
FROM orders""")
def lenient_bool(t):
    word = (
        F.when(F.col("o_orderpriority") == "1-URGENT", " TRUE ")
        .when(F.col("o_orderpriority") == "2-HIGH", "Sí")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "no")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "1")
    )
    return t.orders.select(
        "o_orderkey",
        L.lenient_bool(word, default=True).alias("from_text"),
        L.lenient_bool(F.col("o_custkey") - 7).alias("from_number"),
        L.lenient_bool(F.col("o_totalprice") > 100000).alias("from_bool"),
    )


@query(r"""
SELECT page_id,
       '_' || replace(replace(replace(replace(replace(replace(replace(replace(replace(page_id || ' ' || url,
           ' ', '_'), ':', '_'), '/', '_'), '.', '_'), '-', '_'), '?', '_'), '=', '_'), '&', '_'), '#', '_') AS name,
       regexp_replace(url, '[^A-Za-z0-9_]', '_', 'g') AS plain
FROM pages""")
def clean_name(t):
    return t.pages.select(
        "page_id",
        L.clean_name(F.concat_ws(" ", "page_id", "url")).alias("name"),
        L.clean_name("url").alias("plain"),
    )


@query(r"""
WITH s AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%d-%m-%Y') END AS d,
         o_orderstatus = 'P' AS bad, o_orderdate,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'day' WHEN '5-LOW' THEN 'day' WHEN '2-HIGH' THEN 'month' END AS p
  FROM orders)
SELECT o_orderkey,
       CASE WHEN bad THEN NULL WHEN p IS NOT NULL THEN strftime(date_trunc(p, o_orderdate), '%Y-%m-%d') END AS value,
       CASE WHEN bad THEN 'bad date' WHEN p IS NULL THEN 'bad periodicity' END AS reason
FROM s""")
def period_date(t):
    pattern = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "dd-MM-yyyy")
    )
    word = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "diaria")
        .when(F.col("o_orderpriority") == "5-LOW", " Diario ")
        .when(F.col("o_orderpriority") == "2-HIGH", "MENSUAL")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "esporádica")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "weekly")
    )
    return t.orders.select("o_orderkey", L.period_date(pattern, word).alias("_p")).select("o_orderkey", "_p.*")


@query(r"""
WITH s AS (SELECT p_partkey, replace(p_name, ' ', '_') || '_' || p_brand || '.v' || p_size || '.Parquet' AS file FROM part)
SELECT p_partkey, replace(lower(left(file, length(file) - 8)), '_', '-') AS slug,
       upper(replace(left(file, length(file) - 8), '-', '_')) AS folder
FROM s""")
def file_name(t):
    file = F.concat(F.translate("p_name", " ", "_"), F.lit("_"), "p_brand", F.lit(".v"), "p_size", F.lit(".Parquet"))
    return t.part.select("p_partkey", L.file_slug(file).alias("slug"), L.folder_name(file).alias("folder"))


@query(r"""
SELECT event_id, '/lake/files/' || upper(event_type) || '_LOG/periodo_dia=' || strftime(ts, '%Y-%m-%d') || '/'
       || event_type || '-log.parquet' AS path
FROM events""")
def export_path(t):
    file = F.concat("event_type", F.lit("-log.parquet"))
    return t.events.select("event_id", L.export_path(file, F.to_date("ts"), "/lake").alias("path"))


@query(r"""
SELECT o_orderkey,
       lower(o_orderpriority) || '.v2_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS dated,
       regexp_replace('t_' || o_orderpriority, '[^A-Za-z0-9_]', '_', 'g') || '_stg_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS staged
FROM orders""")
def dated_name(t):
    file = F.concat(F.lower("o_orderpriority"), F.lit(".v2.csv"))
    return t.orders.select(
        "o_orderkey",
        L.dated_name(file, F.to_date("o_orderdate")).alias("dated"),
        L.staging_name(F.concat(F.lit("t_"), "o_orderpriority"), "o_orderdate").alias("staged"),
    )


@query(r"""
WITH s AS (SELECT page_id, url, list_extract(string_split(url, '/'), -1) AS name FROM pages),
     e AS (SELECT *, CASE WHEN position('.' IN ltrim(name, '.')) > 0
                          THEN '.' || list_extract(string_split(name, '.'), -1) ELSE '' END AS extension FROM s)
SELECT page_id, rtrim(left(url, length(url) - length(name)), '/') AS directory, name,
       left(name, length(name) - length(extension)) AS stem, extension
FROM e""")
def split_path(t):
    return t.pages.select("page_id", L.path_parts("url").alias("_p")).select("page_id", "_p.*")


@query(r"""
WITH s AS (SELECT page_id, CASE WHEN ends_with(url, '#top') THEN replace(url, '://', ':/') ELSE '  ' || url || '//' END AS uri FROM pages),
     p AS (SELECT page_id, trim(uri) AS uri, contains(uri, '://') AS valid FROM s),
     q AS (SELECT *, string_split(uri, '/') AS parts FROM p)
SELECT page_id, valid,
       CASE WHEN valid THEN left(parts[1], length(parts[1]) - 1) END AS scheme,
       CASE WHEN valid THEN parts[3] END AS container,
       CASE WHEN valid THEN rtrim(array_to_string(parts[4:], '/'), '/') END AS prefix
FROM q""")
def split_uri(t):
    uri = F.when(F.col("url").endswith("#top"), F.replace("url", F.lit("://"), F.lit(":/"))).otherwise(
        F.concat(F.lit("  "), "url", F.lit("//"))
    )
    return t.pages.select("page_id", L.uri_parts(uri).alias("_p")).select("page_id", "_p.*")


@query(r"""
WITH s AS (
  SELECT c_custkey, lower(c_mktsegment) AS owner, replace(c_name, '#', '-') AS name,
         CASE WHEN c_acctbal < 0 THEN 'bad' WHEN c_nationkey < 10 THEN 'https' ELSE 'http' END AS kind FROM customer)
SELECT c_custkey, kind <> 'bad' AS valid, CASE WHEN kind <> 'bad' THEN owner END AS owner,
       CASE WHEN kind <> 'bad' THEN name END AS name
FROM s""")
def repository_url(t):
    name = F.translate("c_name", "#", "-")
    url = (
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("ftp://github.com/"), F.lower("c_mktsegment"), F.lit("/"), name))
        .when(F.col("c_nationkey") < 10, F.concat(F.lit(" https://github.com/"), F.lower("c_mktsegment"), F.lit("/"), name, F.lit(".git ")))
        .otherwise(F.concat(F.lit("http://github.com/"), F.lower("c_mktsegment"), F.lit("/"), name, F.lit("/")))
    )
    return t.customer.select("c_custkey", L.repository_parts(url).alias("_p")).select("c_custkey", "_p.*")


@query(r"""
WITH s AS (
  SELECT c_custkey, c_mktsegment, c_nationkey,
         CASE WHEN c_nationkey < 8 THEN 'pair' WHEN c_nationkey < 16 THEN 'dotted' WHEN c_nationkey < 20 THEN 'long' ELSE 'none' END AS kind
  FROM customer)
SELECT c_custkey,
       CASE kind WHEN 'pair' THEN c_mktsegment WHEN 'dotted' THEN 'ds' END AS schema,
       CASE kind WHEN 'pair' THEN 'a.b' WHEN 'dotted' THEN 't' || c_nationkey END AS "table",
       CASE kind WHEN 'long' THEN 'bad table name' WHEN 'none' THEN 'table or dataset missing' END AS error,
       CASE WHEN kind = 'long' THEN 'p/d/t' || c_nationkey END AS three
FROM s""")
def qualified_name(t):
    nation = F.col("c_nationkey")
    table = (
        F.when(nation < 8, F.lit("a.b"))
        .when(nation < 16, F.concat(F.lit("ds.t"), nation))
        .when(nation < 20, F.concat(F.lit("p.d.t"), nation))
    )
    dataset = F.when(nation < 8, F.col("c_mktsegment")).otherwise(F.lit(""))
    three = L.three_part_name(table)
    return t.customer.select(
        "c_custkey",
        L.qualified_name(table, dataset).alias("_q"),
        F.when(three["table"].isNotNull(), F.concat_ws("/", three["catalog"], three["schema"], three["table"])).alias("three"),
    ).select("c_custkey", "_q.*", "three")


def _ddl():
    return F.concat(
        F.when(F.col("p_size") < 15, F.lit("create table  "))
        .when(F.col("p_size") < 30, F.lit("CREATE TABLE IF NOT EXISTS "))
        .when(F.col("p_size") < 40, F.lit("CREATE OR REPLACE TABLE\n"))
        .otherwise(F.lit("CREATE VIEW ")),
        F.lit("`my-lake."), F.lower("p_type"), F.lit(".t_"), F.col("p_partkey"), F.lit("` (a STRING)"),
    )


@query(r"""
SELECT p_partkey, CASE WHEN p_size < 40 THEN 'my-lake' END AS catalog, CASE WHEN p_size < 40 THEN lower(p_type) END AS schema,
       CASE WHEN p_size < 40 THEN 't_' || p_partkey END AS "table"
FROM part""")
def ddl_table(t):
    return t.part.select("p_partkey", L.ddl_table(_ddl()).alias("_d")).select("p_partkey", "_d.*")


@query(r"""
SELECT p_partkey,
       CASE WHEN p_size < 15 THEN 'create table  ' WHEN p_size < 30 THEN 'CREATE OR REPLACE TABLE '
            WHEN p_size < 40 THEN 'CREATE OR REPLACE TABLE' || chr(10) ELSE 'CREATE VIEW ' END
       || '`my-lake.' || lower(p_type) || '.t_' || p_partkey || '` (a STRING)' AS statement
FROM part""")
def ddl_replace(t):
    return t.part.select("p_partkey", L.ddl_replace(_ddl()).alias("statement"))


@query(r"""
WITH s AS (
  SELECT c_custkey, c_name, c_mktsegment || ' $1 \x' AS segment,
         CASE WHEN c_acctbal >= 0 THEN cast(c_nationkey AS VARCHAR) END AS nation FROM customer),
     v AS (SELECT *, CASE WHEN nation IS NULL THEN '{{ nation}}' ELSE nation END AS n FROM s)
SELECT c_custkey,
       'Dear ' || c_name || ', ' || segment || ' in ' || n || ' by {{other}} on 2024-03-01' AS letter,
       'Dear {{ name }}, retail in ' || '{{ nation}}' || ' by {{other}} on 2024-03-01' AS fixed
FROM v""")
def render_template(t):
    template = F.lit("Dear {{ name }}, {{segment}} in {{ nation}} by {{other}} on ${fecha_param}")
    dated = L.fill_date(template, "2024-03-01")
    variables = F.create_map(
        F.lit("name"), F.col("c_name"),
        F.lit("segment"), F.concat("c_mktsegment", F.lit(r" $1 \x")),
        F.lit("nation"), F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")),
    )
    return t.customer.select(
        "c_custkey", L.render(dated, variables).alias("letter"), L.render(dated, {"segment": "retail"}).alias("fixed")
    )


@query(r"""
SELECT o_orderkey, 'STATUS' AS key, 'last' AS value FROM orders
UNION ALL SELECT o_orderkey, 'KEY', cast(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT o_orderkey, 'PRIORITY', o_orderpriority FROM orders""")
def vars_to_map(t):
    text = F.concat(
        F.lit("STATUS|"), "o_orderstatus", F.lit("; KEY | "), F.col("o_orderkey"), F.lit(" ;BAD;|x;y|;;PRIORITY|"),
        "o_orderpriority", F.lit("|rest;STATUS|last|ignored"),
    )
    return t.orders.select("o_orderkey", F.explode(L.vars_map(text)))


@query(r"""
SELECT event_id, 'flat' AS kind, 'user_' || user_id AS name FROM events
UNION ALL SELECT event_id, 'flat', '' FROM events
UNION ALL SELECT event_id, 'flat', ' serie.x' FROM events
UNION ALL SELECT event_id, 'nested', event_type FROM events
UNION ALL SELECT event_id, 'nested', 'a.b' FROM events""")
def field_list(t):
    text = F.concat(F.lit("user_"), "user_id", F.lit(";serie."), "event_type", F.lit(";; serie.x;serie.a.serie.b"))
    lists = t.events.select("event_id", L.field_list(text).alias("_f"))
    kinds = F.array(
        F.struct(F.lit("flat").alias("kind"), F.col("_f.flat").alias("names")),
        F.struct(F.lit("nested").alias("kind"), F.col("_f.nested").alias("names")),
    )
    return (
        lists.select("event_id", F.explode(kinds).alias("_k"))
        .select("event_id", "_k.kind", F.explode("_k.names").alias("name"))
    )


@query(r"""
SELECT event_id, cast(isodow(ts) AS INTEGER) AS weekday, strftime(ts, '%d-%m-%Y') AS day_text,
       cast(timezone('America/Santiago', timezone('UTC', ts)) AS TIMESTAMP) AS stamp,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS from_text
FROM events""")
def dates_and_stamps(t):
    text = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    )
    return t.events.select(
        "event_id",
        L.iso_weekday("ts").cast("int").alias("weekday"),
        L.day_text("ts", "dd-MM-yyyy").alias("day_text"),
        L.load_stamp(F.col("ts")).alias("stamp"),
        L.text_date(text).cast("string").alias("from_text"),
    )


@query(r"""
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10 MINUTE""")
def recent_rows(t):
    return t.events.where(L.recent("ts", "2024-01-30 12:00:00"))


@query(r"""
SELECT o_orderkey, o_orderstatus, list_contains(['1-URGENT', '2-HIGH'], o_orderpriority) AS urgent
FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def in_list(t):
    urgent = F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))
    return t.orders.where(L.any_of("o_orderstatus", ["F", "P"])).select(
        "o_orderkey", "o_orderstatus", L.any_of("o_orderpriority", urgent).alias("urgent")
    )


@query(r"""
SELECT page_id, starts_with(url, 'https://') AS secure, ends_with(url, '#top') AS top, ends_with(lower(url), '#top') AS top_any,
       contains(url, 'en') AS has_en, contains(list_extract(string_split(url, '/'), -1), '2') AS two_in_name,
       starts_with(url, 'http') AND ends_with(url, '5') AND contains(url, 'example') AS every, true AS no_needle
FROM pages""")
def name_match(t):
    return t.pages.select(
        "page_id",
        L.name_match("url", prefix="https://").alias("secure"),
        L.name_match("url", suffix="#top").alias("top"),
        L.name_match("url", suffix="#TOP", any_case=True).alias("top_any"),
        L.name_match("url", contains="en").alias("has_en"),
        L.name_match("url", contains="2", base_only=True).alias("two_in_name"),
        L.name_match("url", prefix="http", suffix="5", contains="example").alias("every"),
        L.name_match("url").alias("no_needle"),
    )


@query(r"""
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7 AND c_acctbal > 0 ORDER BY c_name, c_custkey LIMIT 1""")
def keyed_filter(t):
    customer = t.customer.withColumn("active", F.col("c_acctbal") > 0)
    found = customer.where(L.all_equal({"c_mktsegment": "BUILDING", "c_nationkey": 7}, active="active"))
    return O.first_row(found, "c_name", "c_custkey").drop("active")


@query(r"""
WITH s AS (SELECT doc_id, nullif(lang, 'es') AS lang, CASE WHEN source = 'src7' THEN '' ELSE source END AS source,
                  CASE WHEN n_chars > 500 THEN n_chars END AS n_chars FROM documents)
SELECT 'falsy' AS mode, doc_id,
       CASE WHEN lang IS NULL OR source = '' OR n_chars IS NULL THEN 'missing: ' || array_to_string(list_filter([
            CASE WHEN lang IS NULL THEN 'lang' END, CASE WHEN source = '' THEN 'source' END,
            CASE WHEN n_chars IS NULL THEN 'n_chars' END], lambda x: x IS NOT NULL), ', ') END AS reason FROM s
UNION ALL
SELECT 'null', doc_id, CASE WHEN lang IS NULL OR n_chars IS NULL THEN 'missing: ' || array_to_string(list_filter([
            CASE WHEN lang IS NULL THEN 'lang' END,
            CASE WHEN n_chars IS NULL THEN 'n_chars' END], lambda x: x IS NOT NULL), ', ') END FROM s""")
def route_required(t):
    documents = t.documents.select(
        "doc_id",
        F.nullif("lang", F.lit("es")).alias("lang"),
        F.when(F.col("source") == "src7", "").otherwise(F.col("source")).alias("source"),
        F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("n_chars"),
    )
    frames = []
    for mode in ("falsy", "null"):
        for frame in O.route_required(documents, ["lang", "source", "n_chars"], mode):
            reason = F.col("reason") if "reason" in frame.columns else F.lit(None).cast("string").alias("reason")
            frames.append(frame.select(F.lit(mode).alias("mode"), "doc_id", reason))
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


@query(r"""
SELECT event_id, CASE event_type WHEN 'click' THEN isodow(ts) IN (1, 2, 3) WHEN 'view' THEN isodow(ts) IN (6, 7)
       ELSE false END AS member
FROM events""")
def array_member(t):
    days = F.when(F.col("event_type") == "click", F.array(*map(F.lit, (1, 2, 3)))).when(
        F.col("event_type") == "view", F.array(*map(F.lit, (6, 7)))
    )
    return t.events.select("event_id", L.in_array(days, L.iso_weekday("ts")).alias("member"))


@query(r"""
SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, cast(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       cast(o_totalprice AS VARCHAR) AS o_totalprice, o_orderdate, o_orderpriority,
       cast(o_orderkey * 100000.5::DOUBLE AS VARCHAR) AS big, cast(o_totalprice > 100000 AS VARCHAR) AS flag
FROM orders""")
def string_projection(t):
    orders = t.orders.withColumn("big", F.col("o_orderkey") * F.lit(100000.5)).withColumn(
        "flag", F.col("o_totalprice") > 100000
    )
    return O.string_projection(orders)


@query(r"""
SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN 'thanks' ELSE 'sorry ' || event_type END AS text,
       CASE WHEN event_type = 'view' THEN 'none' ELSE event_type END AS filled,
       CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 'absent' ELSE event_type END AS keyed
FROM events""")
def status_text_and_defaults(t):
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "Ok").otherwise(kind)
    blanked = F.when(kind == "view", "  ").otherwise(kind)
    entry = F.when(kind == "click", F.create_map(F.lit("other"), kind)).otherwise(
        F.create_map(F.lit("kind"), F.when(kind != "view", kind))
    )
    return t.events.select(
        "user_id",
        "event_id",
        L.by_status(status, F.lit("thanks"), F.concat(F.lit("sorry "), kind)).alias("text"),
        L.default_if_blank(blanked, "none").alias("filled"),
        L.default_if_absent(entry, "kind", "absent").alias("keyed"),
    )


@query("""
SELECT o_orderkey, rtrim(printf('%.7f', o_orderkey / 1e7), '0') || CASE WHEN o_orderkey % 10000000 = 0 THEN '0' ELSE '' END AS small,
       cast(o_orderkey AS VARCHAR) || '0000000000000000.0' AS large, cast(o_orderkey AS VARCHAR) || '000000000000000.0' AS middle,
       rtrim(printf('%.3f', o_orderkey / 1e3), '0') || CASE WHEN o_orderkey % 1000 = 0 THEN '0' ELSE '' END AS thousandth
FROM (SELECT o_orderkey + 1 AS o_orderkey FROM orders)""")
def double_texts(t):
    orders = t.orders.select((F.col("o_orderkey") + 1).alias("o_orderkey"))
    key = F.col("o_orderkey").cast("double")
    numbers = {"small": key / 1e7, "large": key * 1e16, "middle": key * 1e15, "thousandth": key / 1e3}
    return orders.select("o_orderkey", *(L.plain_text(v).alias(k) for k, v in numbers.items()))
