"""Counts, lookups, order, row changes and schema checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import functions as L
from .. import operators as O
from .. import sources as S
from ..plans import completeness as check_completeness
from ..plans import notices
from .registry import query

DAY = "1998-08-03"


@query(f"""
SELECT 'all' AS scope, count(*) AS row_count, count(*) > 0 AS has_records FROM orders
UNION ALL SELECT 'day', count(*), count(*) > 0 FROM orders WHERE o_orderdate::DATE = DATE '{DAY}'
UNION ALL SELECT 'none', count(*), count(*) > 0 FROM orders WHERE o_orderdate::DATE = DATE '2030-01-01'
UNION ALL SELECT 'sporadic', count(*), count(*) > 0 FROM orders""")
def count_on_date(t):
    counts = {
        "all": O.row_count(t.orders),
        "day": O.row_count_on(t.orders, "o_orderdate", DAY),
        "none": O.row_count_on(t.orders, "o_orderdate", "2030-01-01"),
        "sporadic": O.row_count_on(t.orders, "o_orderdate", DAY, sporadic=True),
    }
    return O.concatenate(*(df.withColumn("scope", F.lit(name)) for name, df in counts.items()))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS row_count, true AS has_records FROM events GROUP BY 1")
def daily_counts(t):
    return O.daily_counts(t.events, "ts").withColumn("day", F.col("day").cast("string"))


@query("SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS row_count, true AS has_records FROM lineitem GROUP BY 1")
def daily_load_counts(t):
    return O.daily_counts(t.lineitem, "l_shipdate").withColumn("day", F.col("day").cast("string"))


@query("""
SELECT 'customer' AS source, c_nationkey AS key, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2
UNION ALL SELECT 'nation', n_nationkey, count(*) FROM nation GROUP BY 2""")
def keyed_counts(t):
    return O.keyed_counts(
        {"customer": t.customer, "supplier": t.supplier, "nation": t.nation},
        {"customer": "c_nationkey", "supplier": "s_nationkey", "nation": "n_nationkey"},
    )


@query("SELECT event_id, user_id FROM events WHERE value < 20")
def open_rows(t):
    log = t.events.withColumn("end", F.when(F.col("value") >= 20, F.col("ts")))
    return log.where(L.is_open("end")).select("event_id", "user_id")


@query("""
SELECT user_id, event_type, max(CASE WHEN value < 20 THEN ts END) AS latest_start
FROM events GROUP BY user_id, event_type""")
def latest_open_start(t):
    log = t.events.withColumn("end", F.when(F.col("value") >= 20, F.col("ts")))
    return O.latest_start(log, ["user_id", "event_type"], "ts", "end")


@query("""
SELECT user_id, arg_min(event_id, (-epoch_us(ts), event_id)) AS event_id FROM events GROUP BY user_id""")
def latest_per_group(t):
    return O.newest(t.events, ["user_id"], "event_id", "ts")


@query("""
SELECT o_custkey, first(o_orderkey ORDER BY o_orderdate DESC, o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey""")
def latest_with_ties(t):
    return O.newest(t.orders, ["o_custkey"], "o_orderkey", "o_orderdate")


@query("""
SELECT o_orderstatus, strftime(min(o_orderdate), '%Y-%m-%d') AS period, count(DISTINCT o_orderdate::DATE) AS periods
FROM orders GROUP BY o_orderstatus""")
def single_period(t):
    return O.period_values(t.orders, "o_orderdate", ["o_orderstatus"])


@query("""
SELECT user_id, count(*) AS processed, count(*) FILTER (WHERE event_type <> 'error') AS succeeded,
       CASE WHEN bool_or(event_type = 'error') THEN 'partial' ELSE 'ok' END AS status
FROM events GROUP BY user_id""")
def outcome_rollup(t):
    failed = F.col("event_type") == "error"
    return O.outcome(t.events, failed, ~failed, ["user_id"])


@query("""
WITH need AS (SELECT DISTINCT lang, 'src' || n AS source FROM documents, (VALUES (1), (2), (10)) v(n))
SELECT lang, bool_and(EXISTS (SELECT 1 FROM documents d WHERE d.lang = need.lang AND d.source = need.source AND d.n_chars > 400)) AS ok
FROM need GROUP BY lang""")
def all_required(t):
    long = t.documents.where(F.col("n_chars") > 400)
    counts = long.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    needed = t.documents.select("lang").distinct().select(
        "lang", F.explode(F.array(*map(F.lit, ("src1", "src2", "src10")))).alias("source")
    )
    return O.all_required(counts, needed, ["lang"])


@query("""
WITH r AS (SELECT DISTINCT user_id AS p, 'raw' AS k FROM events UNION ALL SELECT DISTINCT user_id, 'cleansed' FROM events),
     c AS (SELECT p, k,
       (SELECT count(*) FROM events e WHERE e.user_id = p AND e.event_type = 'click') AS process_params,
       (SELECT count(*) FROM events e WHERE e.user_id = p AND e.event_type = 'view' AND e.value < 50) AS process_email,
       (SELECT count(*) FROM events e WHERE e.user_id = p AND e.event_type = 'signup' AND e.value < 5) AS process_ddl,
       (SELECT count(*) FROM events e WHERE e.user_id = p AND e.event_type IN ('error', 'purchase') AND e.value < 2) AS process_insert
     FROM r)
SELECT cast(p AS VARCHAR) AS process_name, k AS arquetipo_type, process_params, process_email, process_ddl, process_insert,
       CASE WHEN process_params > 0 AND process_email > 0 AND process_ddl > 0 AND (k = 'raw' OR process_insert > 0)
            THEN 'ok' ELSE 'fail' END AS status
FROM c""")
def completeness(t):
    events = t.events.withColumn("process_name", F.col("user_id").cast("string"))
    zone = F.when(F.col("event_type") == "view", F.when(F.col("value") < 50, "low").otherwise("high")).otherwise(
        F.when(F.col("value") < 5, "low").otherwise("high")
    )
    requests = events.select("process_name").distinct().select(
        "process_name",
        F.explode(F.array(F.lit("RAW"), F.lit("cleansed"))).alias("arquetipo_type"),
        F.lit("a").alias("arquetype_name"),
        F.lit("low").alias("zone_email"),
        F.lit("low").alias("zone_ddl"),
    )
    kind = F.col("event_type")
    result = check_completeness(
        requests,
        events.where(kind == "click").withColumn("arquetype_name", F.lit("a")),
        events.where(kind == "view").withColumn("zone_name", zone),
        events.where(kind == "signup").withColumn("zone_name", zone),
        events.where(F.col("value") < 2).withColumn("table_type", kind),
        table_types=("error", "purchase"),
    )
    return result.drop("arquetype_name", "zone_email", "zone_ddl")


@query("""
WITH d AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE event_type = 'signup'),
     c AS (SELECT day, CASE WHEN isodow(day) < 6 THEN 'S' ELSE 'N' END AS flag FROM d WHERE day <> DATE '2024-01-15')
SELECT event_id, flag, coalesce(flag = 'S', false) AS is_business_day FROM events LEFT JOIN c ON ts::DATE = day""")
def business_days(t):
    # The calendar lists each signup day twice, last entry first in reverse, so that the first listed must win.
    days = t.events.where(F.col("event_type") == "signup").select(F.to_date("ts").alias("day")).distinct()
    listed = days.where(F.col("day") != F.lit("2024-01-15").cast("date"))
    flag = F.when(L.iso_weekday("day") < 6, "S").otherwise("N")
    calendar = O.concatenate(
        listed.select(F.lit(1).alias("position"), "day", F.lit("late").alias("flag")),
        listed.select(F.lit(0).alias("position"), "day", flag.alias("flag")),
    )
    return O.with_business_day(t.events, "ts", calendar).select("event_id", "flag", "is_business_day")


@query("""
WITH r AS (SELECT DISTINCT event_type, ts::DATE AS day FROM events),
     s AS (SELECT *, isodow(day) AS w, event_type = 'error' AS unknown,
                  list_contains(CASE event_type WHEN 'click' THEN [1, 3, 5] WHEN 'view' THEN [2, 6] ELSE [4] END, isodow(day)) AS planned FROM r)
SELECT event_type AS process_name, strftime(day, '%Y-%m-%d') AS run_date,
       CASE WHEN w > 5 THEN 'not a business day' WHEN unknown THEN 'no active schedule'
            WHEN NOT planned THEN 'weekday not scheduled' END AS reason,
       w <= 5 AND NOT unknown AND planned AS due,
       CASE WHEN w <= 5 AND NOT unknown AND planned THEN event_type || ' on ' || strftime(day, '%Y-%m-%d') END AS argument
FROM s""")
def due_schedules(t):
    kind = F.col("event_type")
    requests = t.events.select(kind.alias("process_name"), F.to_date("ts").alias("run_date")).distinct()
    days = (
        F.when(kind == "click", F.array(*map(F.lit, (1, 3, 5))))
        .when(kind == "view", F.array(*map(F.lit, (2, 6))))
        .otherwise(F.array(F.lit(4)))
    )
    config = F.create_map(F.lit("text"), F.concat(kind, F.lit(" on ${fecha_param}")))
    schedules = t.events.select("event_type").distinct().select(
        kind.alias("process_name"),
        days.alias("dias_semana"),
        F.array(config).alias("json_config_raw"),
        (kind != "error").alias("active"),
    )
    calendar = t.events.select(F.to_date("ts").alias("day")).distinct().select(
        F.lit(0).alias("position"), "day", F.when(L.iso_weekday("day") < 6, "S").otherwise("N").alias("flag")
    )
    return O.due_schedules(requests, schedules, calendar).select(
        "process_name", F.col("run_date").cast("string").alias("run_date"), "reason", "due",
        F.element_at("config", F.lit("text")).alias("argument"),
    )


@query("""
WITH e AS (SELECT DISTINCT 'lake/' || lang AS path FROM documents
           UNION ALL SELECT DISTINCT 'lake/' || lang || '/' || source || 'x/' FROM documents
           UNION ALL SELECT DISTINCT 'lake/' || lang || '/' || source FROM documents
           UNION ALL SELECT 'lake')
SELECT path, (SELECT count(*) FROM documents WHERE starts_with('lake/' || lang || '/' || source || '/', rtrim(path, '/') || '/')) AS files,
       (SELECT count(*) FROM documents WHERE starts_with('lake/' || lang || '/' || source || '/', rtrim(path, '/') || '/')) > 0 AS found
FROM e""")
def expected_found(t):
    lang = F.concat(F.lit("lake/"), "lang")
    folder = F.concat(lang, F.lit("/"), "source")
    files = t.documents.select(F.concat(folder, F.lit("/"), "doc_id", F.lit(".parquet")).alias("path"))
    expected = O.concatenate(
        t.documents.select(lang.alias("path")).distinct(),
        t.documents.select(F.concat(folder, F.lit("x/")).alias("path")).distinct(),
        t.documents.select(folder.alias("path")).distinct(),
        t.documents.select(F.lit("lake").alias("path")).distinct(),
    )
    return O.expected_counts(expected, files)


@query("""
WITH s AS (SELECT DISTINCT lang, source, cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS n FROM documents),
     k AS (SELECT *, CASE WHEN n = 0 THEN '' ELSE cast(n AS VARCHAR) END AS digits FROM s)
SELECT lang, source, 'src' || chr(1) || lpad(cast(length(digits) AS VARCHAR), 9, '0') || digits || chr(1) AS sort_key
FROM k""")
def natural_order(t):
    names = t.documents.select("lang", "source").distinct()
    return O.natural_order(names, "source", "lang").withColumn("sort_key", O.natural_key("source"))


@query("""
SELECT lang, arg_min(name, cast(regexp_extract(name, '([0-9]+)[.]', 1) AS BIGINT)) AS first_name,
       arg_max(name, cast(regexp_extract(name, '([0-9]+)[.]', 1) AS BIGINT)) AS last_name
FROM (SELECT lang, 'Doc_' || n_chars * 1000000 + doc_id || '.sql' AS name FROM documents) GROUP BY lang""")
def natural_ends(t):
    number = F.col("n_chars") * 1000000 + F.col("doc_id")
    names = t.documents.select("lang", F.concat(F.lit("Doc_"), number, F.lit(".sql")).alias("name"))
    return O.natural_ends(names, ["lang"], "name")


@query("""
SELECT c_name AS name, 'c' AS kind, c_mktsegment AS segment FROM customer
UNION ALL SELECT c_name, 'c', c_mktsegment FROM customer
UNION ALL SELECT s_name, 's', NULL FROM supplier""")
def concat_entries(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.lit("c").alias("kind"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.lit("s").alias("kind"), F.col("s_name").alias("name"))
    return O.concatenate(customers, customers, suppliers)


@query(f"SELECT * FROM orders WHERE (o_orderdate::DATE = DATE '{DAY}') IS DISTINCT FROM true")
def purge_by_date(t):
    return O.purge(t.orders, "o_orderdate", DAY)


@query(f"""
WITH s AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS o_orderdate) FROM orders)
SELECT 'kept' AS part, * FROM s WHERE (o_orderdate::DATE = DATE '{DAY}') IS DISTINCT FROM true
UNION ALL SELECT 'removed', * FROM s WHERE o_orderdate::DATE = DATE '{DAY}'""")
def purge_with_nulls(t):
    orders = t.orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return O.concatenate(
        O.purge(orders, "o_orderdate", DAY).withColumn("part", F.lit("kept")),
        O.purged(orders, "o_orderdate", DAY).withColumn("part", F.lit("removed")),
    )


@query(f"""
SELECT * FROM orders WHERE o_orderdate::DATE <> DATE '{DAY}'
UNION ALL SELECT * REPLACE (o_totalprice * 2 AS o_totalprice, 'R' AS o_orderstatus) FROM orders WHERE o_orderdate::DATE = DATE '{DAY}'""")
def reload_date(t):
    day = O.purged(t.orders, "o_orderdate", DAY)
    changed = day.withColumns({"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": F.lit("R")})
    return O.concatenate(O.purge(t.orders, "o_orderdate", DAY), changed)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE TIMESTAMP '2024-07-01 08:00:00' END AS fecha_carga,
       TIMESTAMP '2024-01-01 09:00:00' AS added
FROM orders""")
def stamp_nulls(t):
    orders = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("fecha_carga")
    )
    july, january = L.load_stamp("2024-07-01 12:00:00"), L.load_stamp("2024-01-01 12:00:00")
    return O.stamp_nulls(O.stamp_nulls(orders, "fecha_carga", july), "added", january)


@query("""
WITH l AS (SELECT event_id, user_id, event_type, ts, CASE WHEN value >= 20 THEN ts + INTERVAL 1 HOUR END AS e FROM events),
     m AS (SELECT *, max(CASE WHEN e IS NULL THEN ts END) OVER (PARTITION BY user_id, event_type) AS latest,
                  count(*) OVER (PARTITION BY user_id, event_type) AS n FROM l)
SELECT event_id, user_id, event_type, ts,
       CASE WHEN e IS NULL AND ts = latest AND event_type <> 'view' THEN TIMESTAMP '2024-02-01 09:00:00' ELSE e END AS end_process,
       CASE WHEN e IS NULL AND ts = latest AND event_type <> 'view' THEN n ELSE -1 END AS run_rows
FROM m""")
def close_open_runs(t):
    log = t.events.select(
        "event_id", "user_id", "event_type", "ts",
        F.when(F.col("value") >= 20, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("end_process"),
        F.lit(-1).cast("bigint").alias("run_rows"),
    )
    keys = ["user_id", "event_type"]
    counts = t.events.where(F.col("event_type") != "view").groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    stamp = L.load_stamp("2024-02-01 12:00:00")
    return O.close_runs(log, counts, stamp, keys, start="ts", end="end_process", count="run_rows")


@query("""
SELECT 'p' AS process_name, c_mktsegment AS dataset_name, c_name AS table_name, TIMESTAMP '2024-07-01 08:00:00' AS start_process,
       cast(NULL AS TIMESTAMP) AS end_process, -1 AS qantity_of_records, 'z' || c_nationkey AS zone_name
FROM customer WHERE c_acctbal >= 0""")
def open_runs(t):
    entry = F.create_map(
        F.lit("dataset_name"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        F.lit("table_name"), F.col("c_name"),
        F.lit("zone_name"), F.concat(F.lit("z"), "c_nationkey"),
    )
    runs = O.open_runs(t.customer.select(entry.alias("entry")), "p", "2024-07-01 12:00:00")
    return runs.withColumn(O.RUN_COUNT, F.coalesce(O.RUN_COUNT, F.lit(-1)).cast("int"))


@query(r"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS fecha, value AS valor, event_type AS codigo, user_id FROM events
UNION ALL SELECT event_id, '2024-02-29', cast(json_extract(props, '$.k') AS DOUBLE), event_type, user_id FROM events""")
def json_flatten(t):
    record = "struct<fecha:string,valor:double,otro:int>"
    first = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("fecha"), F.col("value").alias("valor"), F.lit(1).alias("otro")
    )
    second = F.struct(
        F.lit("2024-02-29T03:00:00.000Z").alias("fecha"),
        F.get_json_object("props", "$.k").cast("double").alias("valor"),
        F.lit(2).alias("otro"),
    )
    document = F.to_json(
        F.struct(F.col("event_type").alias("codigo"), "user_id", F.lit("x").alias("unidad"), F.array(first, second).alias("serie"))
    )
    parsed = F.from_json(document, f"codigo string, user_id bigint, unidad string, serie array<{record}>")
    docs = t.events.select("event_id", parsed.alias("_d")).select("event_id", "_d.*")
    rows = S.flatten_documents(docs, ["codigo", "user_id"], ["fecha", "valor"], keep=["event_id"])
    return rows.withColumn("fecha", F.col("fecha").cast("string"))


@query(r"""
SELECT event_id, 0 AS position, json_extract_string(props, '$.k') AS k, 'none' AS zone FROM events WHERE event_type IN ('click', 'view')
UNION ALL SELECT event_id, 1, '7', 'z' FROM events WHERE event_type = 'view'""")
def params_explode(t):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit(" "), "props"))
        .when(kind == "view", F.concat(F.lit("["), "props", F.lit(', {"k": 7, "zone": "z"}]')))
        .when(kind == "error", F.concat(F.lit("{broken"), "props"))
        .when(kind == "purchase", F.lit("[1, 2]"))
    )
    entries = S.explode_params(t.events.select("event_id", text.alias("params")))
    return entries.select(
        "event_id", "position", F.element_at("entry", F.lit("k")).alias("k"),
        L.default_if_absent("entry", "zone", "none").alias("zone"),
    )


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def params_rejected(t):
    kind = F.col("event_type")
    text = F.when(kind == "error", F.lit('{"a": ')).when(kind == "purchase", F.lit("[1]")).when(kind == "click", F.col("props"))
    return S.rejected_params(t.events.select("event_id", "event_type", text.alias("params"))).drop("params")


@query("""
SELECT doc_id, -1 AS position, 'not a list' AS reason FROM documents WHERE lang = 'es'
UNION ALL SELECT doc_id, 1, 'not a record' FROM documents WHERE lang = 'fr'
UNION ALL SELECT doc_id, 1, 'missing: type, mode' FROM documents WHERE lang = 'de'
UNION ALL SELECT doc_id, 2, 'missing: name' FROM documents WHERE lang = 'de'""")
def schema_contract(t):
    good = '{"name": "a", "type": "STRING", "mode": "NULLABLE", "note": [1]}'
    text = (
        F.when(F.col("lang") == "es", F.lit(good))
        .when(F.col("lang") == "fr", F.lit(f"[{good}, 5]"))
        .when(F.col("lang") == "de", F.lit(f'[{good}, {{"name": "b"}}, {{"type": "DATE", "mode": null}}]'))
        .otherwise(F.concat(F.lit(f'[{good}, {{"name": "'), "source", F.lit('", "type": "DATE", "mode": "REQUIRED"}]')))
    )
    found = O.document_violations(t.documents.select("doc_id", text.alias("params")), "params", "doc_id")
    return found.withColumn("position", F.coalesce("position", F.lit(-1)))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN 'segment,balance'
                       WHEN c_mktsegment = 'BUILDING' THEN 'segment' ELSE 'balance' END AS null_columns
FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0""")
def required_nulls(t):
    schema = O.struct_type([
        {"name": "c_custkey", "type": "INT64", "mode": "REQUIRED"},
        {"name": "segment", "type": "STRING", "mode": "REQUIRED"},
        {"name": "balance", "type": "NUMERIC", "mode": "REQUIRED"},
        {"name": "nation", "type": "STRING", "mode": "NULLABLE"},
    ])
    rows = t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    found = O.required_violations(O.apply_schema(rows, schema), schema)
    return found.select("c_custkey", F.array_join("null_columns", ",").alias("null_columns"))


@query("""
SELECT c_mktsegment, cast(NULL AS VARCHAR) AS comment, cast(c_custkey AS VARCHAR) AS c_custkey, c_name, cast(c_nationkey AS BIGINT) AS c_nationkey
FROM customer""")
def insert_by_name(t):
    from ..sinks import align

    target = StructType([
        StructField("c_mktsegment", StringType()),
        StructField("comment", StringType()),
        StructField("c_custkey", StringType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", LongType()),
    ])
    return align(t.customer.select("C_NAME", "c_custkey", "c_nationkey", "c_mktsegment"), target)


@query("""
SELECT p_partkey, p_name, 'lake' AS origin, 3 AS version, cast(NULL AS VARCHAR) AS note FROM part""")
def project_and_constants(t):
    rows = O.with_constants(O.pick(t.part, ["p_name", "p_partkey"]), {"origin": "lake", "version": 3})
    return O.add_missing_column(O.add_missing_column(rows, "note", "string"), "p_name", "string")


@query("""
SELECT user_id AS process_name, event_id, CASE WHEN event_type = 'purchase' THEN 'OK' ELSE event_type END AS estado,
       'u' || user_id AS recipient, CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'failed ' || user_id END AS subject,
       CASE WHEN event_type = 'purchase' THEN 'all well' ELSE 'see log' END AS body
FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')""")
def notices_for_outcomes(t):
    user = F.col("user_id").cast("string")
    text = F.concat(
        F.lit('[{"email_to_0": "u'), user, F.lit('", "email_subj_ok": "done", "email_body_ok": "all well", "email_subj_err": "failed '),
        user, F.lit('", "email_body_err": "see log"}]'),
    )
    emails = t.events.groupBy(F.col("user_id").alias("process_name")).agg(
        F.max((F.col("event_type") == "signup").cast("int")).alias("estatus"), F.first(text).alias("params")
    )
    outcomes = t.events.select(
        F.col("user_id").alias("process_name"),
        F.when(F.col("event_type") == "purchase", "OK").otherwise(F.col("event_type")).alias("estado"),
        "event_id",
    )
    return notices(emails, outcomes)
