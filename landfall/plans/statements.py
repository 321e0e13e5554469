"""Registered and ordered SQL."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import DATE_PLACEHOLDER, all_equal, base_name, ddl_table, render
from ..functions.dates import normal_period
from ..operators import natural_order, outcome
from ..sinks import defined_name, export_rows, full_refresh, purge_table, quoted, results_frame, same_table, write_document
from ..sinks.files import slug
from ..sources import read_texts

# The names that a template may use.
TEMPLATE_NAMES = (
    "nombre_proceso",
    "version_arquetipo_raw",
    "periodicidad",
    "buckets_detino",
    "path_destino",
    "proyecto",
    "nombre_archivo",
    "dataset_raw_zone",
    "nombre_tabla_raw",
    "campo_fecha_tabla_raw",
    "fecha_ejecucion",
    "ddl_raw",
    "correos_destinatarios",
)

_STEP = "file string, status string, reason string, error string"


def run_sql(spark: SparkSession, text: str, dry_run: bool = False) -> str | None:
    """Run SQL text to its end; several statements run as one script. Returns a remark, if any.

    A placeholder that nobody filled is an error, since Spark itself would put nothing in its place.
    """
    if "${" in text:
        raise ValueError("the statement holds a placeholder without a value")
    text = text.strip()
    try:
        result = spark.sql(f"EXPLAIN {text}" if dry_run else text)
    except ParseException:
        # Nothing has run yet. Text of several statements parses as a script only.
        if ";" not in text:
            raise
        if dry_run:
            return _check_each(spark, text)
        try:
            result = spark.sql(f"BEGIN\n{text}\nEND")
        except ParseException:
            result = spark.sql(f"BEGIN\n{text}\n;\nEND")
    if dry_run:
        plan = "\n".join(row[0] for row in result.collect())
        if plan.startswith("Error occurred during query planning"):
            raise ValueError(plan.split("\n", 1)[1])
    elif result.columns:
        # A plain query does nothing until its rows are asked for.
        result.write.format("noop").mode("overwrite").save()
    return None


def split_statements(text: str) -> list[str]:
    """The statements of a text. Semicolons within quotes and comments don't end one."""
    tokens = re.finditer(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*[\s\S]*?\*/|;""", text)
    cuts = [m.start() for m in tokens if m.group() == ";"]
    parts = [text[a:b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(text)])]
    return [p.strip() for p in parts if re.sub(r"--[^\n]*|/\*[\s\S]*?\*/", "", p).strip()]


def _check_each(spark: SparkSession, text: str) -> str | None:
    """Check every statement of a text without running any. What an earlier one would make counts as there."""
    made: set[str] = set()
    unchecked = 0
    for statement in split_statements(text):
        try:
            run_sql(spark, statement, dry_run=True)
        except ParseException:
            raise
        except Exception as error:
            if not any(re.search(rf"(?<![\w]){re.escape(name)}(?![\w])", statement.replace("`", ""), re.IGNORECASE) for name in made):
                raise error
            unchecked += 1  # it uses what isn't there before the text runs
        found = re.match(r"\s*CREATE\s+(?:OR\s+REPLACE\s+)?(?:TEMP(?:ORARY)?\s+)?(?:TABLE|VIEW)\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.`-]+)", statement, re.IGNORECASE)
        if found:
            made.add(found.group(1).replace("`", ""))
    return f"{unchecked} statements use what earlier ones make" if unchecked else None


def run_scripts(
    spark: SparkSession, scripts: DataFrame, dry_run: bool = False, variables: Mapping[str, str] | None = None
) -> DataFrame:
    """Run the scripts of a frame (``path``, ``body``) in natural order of their paths.

    Empty scripts are skipped, a failing one does not stop the rest. Scripts run one after the other, since each may
    need what the one before it made. ``variables`` fill ``${name}``.
    """
    results = []
    for row in natural_order(scripts, "path").collect():
        name, text = row["path"].rsplit("/", 1)[-1], row["body"].strip()
        if not text:
            results.append({"file": name, "status": "skipped", "reason": "empty file"})
            continue
        for key, value in (variables or {}).items():
            text = text.replace("${" + key + "}", value)
        try:
            remark = run_sql(spark, text, dry_run)
            results.append({"file": name, "status": "dry-run" if dry_run else "done", "reason": remark})
        except Exception as error:
            results.append({"file": name, "status": "error", "error": str(error)})
    return results_frame(spark, results, _STEP)


def run_script_folder(spark: SparkSession, folder: str, process_name: str, **options) -> DataFrame:
    """Run the ``.sql`` files below ``<folder>/<process_name>/``; none is an error."""
    scripts = read_texts(spark, f"{folder.rstrip('/')}/{process_name}/", "*.[sS][qQ][lL]")
    if scripts.isEmpty():
        raise FileNotFoundError(f"no .sql file below {folder}/{process_name}/")
    return run_scripts(spark, scripts, **options)


def step_line():
    """Text line of a script result."""
    # The tags of the lines.
    return F.concat(
        F.when(F.col("status") == "skipped", F.lit("[SKIP] "))
        .when(F.col("status") == "error", F.lit("[ERR] "))
        .otherwise(F.lit("[OK] ")),
        F.col("file"),
        F.coalesce(F.concat(F.lit(" -> "), F.coalesce("error", "reason")), F.lit("")),
    )


def summary(results: DataFrame) -> DataFrame:
    """``processed`` and ``succeeded`` counts of step results, and ``status`` ``ok`` or ``partial``."""
    status = F.lower("status")
    return outcome(results, status == "error", ~status.isin("error", "skipped"))


def render_scripts(
    texts: DataFrame, variables: DataFrame, allowed: Sequence[str] = TEMPLATE_NAMES
) -> DataFrame:
    """Texts (``path``, ``body``) with the allowed variables (``name``, ``value``) filled in, and what ``changed``.

    The list of allowed names bounds what is brought to the driver. No allowed variable is an error.
    """
    known = variables.where(F.col("name").isin(*allowed) & F.col("value").isNotNull())
    values = {r["name"]: r["value"] for r in known.groupBy("name").agg(F.max("value").alias("value")).collect()}
    if not values:
        raise ValueError("no variable with an allowed name")
    return texts.select(
        "path", base_name("path").alias("file"), render("body", values).alias("body"),
        (render("body", values) != F.col("body")).alias("changed"),
    )


def definitions(process_ddl: DataFrame, process_name: str, types: Sequence[str]) -> DataFrame:
    """Active CREATE statements of a process for the given table types, in a fixed order."""
    wanted = all_equal({"process_name": process_name}, active="is_active") & F.col("table_type").isin(*types)
    return process_ddl.where(wanted).select(
        "table_type", "ddl_statement", ddl_table("ddl_statement").alias("target")
    ).orderBy(F.array_position(F.array(*map(F.lit, types)), F.col("table_type")), "ddl_statement")


def run_definitions(
    spark: SparkSession, process_ddl: DataFrame, process_name: str, types: Sequence[str], skip_existing: bool = False
) -> DataFrame:
    """Run the registered CREATE statements; each gets a status. None registered is an error.

    ``skip_existing`` leaves a table alone that is there already, and needs a three-part name to look for.
    """
    rows = definitions(process_ddl, process_name, types).collect()
    if not rows:
        raise LookupError(f"no active definition for '{process_name}'")
    results = []
    for row in rows:
        result = {"table_type": row["table_type"], "status": "CREATED"}
        results.append(result)
        try:
            if skip_existing:
                target = row["target"]
                if target["table"] is None:
                    raise ValueError("the statement names no three-part table")
                name = quoted(f"{target['catalog']}.{target['schema']}.{target['table']}")
                if spark.catalog.tableExists(name):
                    result.update(status="SKIPPED", reason="table exists")
                    continue
            run_sql(spark, row["ddl_statement"])
        except Exception as error:
            result.update(status="ERROR", error=str(error))
    return results_frame(spark, results, "table_type string, status string, reason string, error string")


def run_insert(
    spark: SparkSession, process_insert: DataFrame, process_name: str, table_type: str, day: str
) -> dict[str, str]:
    """Run the registered INSERT of a process and table type for a date. None registered is an error."""
    wanted = all_equal({"process_name": process_name, "table_type": table_type}, active="is_active")
    row = process_insert.where(wanted).orderBy("insert_statement").limit(1).first()
    if row is None:
        raise LookupError(f"no active INSERT for '{process_name}' and '{table_type}'")
    dt.date.fromisoformat(day)
    run_sql(spark, row["insert_statement"].replace(DATE_PLACEHOLDER, day))
    return {"process_name": process_name, "table_type": table_type, "fecha_param": day, "status": "OK"}


def purge_tables(
    spark: SparkSession, process_table_list: DataFrame, process_name: str, date_column: str, day: str
) -> DataFrame:
    """Purge a date from each registered table; a failure does not stop the rest. None registered is an error."""
    rows = (
        process_table_list.where(all_equal({"process_name": process_name}, active="is_active"))
        .select("dataset_name", "table_name").distinct().orderBy("dataset_name", "table_name").collect()
    )
    if not rows:
        raise LookupError(f"no active table for '{process_name}'")
    results = []
    for row in rows:
        name = f"{row['dataset_name']}.{row['table_name']}"
        try:
            purge_table(spark, name, date_column, day)
            results.append({"table_name": name, "status": "OK"})
        except Exception as error:
            results.append({"table_name": name, "status": "ERROR", "error": str(error)})
    return results_frame(spark, results, "table_name string, status string, error string")


def purge_entries(spark: SparkSession, entries, process_ddl: DataFrame, process_name: str) -> DataFrame:
    """Purge the date of each configured entry, or refresh its table in full when sporadic or without a date."""
    results = []
    for entry in entries:
        table, dataset = entry.get("table_name"), entry.get("dataset_name")
        parts = [dataset, table] if dataset and table else (table or "").split(".")
        if len(parts) != 2 or not all(parts):
            results.append({"table_name": table, "status": "ERROR", "error": "table or dataset missing or malformed"})
            continue
        name = ".".join(parts)
        day, column = (entry.get("fecha_param") or "").strip(), (entry.get("fecha_columna") or "").strip()
        try:
            if normal_period(entry.get("periodicidad")) == "sporadic" or not day or not column:
                listed = [row["ddl_statement"] or "" for row in definitions(process_ddl, process_name, ["raw"]).collect()]
                found = next((ddl for ddl in listed if same_table(defined_name(ddl), name)), None)
                if found is None:
                    raise LookupError(f"no definition of {name} registered")
                full_refresh(spark, name, found)
                results.append({"table_name": name, "status": "OK", "reason": "created anew"})
            else:
                purge_table(spark, name, column, day)
                results.append({"table_name": name, "status": "OK", "reason": f"purged {day}"})
        except Exception as error:
            results.append({"table_name": name, "status": "ERROR", "error": str(error)})
    return results_frame(spark, results, "table_name string, status string, reason string, error string")


def period_day(day: str, periodicity: str) -> str:
    """``dd-MM-yyyy`` text as the day of a daily or the first of a monthly period."""
    try:
        date = dt.datetime.strptime(day, "%d-%m-%Y").date()
    except ValueError:
        raise ValueError(f"bad date '{day}', dd-MM-yyyy wanted") from None
    period = normal_period(periodicity)
    if period not in ("daily", "monthly"):
        raise ValueError(f"bad periodicity '{periodicity}'")
    return (date if period == "daily" else date.replace(day=1)).isoformat()


def export_query(
    spark: SparkSession, query: str, day: str, periodicity: str, file: str, root: str
) -> dict[str, str]:
    """Export a query's rows to the folder of their period, and write down the query and where its rows are."""
    if not query or not day or not file or not periodicity:
        raise ValueError("query, date, file and periodicity are needed")
    if "${" in query:
        raise ValueError("the query holds a placeholder without a value")
    path = export_rows(spark.sql(query), root, file, period_day(day, periodicity))
    request = json.dumps({"query": query, "output_path": path}, indent=4)
    params = write_document(spark, request, f"{root.rstrip('/')}/jobs-params/{slug(file)}.json")
    return {"query": query, "output_path": path, "params_path": params}
