"""Schema publication and notices."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions import by_status
from ..operators import check_document, first_row
from ..sinks import write_document
from ..sources import explode_params


def publish_schema(spark: SparkSession, process_schemas: DataFrame, process_name: str, path: str) -> str:
    """Write the registered schema of a process as a JSON document once it keeps the contract."""
    params = F.col("params")
    if not isinstance(process_schemas.schema["params"].dataType, StringType):
        params = F.to_json(params)
    rows = process_schemas.where(F.col("process_name") == process_name).select(params.alias("text"))
    row = first_row(rows, "text").first()
    if row is None:
        raise LookupError(f"no schema for '{process_name}'")
    return write_document(spark, json.dumps(check_document(row["text"]), indent=2), path)


def notices(process_email: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Recipient, subject and body for each outcome (``process_name``, ``estado``) of a process with active notices.

    The first entry of the smallest params text is taken where several rows are active.
    """
    def value(name: str):
        return F.element_at(F.col("entry"), F.lit(name))

    entries = explode_params(process_email.where(F.col("estatus") == 1)).where(F.col("position") == 0)
    chosen = entries.groupBy("process_name").agg(F.min_by("entry", F.to_json("entry")).alias("entry"))
    return outcomes.join(chosen, "process_name").select(
        *outcomes.columns,
        value("email_to_0").alias("recipient"),
        by_status("estado", value("email_subj_ok"), value("email_subj_err")).alias("subject"),
        by_status("estado", value("email_body_ok"), value("email_body_err")).alias("body"),
    )
