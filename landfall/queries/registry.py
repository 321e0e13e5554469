"""Queries over the given tables, each with its counterpart in SQL."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes, and places for what a query writes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(posixpath.join(self.folder, f"{name}.parquet"))

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def schema(self) -> str:
        """A fresh schema whose tables lie in the scratch folder."""
        name = f"landfall_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE SCHEMA {name} LOCATION '{self.scratch(name)}'")
        return name


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(function):
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql:
            ORACLE[name] = sql
        return function

    return register
