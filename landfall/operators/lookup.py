"""Lookups: business days, due schedules, expected files.

All are equi-joins. Adaptive execution broadcasts a side that it has measured to be small and splits hot keys of the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import DATE_PLACEHOLDER, iso_weekday


def calendar_days(entries: DataFrame) -> DataFrame:
    """One flag per day, the first listed."""
    return (
        entries.where(F.col("day").isNotNull())
        .groupBy("day")
        .agg(F.min_by("flag", "position").alias("flag"))
    )


def with_business_day(
    df: DataFrame, day: str, calendar: DataFrame, flag: str = "flag", out: str = "is_business_day"
) -> DataFrame:
    """Add the calendar's flag for a date column, null when not listed, and whether it is a business day."""
    days = calendar_days(calendar).select(
        F.col("day").alias("_calendar_day"), F.col("flag").alias(flag)
    )
    return (
        df.join(days, F.to_date(F.col(day)) == F.col("_calendar_day"), "left")
        .drop("_calendar_day")
        .withColumn(out, F.coalesce(F.col(flag) == "S", F.lit(False)))
    )


def one_schedule_per_process(schedules: DataFrame) -> DataFrame:
    """The active schedule of each process; the smallest text when there are several."""
    fields = F.struct(*schedules.columns)
    return (
        schedules.where(F.col("active"))
        .groupBy(F.col("process_name").alias("_process"))
        .agg(F.min_by(fields, F.to_json(fields)).alias("_schedule"))
    )


def due_schedules(
    requests: DataFrame, schedules: DataFrame, calendar: DataFrame, config: str = "json_config_raw"
) -> DataFrame:
    """Whether each requested (``process_name``, ``run_date``) is due, with its configuration or the reason.

    Due means a business day whose ISO weekday is in ``dias_semana``. The configuration is the first record of
    the chosen column with the run date filled in.
    """
    chosen = one_schedule_per_process(schedules)
    rows = with_business_day(requests, "run_date", calendar, flag="_flag", out="_business").join(
        chosen, F.col("process_name") == F.col("_process"), "left"
    )
    reason = (
        F.when(~F.col("_business"), "not a business day")
        .when(F.col("_process").isNull(), "no active schedule")
        .when(
            ~F.coalesce(F.array_contains(F.col("_schedule.dias_semana"), iso_weekday("run_date")), F.lit(False)),
            "weekday not scheduled",
        )
    )
    filled = F.transform_values(
        F.get(F.col(f"_schedule.{config}"), F.lit(0)),
        lambda _, v: F.replace(v, F.lit(DATE_PLACEHOLDER), F.date_format("run_date", "yyyy-MM-dd")),
    )
    return (
        rows.withColumn("reason", reason)
        .withColumn("due", F.col("reason").isNull())
        .withColumn("config", F.when(F.col("due"), filled))
        .drop("_flag", "_business", "_process", "_schedule")
    )


def _folders(path):
    """Every folder above a file path, as an array."""
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    return F.when(
        depth > 0,
        F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
    )


def expected_files(expected: DataFrame, files: DataFrame, path: str = "path", file: str = "path") -> DataFrame:
    """Each expected folder with the files below it at any depth; a folder without files keeps one null row.

    A file is matched through the folders above it, which makes this an equi-join rather than a comparison of every file with every folder.
    Folders that nobody expects, such as the root above all files, are dropped by an inner join before anything else.
    """
    key = F.regexp_replace(F.col(path), r"/+\z", "")
    wanted = expected.select(key.alias("_folder")).distinct()
    listed = files.withColumn("_folder", F.explode(_folders(F.col(file)))).join(wanted, "_folder").select(
        "_folder", *(F.col(name).alias(f"file_{name}" if name in expected.columns else name) for name in files.columns)
    )
    return expected.join(listed, key == F.col("_folder"), "left").drop("_folder")


def expected_counts(expected: DataFrame, files: DataFrame, path: str = "path", file: str = "path") -> DataFrame:
    """Each expected folder with its number of ``files``, zero when missing, and whether any was ``found``.

    Files are counted per folder first, so only folders are matched.
    """
    counts = (
        files.groupBy(F.regexp_extract(F.col(file), r"(?s)\A(.*)/[^/]*\z", 1).alias("_own"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_folder", F.explode(_folders(F.concat("_own", F.lit("/")))))
        .groupBy("_folder")
        .agg(F.sum("_n").alias("files"))
    )
    key = F.regexp_replace(F.col(path), r"/+\z", "")
    return (
        expected.join(counts, key == F.col("_folder"), "left")
        .drop("_folder")
        .withColumn("files", F.coalesce("files", F.lit(0)))
        .withColumn("found", F.col("files") > 0)
    )
