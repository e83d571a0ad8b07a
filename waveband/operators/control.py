"""The control table of survey quarters: registration and the loaded flag.

The control table (``file_quarter, in_data, quarter_date``) has one row per
survey quarter; Spark broadcasts it by its file size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveband.functions.expressions import date_lookup_quarter
from waveband.schemas import QUARTERS

# ---- fixed values ------------------------------------------------------------
LOADED, NOT_LOADED = "Yes", "No"


def listed_quarters(stored: DataFrame) -> list[str]:
    """The quarters of a table, sorted. Of one that is stored by quarter they are the names of its folders; no data file is opened.

    A folder without any row would count; no Spark job writes one.
    """
    spark, setting = stored.sparkSession, "spark.sql.optimizer.metadataOnly"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        found = stored.select("file_quarter").distinct().collect()
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)
    return sorted(r[0] for r in found if r[0] is not None)


def register_next_quarter(weights: DataFrame, dates: DataFrame, control: DataFrame) -> DataFrame:
    """The earliest quarter that has weights and a calendar entry but no control row.

    Returns at most one row ``(file_quarter, 'No', quarter_date)`` where
    ``quarter_date`` is the quarter's first week. The weights are reduced to
    their distinct quarters before any join (a partial aggregate, so the raw
    weights are never shuffled); NULL weights count, as in the original.
    Ties on the date are broken by the quarter name. The build passes the
    weights' quarters alone, from :func:`listed_quarters`.
    """
    quarters = weights.select("file_quarter").distinct()
    known = control.select("file_quarter").distinct()
    unregistered = quarters.join(known, "file_quarter", "left_anti")
    calendar = dates.select(F.col("quarter").alias("_cal_quarter"), "week_beginning")
    dated = unregistered.join(
        calendar, date_lookup_quarter("file_quarter") == F.col("_cal_quarter"), "inner"
    )
    first = dated.groupBy("file_quarter").agg(F.min("week_beginning").alias("quarter_date"))
    return (
        first.orderBy("quarter_date", "file_quarter")
        .limit(1)
        .select("file_quarter", F.lit(NOT_LOADED).alias("in_data"), "quarter_date")
    )


def append_quarter(control: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Control table with the registered row(s) appended."""
    return control.select(*QUARTERS.fieldNames()).unionByName(new_rows.select(*QUARTERS.fieldNames()))


def check_single_quarter(reports: DataFrame) -> None:
    """The error of the original's scalar subquery: more than one staged quarter."""
    staged = reports.select("file_quarter").distinct().filter(F.col("file_quarter").isNotNull())
    if staged.limit(2).count() > 1:
        raise ValueError("more than one quarter staged; the loaded flag takes a single quarter")


def mark_loaded(control: DataFrame, reports: DataFrame, strict: bool = False) -> DataFrame:
    """Set ``in_data = 'Yes'`` for the quarters present in the staged reports.

    The original compares with a scalar subquery: no staged quarter changes
    nothing, and more than one is an error. ``strict=True`` keeps that error;
    the default flags every staged quarter, which is what a multi-quarter
    backfill needs.
    """
    if strict:
        check_single_quarter(reports)
    loaded = reports.select("file_quarter").distinct().filter(F.col("file_quarter").isNotNull())
    hits = loaded.withColumn("_hit", F.lit(True))
    return (
        control.join(hits, "file_quarter", "left")
        .withColumn("in_data", F.when(F.col("_hit"), F.lit(LOADED)).otherwise(F.col("in_data")))
        .select(*QUARTERS.fieldNames())
    )
