"""Weighted reach and listening-hours measures.

Inputs are person-level rows (one row per respondent and reporting key) with
``weight`` (thousands of people) and ``minutes`` (integer minutes listened).

* ``accounts`` = sum(weight) * 1000, the weighted reach.
* ``hours`` = sum(minutes * weight) / 60 * 1000. The published formula sums
  ``minutes / 60.0 * weight`` per person; the form here is algebraically equal
  and rounds once instead of once per person, so it does not depend on the
  order in which partial sums meet.
* ``time_per_account`` = hours / accounts, split into whole hours
  (``floor``) and minutes (``round`` of the fraction * 60, no carry, so 60 can
  occur).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveband.functions.expressions import WEIGHT_SCALE


def reach_aggregates(with_respondents: bool = True) -> list[Column]:
    aggs = []
    if with_respondents:
        # exact distinct count: a person can have several rows in one group
        aggs.append(F.countDistinct("respid").alias("respondents"))
    aggs += [
        (F.sum("weight") * F.lit(WEIGHT_SCALE)).alias("accounts"),
        (F.sum(F.col("minutes") * F.col("weight")) / F.lit(60.0) * F.lit(WEIGHT_SCALE)).alias("hours"),
    ]
    return aggs


def reach_measures(df: DataFrame) -> DataFrame:
    """Add time per account and its hours/minutes split after aggregation."""
    tpa = F.col("hours") / F.col("accounts")
    whole = F.floor(tpa).cast("double")
    return df.select(
        "*",
        tpa.alias("time_per_account"),
        whole.alias("numerical_hours_account"),
        F.round((tpa - whole) * F.lit(60)).cast("double").alias("numerical_minutes_account"),
    )
