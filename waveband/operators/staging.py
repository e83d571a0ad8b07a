"""Staging: scope each raw survey table to the run's quarters and de-duplicate it.

The original load materialises each staged table; here they are lazy
DataFrames. The explicit ``distinct`` calls are semantics (duplicate raw rows
must not multiply weights), not an optimisation, so they are kept wherever the
original has them. ``select`` before ``distinct`` prunes the Parquet scan to the
columns in use.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveband.functions.expressions import ownership
from waveband.operators.scope import scope_quarters
from waveband.schemas import LISTENING, REPORT_COLUMNS

# Reports from other sources are not loaded.
REPORT_SOURCE = 1


def stage_reports(replist: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    """Report list of the run: source 1 only, with BBC/Commercial ownership."""
    scoped = scope_quarters(replist, quarters, mode).filter(F.col("source") == REPORT_SOURCE)
    return scoped.withColumn("bbc_or_commercial", ownership("report_name")).select(*REPORT_COLUMNS).distinct()


def stage_distinct(df: DataFrame, columns: list[str], quarters: Iterable[str],
                   mode: str = "pending") -> DataFrame:
    """Scope to the run's quarters, keep ``columns``, drop duplicate rows."""
    return scope_quarters(df, quarters, mode).select(*columns).distinct()


def stage_tsa(tsa: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    return stage_distinct(tsa, ["file_quarter", "report_id", "segment"], quarters, mode)


def stage_segs(segs: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    """Segment to station list. Staged like the others; nothing downstream reads it."""
    return stage_distinct(segs, ["file_quarter", "segment", "station_code"], quarters, mode)


def stage_postal(postal: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    return stage_distinct(postal, ["file_quarter", "sample_point", "segment"], quarters, mode)


def stage_individuals(individuals: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    cols = ["file_quarter", "respid", "sample_point", "age_15plus", "sex", "age"]
    return stage_distinct(individuals, cols, quarters, mode)


def stage_weights(weights: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    """Weights of the run; NULL weights are dropped (zero weights are kept)."""
    cols = ["file_quarter", "respid", "reporting_period", "weight"]
    return stage_distinct(weights.filter(F.col("weight").isNotNull()), cols, quarters, mode)


def stage_listening(listening: DataFrame, quarters: Iterable[str], mode: str = "pending") -> DataFrame:
    """Diary rows of the run. No de-duplication here: sessions keep repeated rows."""
    return scope_quarters(listening, quarters, mode).select(*LISTENING.fieldNames())
