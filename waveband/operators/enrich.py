"""Enrichment: station geography metadata and diary rows joined to people.

Join plan (designed for one large table, the diary rows):

* Person attributes are joined together first, on the person side:
  individuals x weights on (respid, quarter), then households on
  (household id, quarter), all by shuffle, as they grow with respondents.
* Diary rows of stations that have no staged report are dropped first by a
  semi-join on the staged reports' stations, a small table by its file sizes.
* The diary rows are then shuffled **once**, on (respid, quarter), to meet the
  person side. Both children of that join are plain shuffle stages, so a
  respondent with a large share of the rows is split by AQE's skew join, by
  measured sizes. The build hands the person side and the station metadata over
  as Parquet first, so the metadata join is planned by its real size: a broadcast,
  or beyond the threshold a shuffle join that AQE can split.
* Unless AQE has split a partition, the result stays hash-partitioned on
  (respid, quarter), and the 25-column ``distinct`` of the listening facts groups
  by keys that include both, so it runs without another exchange.

The original statement is a chain of LEFT joins followed by
``weight IS NOT NULL``; that filter rejects every row in which the individual,
metadata or weight lookup missed, so those joins are inner joins (the
optimiser derives the same). Only the household lookup stays a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveband.functions.expressions import broadcast_day_end, household_id
from waveband.operators.fanout import JoinCounts
from waveband.schemas import FACT_COLUMNS, LISTENING, METADATA_COLUMNS, SESSION_COLUMNS

PERSON_COLUMNS = ["sample_point", "age_15plus", "age", "sex"]


def report_segments(reports: DataFrame, tsa: DataFrame) -> DataFrame:
    """Survey-area segments of each staged report."""
    r = reports.select("file_quarter", "report_id")
    t = tsa.select("file_quarter", "report_id", "segment")
    return (
        r.join(t, ["report_id", "file_quarter"], "inner")
        .select("file_quarter", "report_id", "segment")
        .distinct()
    )


def station_metadata(reports: DataFrame, segments: DataFrame, postal: DataFrame) -> DataFrame:
    """Reports with their segments and sample points (one row per report x segment x point).

    A sample point in two segments of one report appears twice; that fan-out is
    part of the published numbers and is kept.
    """
    seg = segments.select("file_quarter", "report_id", "segment")
    pts = postal.select("file_quarter", "segment", "sample_point")
    return (
        reports.join(seg, ["report_id", "file_quarter"], "left")
        .join(pts, ["segment", "file_quarter"], "left")
        .select(*METADATA_COLUMNS)
        .distinct()
    )


def listening_with_people(listening: DataFrame, individuals: DataFrame) -> DataFrame:
    """Diary rows with the respondent's sample point, age and sex (left join)."""
    people = individuals.select("file_quarter", "respid", *PERSON_COLUMNS)
    return listening.join(people, ["respid", "file_quarter"], "left").select(
        *LISTENING.fieldNames(), *PERSON_COLUMNS
    )


def _counted(df: DataFrame, point: str, counts: JoinCounts | None) -> DataFrame:
    return df if counts is None else counts.counted(df, point)


def person_attributes(individuals: DataFrame, weights: DataFrame, households: DataFrame,
                      counts: JoinCounts | None = None) -> DataFrame:
    """Individuals x weights (per reporting period), with household region and grade."""
    people = individuals.select("file_quarter", "respid", *PERSON_COLUMNS)
    w = weights.filter(F.col("weight").isNotNull()).select("file_quarter", "respid", "reporting_period", "weight")
    hh = households.select("file_quarter", "hhid", "bbc_regions", "household_social_grade")
    weighted = people.join(w, ["respid", "file_quarter"], "inner").withColumn("hhid", household_id("respid"))
    found = _counted(weighted, "people", counts).join(hh, ["hhid", "file_quarter"], "left").drop("hhid")
    return _counted(found, "people with households", counts)


def diary_base(listening: DataFrame, people: DataFrame, metadata: DataFrame, reports: DataFrame) -> DataFrame:
    """Diary rows x person attributes x station metadata, 25 columns, duplicates kept.

    ``people`` is :func:`person_attributes`. Join keys: (respid, quarter) to the
    person side, then (station, sample point, quarter, reporting period) to the
    metadata.
    """
    meta = metadata.select(
        "file_quarter", "station_code", "sample_point", "reporting_period",
        "report_id", "report_name", "segment", "bbc_or_commercial", "platform_name",
    )
    # Diary rows of stations without a staged report can never match the
    # metadata, which has the stations of the reports; drop them before the shuffle.
    reported = reports.select("station_code", "file_quarter").distinct()
    diary = listening.select(*LISTENING.fieldNames()).join(reported, ["station_code", "file_quarter"], "left_semi")
    return (
        diary.join(people, ["respid", "file_quarter"], "inner")
        .join(meta, ["station_code", "sample_point", "file_quarter", "reporting_period"], "inner")
        .select(*FACT_COLUMNS)
    )


def listening_facts(base: DataFrame) -> DataFrame:
    """The first summary: distinct enriched diary rows (all 25 columns, row_id included)."""
    return base.select(*FACT_COLUMNS).distinct()


def counted_facts(base: DataFrame) -> DataFrame:
    """Distinct enriched rows with ``copies``, how often each occurs in ``base``.

    One aggregate serves both outputs: dropping ``copies`` gives the listening
    facts (``distinct``), expanding it (:func:`expand_copies`) gives back the
    enriched rows with their repeats for the sessions. It groups by all 25
    columns, which include (respid, quarter), so it runs inside the join's
    partitioning.
    """
    return base.groupBy(*FACT_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))


def expand_copies(counted: DataFrame) -> DataFrame:
    """The enriched rows of :func:`counted_facts`, each repeated ``copies`` times."""
    return counted.select(*FACT_COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def session_facts(base: DataFrame, slots: DataFrame, control: DataFrame, counts: JoinCounts | None = None) -> DataFrame:
    """The second summary: enriched diary rows (not de-duplicated) with time-slot ids.

    The end time is moved from the broadcast-day '28:00' to '04:00' before the
    lookup. When the start hour is not after the end hour both ids are the
    broadcast-day ``slot_id``; otherwise (also when either lookup missed) both
    are the ``clock_slot_id``.
    """
    st = slots.select(
        F.col("slot_time").alias("hhmm_start"), F.col("slot_hour").alias("_st_hour"),
        F.col("slot_id").alias("_st_slot_id"), F.col("clock_slot_id").alias("_st_clock_id"),
    )
    en = slots.select(
        F.col("slot_time").alias("hhmm_end"), F.col("slot_hour").alias("_en_hour"),
        F.col("slot_id").alias("_en_slot_id"), F.col("clock_slot_id").alias("_en_clock_id"),
    )
    qd = control.select("file_quarter", "quarter_date")
    same_day = F.col("_st_hour") <= F.col("_en_hour")
    rows = base.select(*[broadcast_day_end("hhmm_end").alias(c) if c == "hhmm_end" else F.col(c) for c in FACT_COLUMNS])
    started = _counted(_counted(rows, "sessions", counts).join(st, "hhmm_start", "left"), "sessions with starts", counts)
    ended = _counted(started.join(en, "hhmm_end", "left"), "sessions with ends", counts)
    return (
        ended
        .join(qd, "file_quarter", "inner")
        .withColumn("optional_start_id", F.when(same_day, F.col("_st_slot_id")).otherwise(F.col("_st_clock_id")))
        .withColumn("optional_end_id", F.when(same_day, F.col("_en_slot_id")).otherwise(F.col("_en_clock_id")))
        .select(*SESSION_COLUMNS)
    )
