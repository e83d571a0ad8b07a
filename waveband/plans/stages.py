"""Composition of the operators into the stages of one quarterly run.

:class:`Run` holds the staged (scoped, de-duplicated) tables of a run and builds
every intermediate lazily from them. Both the batch job (:mod:`.build`) and the
per-operator query registry (:mod:`.registry`) use it, so a query and the job
compute the same plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveband.operators import (
    expand_copies,
    diary_base,
    listening_facts,
    listening_with_people,
    person_attributes,
    person_platform_time,
    person_slot_time,
    person_time,
    population_summary,
    report_segments,
    scope_quarters,
    session_facts,
    stage_individuals,
    stage_listening,
    stage_postal,
    stage_reports,
    stage_segs,
    stage_tsa,
    stage_weights,
    station_metadata,
)
from waveband.operators.fanout import JoinCounts
from waveband.operators.summaries import (
    PERSON_CUTS,
    cut_summary,
    person_rows_all,
    single_pass_summary,
    slot_summary,
)
from waveband.sources.tables import SurveyTables


@dataclass
class Run:
    """One run over ``quarters`` (``mode='pending'``) or over all other quarters (``'not_pending'``)."""

    tables: SurveyTables
    quarters: list[str]
    mode: str = "pending"
    # handed over by the build as stored tables
    metadata_override: DataFrame | None = field(default=None, repr=False)
    people_override: DataFrame | None = field(default=None, repr=False)
    counted_override: DataFrame | None = field(default=None, repr=False)
    # where the build counts rows around lookup joins
    counts: JoinCounts | None = field(default=None, repr=False)

    # ---- staging -------------------------------------------------------------
    @cached_property
    def reports(self) -> DataFrame:
        return stage_reports(self.tables.replist, self.quarters, self.mode)

    @cached_property
    def tsa(self) -> DataFrame:
        return stage_tsa(self.tables.tsa, self.quarters, self.mode)

    @cached_property
    def segs(self) -> DataFrame:
        return stage_segs(self.tables.segs, self.quarters, self.mode)

    @cached_property
    def postal(self) -> DataFrame:
        return stage_postal(self.tables.postal_sector, self.quarters, self.mode)

    @cached_property
    def listening(self) -> DataFrame:
        return stage_listening(self.tables.listening, self.quarters, self.mode)

    @cached_property
    def individuals(self) -> DataFrame:
        return stage_individuals(self.tables.individuals, self.quarters, self.mode)

    @cached_property
    def weights(self) -> DataFrame:
        return stage_weights(self.tables.weights, self.quarters, self.mode)

    @cached_property
    def households(self) -> DataFrame:
        # the household lookup matches on quarter, so scoping it first is exact
        return scope_quarters(self.tables.households, self.quarters, self.mode)

    @cached_property
    def control(self) -> DataFrame:
        return scope_quarters(self.tables.quarters, self.quarters, self.mode)

    # ---- enrichment ----------------------------------------------------------
    @cached_property
    def report_segments(self) -> DataFrame:
        return report_segments(self.reports, self.tsa)

    @cached_property
    def metadata(self) -> DataFrame:
        if self.metadata_override is not None:
            return self.metadata_override
        return station_metadata(self.reports, self.report_segments, self.postal)

    @cached_property
    def listening_with_people(self) -> DataFrame:
        return listening_with_people(self.listening, self.individuals)

    @cached_property
    def people(self) -> DataFrame:
        if self.people_override is not None:
            return self.people_override
        return person_attributes(self.individuals, self.weights, self.households, self.counts)

    @cached_property
    def base(self) -> DataFrame:
        return diary_base(self.listening, self.people, self.metadata, self.reports)

    @cached_property
    def facts(self) -> DataFrame:
        if self.counted_override is not None:
            return self.counted_override.drop("copies")
        return listening_facts(self.base)

    @cached_property
    def sessions(self) -> DataFrame:
        base = expand_copies(self.counted_override) if self.counted_override is not None else self.base
        return session_facts(base, self.tables.slots, self.control, self.counts)

    # ---- summaries -----------------------------------------------------------
    @cached_property
    def person_time(self) -> DataFrame:
        return person_time(self.facts, self.control)

    @cached_property
    def person_platform_time(self) -> DataFrame:
        return person_platform_time(self.facts, self.control)

    @cached_property
    def person_slot_time(self) -> DataFrame:
        return person_slot_time(self.facts, self.control)

    def cut(self, name: str, relabel: bool = False) -> DataFrame:
        if name == "platform":
            return cut_summary(self.person_platform_time, ["platform"], relabel)
        return cut_summary(self.person_time, [name], relabel)

    @cached_property
    def person_rows_all(self) -> DataFrame:
        return person_rows_all(self.facts, self.control)

    def demographic_summary(self, relabel: bool = True) -> DataFrame:
        """Summary table 1 in one pass over the facts (see :func:`single_pass_summary`)."""
        return single_pass_summary(self.person_rows_all, relabel)

    def slot_summary(self, relabel: bool = True) -> DataFrame:
        return slot_summary(self.person_slot_time, relabel)

    @cached_property
    def population(self) -> DataFrame:
        return population_summary(self.weights, self.individuals, self.control)

    def person_time_output(self) -> DataFrame:
        """Person-level minutes as published columns (quarter, ..., minutes, time_spent)."""
        return (
            self.person_time.withColumnRenamed("file_quarter", "quarter")
            .withColumn("time_spent", F.col("minutes") / F.lit(60.0))
        )

    def person_platform_time_output(self) -> DataFrame:
        return (
            self.person_platform_time.drop("pooled")
            .withColumnRenamed("file_quarter", "quarter")
            .withColumn("time_spent", F.col("minutes") / F.lit(60.0))
        )


__all__ = ["Run", "PERSON_CUTS"]
