"""One DataFrame per operator, over the survey fixture derived from a test-data folder.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Apart from the list of
pending quarters, which is read first, they are lazy; ``publish_stored`` and
``build_not_pending`` run a job that stores tables, and return what it stored. The
queries that put a run's rows into those of an earlier load hand the enriched diary rows
over first, as the build does, so that both loads read them instead of joining anew. All of
them read the whole derived tables; the run's scope is the control table's pending
quarters (14 of 27 fixture quarters), as in a production run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveband.operators import (
    counted_facts,
    mark_loaded,
    pending_quarters,
    publish,
    read_table,
    register_next_quarter,
    registered_quarters,
    relabel_history,
    replace_partitions,
    scope_quarters,
    write_replacing,
)
from waveband.plans.build import build, publish_outputs
from waveband.plans.stages import Run
from waveband.schemas import SUMMARY_1, SUMMARY_2
from waveband.session import ensure_checkpoint_dir
from waveband.sources.fixture import SILENT_QUARTER, survey_fixture
from waveband.sources.stored import handed_over
from waveband.sources.tables import SurveyTables

Query = Callable[[SparkSession, str], DataFrame]


def fixture_run(spark: SparkSession, sf_dir: str, mode: str = "pending") -> Run:
    tables = survey_fixture(spark, sf_dir)
    return Run(tables, pending_quarters(tables.quarters), mode)


def _tables(spark: SparkSession, sf_dir: str) -> SurveyTables:
    return survey_fixture(spark, sf_dir)


def _stale_run(run: Run) -> Run:
    """Every registered quarter, as an earlier load would have left it (no relabel)."""
    return Run(run.tables, registered_quarters(run.tables.quarters), "pending")


def _two_loads(spark: SparkSession, sf_dir: str, *lookups: str) -> tuple[Run, Run]:
    """The pending run and the earlier load, both on the enriched diary rows of the registered quarters, handed over once.

    Every stage is scoped and joined by quarter, so a run's rows are those of the larger run for its quarters. The
    small tables (and ``lookups``) are handed over too, so that joins with them are planned by their size.
    """
    tables = _tables(spark, sf_dir)
    tables = tables.replace(**{name: handed_over(getattr(tables, name), name) for name in ("quarters", "replist", *lookups)})
    run = Run(tables, pending_quarters(tables.quarters))
    stale = _stale_run(run)
    people, metadata = handed_over(stale.people, "people"), handed_over(stale.metadata, "metadata")
    enriched = Run(tables, stale.quarters, people_override=people, metadata_override=metadata)
    counted = handed_over(counted_facts(enriched.base), "facts")
    return Run(tables, run.quarters, counted_override=scope_quarters(counted, run.quarters)), Run(tables, stale.quarters, counted_override=counted)


def q_register_next_quarter(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return register_next_quarter(t.weights, t.date_lookup, t.quarters)


def q_scope_pending(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return scope_quarters(t.weights, pending_quarters(t.quarters), "pending")


def q_scope_not_pending(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return scope_quarters(t.listening, pending_quarters(t.quarters), "not_pending")


def q_replace_partitions(spark, sf_dir):
    run, stale = _two_loads(spark, sf_dir)
    target = stale.demographic_summary(relabel=False)
    touched = run.facts.select(F.col("file_quarter").alias("quarter"))
    return replace_partitions(target, run.demographic_summary(), "quarter", touched)


def q_publish_summary(spark, sf_dir):
    run, stale = _two_loads(spark, sf_dir)
    reporting = stale.demographic_summary(relabel=False)
    return publish(run.demographic_summary(), reporting, "quarter")


def q_publish_slot_summary(spark, sf_dir):
    run, stale = _two_loads(spark, sf_dir)
    reporting = stale.slot_summary(relabel=False)
    return publish(run.slot_summary(), reporting, "quarter")


def q_publish_population(spark, sf_dir):
    run = fixture_run(spark, sf_dir)
    return publish(run.population, _stale_run(run).population, "file_quarter")


def q_relabel_history(spark, sf_dir):
    run, stale = _two_loads(spark, sf_dir)
    stored = stale.demographic_summary(relabel=False)
    return relabel_history(stored, run.demographic_summary(), run.facts.select(F.col("file_quarter").alias("quarter")))


def q_relabel_slot_history(spark, sf_dir):
    run, stale = _two_loads(spark, sf_dir)
    stored = stale.slot_summary(relabel=False)
    return relabel_history(stored, run.slot_summary(), run.facts.select(F.col("file_quarter").alias("quarter")))


def _left_over(stale: DataFrame) -> DataFrame:
    """An earlier load's rows, also for the quarter that now has reports but no diary rows."""
    silent = stale.where("file_quarter = '1999q1'").withColumn("file_quarter", F.lit(SILENT_QUARTER))
    return stale.unionByName(silent)


def q_replace_sessions(spark, sf_dir):
    run, stale = _two_loads(spark, sf_dir, "slots")
    return replace_partitions(_left_over(stale.sessions), run.sessions, "file_quarter", run.reports)


def q_replace_population(spark, sf_dir):
    run = fixture_run(spark, sf_dir)
    return replace_partitions(_left_over(_stale_run(run).population), run.population, "file_quarter", run.reports)


def _root(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_publish_stored(spark, sf_dir):
    """Stored tables: an earlier load in the reporting area, then the new build's table read back and published."""
    (run, stale), name = _two_loads(spark, sf_dir), "summary_table_2"
    src, dst = _root(spark, "built"), _root(spark, "reporting")
    for root, df in ((src, run.slot_summary()), (dst, stale.slot_summary(relabel=False))):
        write_replacing(spark, df, f"{root}/{name}", "quarter", [], SUMMARY_2)
    publish_outputs(spark, src, dst, [name])
    return read_table(spark, f"{dst}/{name}", "quarter", SUMMARY_2)


def q_build_not_pending(spark, sf_dir):
    """The build job over every quarter that isn't pending; its stored summary."""
    root = _root(spark, "backfill")
    build(spark, _tables(spark, sf_dir), root, mode="not_pending", register=False)
    return read_table(spark, f"{root}/summary_table_1", "quarter", SUMMARY_1)


def _run_query(fn: Callable[[Run], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixture_run(spark, sf_dir))

    return query


QUERIES: dict[str, Query] = {
    "register_next_quarter": q_register_next_quarter,
    "scope_pending": q_scope_pending,
    "scope_not_pending": q_scope_not_pending,
    "stage_reports": _run_query(lambda r: r.reports),
    "stage_tsa": _run_query(lambda r: r.tsa),
    "stage_segs": _run_query(lambda r: r.segs),
    "stage_postal": _run_query(lambda r: r.postal),
    "stage_individuals": _run_query(lambda r: r.individuals),
    "stage_weights": _run_query(lambda r: r.weights),
    "stage_listening": _run_query(lambda r: r.listening),
    "report_segments": _run_query(lambda r: r.report_segments),
    "station_metadata": _run_query(lambda r: r.metadata),
    "listening_with_people": _run_query(lambda r: r.listening_with_people),
    "listening_facts": _run_query(lambda r: r.facts),
    "person_time": _run_query(lambda r: r.person_time_output()),
    "person_platform_time": _run_query(lambda r: r.person_platform_time_output()),
    "cut_all_adults": _run_query(lambda r: r.cut("all_adults")),
    "cut_age": _run_query(lambda r: r.cut("age")),
    "cut_gender": _run_query(lambda r: r.cut("gender")),
    "cut_region": _run_query(lambda r: r.cut("region")),
    "cut_social_grade": _run_query(lambda r: r.cut("social_grade")),
    "cut_platform": _run_query(lambda r: r.cut("platform")),
    "demographic_summary": _run_query(lambda r: r.demographic_summary()),
    "slot_summary": _run_query(lambda r: r.slot_summary()),
    "session_facts": _run_query(lambda r: r.sessions),
    "population_summary": _run_query(lambda r: r.population),
    "mark_loaded": _run_query(lambda r: mark_loaded(r.tables.quarters, r.reports)),
    "replace_partitions": q_replace_partitions,
    "relabel_history": q_relabel_history,
    "relabel_slot_history": q_relabel_slot_history,
    "replace_sessions": q_replace_sessions,
    "replace_population": q_replace_population,
    "publish_stored": q_publish_stored,
    "build_not_pending": q_build_not_pending,
    "publish_summary": q_publish_summary,
    "publish_slot_summary": q_publish_slot_summary,
    "publish_population": q_publish_population,
}
