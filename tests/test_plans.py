"""Physical-plan properties: no Cartesian products or Python UDFs, semi/anti joins,
scan pruning, and a single large shuffle for the enriched diary rows."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SF_SMALL
from waveband.plans.registry import fixture_run
from waveband.sources.tables import read_survey_tables, write_survey_tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def run(spark):
    return fixture_run(spark, SF_SMALL)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("survey"))
    write_survey_tables(fixture_run(spark, SF_SMALL).tables, root)
    return read_survey_tables(spark, root)


def test_no_cartesian_or_python(run):
    for df in (run.facts, run.sessions, run.demographic_summary(), run.slot_summary(), run.population):
        text = plan_of(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_registration_uses_anti_join(spark):
    from waveband.operators import register_next_quarter

    t = fixture_run(spark, SF_SMALL).tables
    assert "LeftAnti" in optimized_of(register_next_quarter(t.weights, t.date_lookup, t.quarters))


def test_pending_scope_prunes_partitions(stored):
    from waveband.operators import pending_quarters, stage_listening

    pending = pending_quarters(stored.quarters)
    text = plan_of(stage_listening(stored.listening, pending))
    assert re.search(r"PartitionFilters: \[[^\]]*file_quarter#\d+ (INSET|IN \()", text), text


def test_scan_reads_only_used_columns(stored):
    from waveband.operators import pending_quarters, stage_weights

    text = plan_of(stage_weights(stored.weights, pending_quarters(stored.quarters)))
    assert "PushedFilters: [IsNotNull(weight)]" in text


def test_diary_rows_meet_people_in_one_shuffle(stored, spark):
    from waveband.operators import pending_quarters
    from waveband.plans.stages import Run

    run = Run(stored, pending_quarters(stored.quarters))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are too large for it
    try:
        text = plan_of(run.facts)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the diary is scanned once, and is shuffled to the people on (respid, file_quarter) before anything else
    assert text.count("row_id") and len(re.findall(r"FileScan parquet \[[^\]]*row_id", text)) == 1, text
    assert re.search(r"Exchange hashpartitioning\(respid#\d+, file_quarter#\d+", text), text


def test_no_task_gathers_a_whole_side(stored, spark):
    from waveband.operators import pending_quarters
    from waveband.plans.stages import Run

    run = Run(stored, pending_quarters(stored.quarters))
    for df in (run.facts, run.sessions, run.demographic_summary(), run.slot_summary(), run.population):
        assert "SinglePartition" not in plan_of(df)


def test_no_job_runs_before_an_action(stored, spark):
    from waveband.operators import pending_quarters
    from waveband.plans.stages import Run

    pending = pending_quarters(stored.quarters)
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "queries that are only made")
    try:
        run = Run(stored, pending)
        made = [run.facts, run.sessions, run.demographic_summary(), run.slot_summary(), run.population]
        assert made and not sc.statusTracker().getJobIdsForGroup("lazy")
    finally:
        sc._jsc.clearJobGroup()


def test_summary_moves_the_facts_once_and_no_exploded_rows(stored, spark, scratch):
    from waveband.operators import counted_facts, pending_quarters
    from waveband.plans.stages import Run
    from waveband.sources.stored import handed_over

    pending = pending_quarters(stored.quarters)
    counted = handed_over(counted_facts(Run(stored, pending).base), "facts", "file_quarter")
    run = Run(stored, pending, counted_override=counted)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan_of(run.demographic_summary())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2, text
    # from the top: the reduced groups, then the facts below both generators
    assert "demographic_type" in exchanges[0] and "respid" in exchanges[1] and "Generate" not in text[text.index(exchanges[1]):]
    scan = next(line for line in text.split("\n") if "FileScan parquet" in line and "respid" in line)
    assert "row_id" not in scan and "hhmm_start" not in scan
