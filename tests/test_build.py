"""The quarterly build and release-day publish jobs, end to end on stored tables."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SF_SMALL
from tests.tiny import Q, QDATE, individual, listen, person, report, weight, world
from waveband.operators import append_quarter, pending_quarters, read_table, register_next_quarter, write_replacing
from waveband.plans.build import OUTPUTS, build, control_version, publish_outputs, read_control, write_control
from waveband.plans.stages import Run
from waveband.sources.fixture import survey_fixture
from waveband.sources.tables import read_survey_tables, write_survey_tables


def _bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_build_writes_outputs_and_is_rerunnable(spark, scratch):
    write_survey_tables(survey_fixture(spark, SF_SMALL), f"{scratch}/in")
    tables = read_survey_tables(spark, f"{scratch}/in")
    pending_before = pending_quarters(tables.quarters)

    result = build(spark, tables, f"{scratch}/out")
    assert result.registered == ["2001q3"]
    assert result.pending == sorted(pending_before + ["2001q3"])

    # stored outputs equal the lazily computed ones for the same quarters
    control = append_quarter(
        tables.quarters, register_next_quarter(tables.weights, tables.date_lookup, tables.quarters)
    )
    expected = Run(tables.replace(quarters=control), result.pending)
    for name, df in {
        "summary_table_1": expected.demographic_summary(),
        "summary_table_2": expected.slot_summary(),
        "second_summary": expected.sessions,
        "population": expected.population,
    }.items():
        stored = read_table(spark, f"{scratch}/out/{name}", *OUTPUTS[name])
        assert _bag(stored) == _bag(df)

    # control flipped last, as a new version
    new_control = read_control(spark, f"{scratch}/out/quarters")
    flags = {r.file_quarter: r.in_data for r in new_control.collect()}
    assert all(flags[q] == "Yes" for q in result.report_quarters)
    assert result.control_version == 1

    # rerunning the same quarters replaces them: same content, no duplicates
    first = _bag(read_table(spark, f"{scratch}/out/summary_table_1", *OUTPUTS["summary_table_1"]))
    build(spark, tables, f"{scratch}/out", register=True)
    again = _bag(read_table(spark, f"{scratch}/out/summary_table_1", *OUTPUTS["summary_table_1"]))
    assert first == again

    # publish copies every quarter and keeps reporting-only quarters
    publish_outputs(spark, f"{scratch}/out", f"{scratch}/rep")
    rep = read_table(spark, f"{scratch}/rep/summary_table_1", *OUTPUTS["summary_table_1"])
    assert _bag(rep) == first


def _stored(spark, root, name):
    return read_table(spark, f"{root}/{name}", *OUTPUTS[name])


def _two_quarters(spark):
    later = "2020q2"
    return world(
        spark,
        listening=[listen(person(1), 30, 1), listen(person(1), 30, 2, quarter=later)],
        individuals=[individual(person(1)), individual(person(1), quarter=later)],
        weights=[weight(person(1), 1.0), weight(person(1), 1.0, quarter=later)],
        replist=[report(), report(quarter=later)],
        tsa=[(Q, 1, 1), (later, 1, 1)], postal=[(Q, 100, 1), (later, 100, 1)],
        quarters=[(Q, "No", QDATE), (later, "No", QDATE)],
    )


def test_strict_failure_leaves_the_outputs_unchanged(spark, scratch):
    tables = _two_quarters(spark)
    with pytest.raises(ValueError, match="more than one quarter"):
        build(spark, tables, f"{scratch}/out", register=False, strict=True)
    assert not any(os.path.exists(f"{scratch}/out/{name}") for name in OUTPUTS)
    build(spark, tables, f"{scratch}/out", register=False)
    before = {name: _bag(_stored(spark, f"{scratch}/out", name)) for name in OUTPUTS}
    assert all(before.values())
    with pytest.raises(ValueError, match="more than one quarter"):
        build(spark, tables, f"{scratch}/out", register=False, strict=True)
    assert before == {name: _bag(_stored(spark, f"{scratch}/out", name)) for name in OUTPUTS}


def test_history_gets_the_new_station_names(spark, scratch):
    out = f"{scratch}/out"
    tables = _two_quarters(spark)
    build(spark, tables, out, register=False)
    for name in ("summary_table_1", "summary_table_2"):
        old = _stored(spark, out, name).where("quarter = '2020q1'").replace({"Test FM": "1Xtra from the BBC"}, subset=["station"])
        history = old.replace({"2020q1": "2019q4"}, subset=["quarter"])
        write_replacing(spark, history, f"{out}/{name}", "quarter", ["2019q4"], OUTPUTS[name][1])
    only_later = tables.replace(quarters=spark.createDataFrame([(Q, "Yes", QDATE), ("2020q2", "No", QDATE)], tables.quarters.schema))
    build(spark, only_later, out, register=False)
    for name in ("summary_table_1", "summary_table_2"):
        stations = {(r.quarter, r.station) for r in _stored(spark, out, name).select("quarter", "station").distinct().collect()}
        assert stations == {("2019q4", "BBC Radio 1Xtra"), ("2020q1", "Test FM"), ("2020q2", "Test FM")}


def test_quarter_with_reports_and_no_listening(spark, scratch):
    out = f"{scratch}/out"
    people = {"individuals": [individual(person(1))], "weights": [weight(person(1), 1.0)]}
    build(spark, world(spark, listening=[listen(person(1), 30, 1)], **people), out, register=False)
    summary = _bag(_stored(spark, out, "summary_table_1"))
    assert summary and _stored(spark, out, "second_summary").count() == 1
    build(spark, world(spark, **people), out, register=False)
    # sessions go and the population is replaced, by the reports' quarters; the summaries stay
    assert _stored(spark, out, "second_summary").count() == 0
    assert _stored(spark, out, "population").count() == 1
    assert _bag(_stored(spark, out, "summary_table_1")) == summary


def test_first_load_without_listening_can_be_published(spark, scratch):
    tables = world(spark, individuals=[individual(person(1))], weights=[weight(person(1), 1.0)])
    build(spark, tables, f"{scratch}/out", register=False)
    copied = publish_outputs(spark, f"{scratch}/out", f"{scratch}/rep")
    assert copied == {"summary_table_1": [], "summary_table_2": [], "population": [Q]}
    assert _stored(spark, f"{scratch}/rep", "population").count() == 1


def test_control_table_versions(spark, scratch):
    path = f"{scratch}/quarters"
    assert read_control(spark, path) is None and control_version(spark, path) == 0
    control = spark.createDataFrame([(Q, "No", QDATE)], "file_quarter string, in_data string, quarter_date date")
    assert write_control(spark, control, path) == 1
    assert write_control(spark, read_control(spark, path).replace({"No": "Yes"}), path) == 2
    assert [tuple(r) for r in read_control(spark, path).collect()] == [(Q, "Yes", QDATE)]
    with open(f"{scratch}/_releases/0000000002.json", "w") as file:
        file.write("damaged")
    with pytest.raises(ValueError):  # a damaged file is no missing table
        read_control(spark, path).collect()


def test_queries_work_in_a_later_session(spark):
    """Nothing of a query outlives it: no cached table, no list of the process."""
    run = Run(survey_fixture(spark, SF_SMALL), ["1998q1"])
    assert run.demographic_summary().count() > 0
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_control_table_is_broadcast_to_the_outputs(spark, scratch, monkeypatch):
    """Dealt by quarter for a join with the control table, one task would hold all of a quarter's rows."""
    from waveband.plans import build as jobs

    plans, written = {}, jobs._written

    def seen(session, new, out_root, name, *more):
        plans[name] = new._jdf.queryExecution().executedPlan().toString()
        return written(session, new, out_root, name, *more)

    monkeypatch.setattr(jobs, "_written", seen)
    build(spark, _two_quarters(spark), f"{scratch}/out", register=False)
    assert set(plans) == set(OUTPUTS)
    for text in plans.values():
        assert "BroadcastHashJoin [file_quarter" in text and "SortMergeJoin [file_quarter" not in text, text
