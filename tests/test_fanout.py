"""Lookups with repeated keys are reported by the build that they multiplied rows in."""

from __future__ import annotations

import pytest

from tests.test_build import _bag, _stored, _two_quarters
from tests.tiny import Q, QDATE, individual, listen, person, weight, world
from waveband.operators.fanout import FanOut, JoinCounts, repeated_keys
from waveband.plans.build import backfill, build
from waveband.schemas import INPUT_SCHEMAS

HOUSEHOLDS, SLOTS = INPUT_SCHEMAS[list(INPUT_SCHEMAS)[7]], INPUT_SCHEMAS[list(INPUT_SCHEMAS)[10]]


def _row(schema, **values):
    defaults = {"string": "x", "int": 1, "bigint": 1, "double": 1.0, "date": QDATE}
    return tuple(values.get(f.name, defaults[f.dataType.simpleString()]) for f in schema.fields)


def _world(spark, households=(), slots=(), quarters=None, n=4):
    return world(
        spark, listening=[listen(person(i), 30, i) for i in range(1, n + 1)], individuals=[individual(person(i)) for i in range(1, n + 1)],
        weights=[weight(person(i), 1.0) for i in range(1, n + 1)], households=households, slots=slots, quarters=quarters)


def _household(i, **values):
    return _row(HOUSEHOLDS, file_quarter=Q, hhid=person(i)[:-2], **values)


def test_unique_lookups_are_not_reported(spark, scratch):
    households = [_household(i) for i in range(1, 5)]
    slots = [_row(SLOTS, slot_time=t) for t in ("10:00", "10:15")]
    assert build(spark, _world(spark, households, slots), f"{scratch}/out", register=False).fan_outs == {}


def test_repeated_keys_are_reported_with_what_they_did(spark, scratch):
    households = [_household(i) for i in range(1, 5)] + [_household(1, household_social_grade="y"), _household(2, household_social_grade="z")]
    # 10:00 starts the four sessions of the four people, two of whom have two households; 10:15 ends them
    slots = [_row(SLOTS, slot_time="10:00", slot_id=k) for k in (1, 2, 3)] + [_row(SLOTS, slot_time="10:15")]
    quarters = [(Q, "No", QDATE), (Q, "No", QDATE)]
    found = build(spark, _world(spark, households, slots, quarters), f"{scratch}/out", register=False).fan_outs
    assert found == {"households": [FanOut(4, 6, 2)], "slots (start)": [FanOut(6, 18, 1)], "control": [FanOut(1, 2, 1)]}


def test_a_build_without_rows_reports_nothing(spark, scratch):
    found = build(spark, world(spark), f"{scratch}/out", register=False)
    assert found.fan_outs == {} and _bag(_stored(spark, f"{scratch}/out", "second_summary")) == []


def test_a_backfill_reports_each_step(spark, scratch):
    tables = _two_quarters(spark)
    slots = spark.createDataFrame([_row(SLOTS, slot_time="10:15", slot_id=k) for k in (1, 2)], SLOTS)
    loaded = spark.createDataFrame([(Q, "Yes", QDATE), ("2020q2", "Yes", QDATE)], tables.quarters.schema)
    found = backfill(spark, tables.replace(slots=slots, quarters=loaded), f"{scratch}/out", step=1).fan_outs
    assert found == {"slots (end)": [FanOut(1, 2, 1)] * 2}


@pytest.mark.parametrize("n", [0, 1, 50])
def test_counts_cost_no_job_of_their_own(spark, scratch, n):
    counts = JoinCounts()
    rows = counts.counted(spark.range(n), "all")
    rows.write.parquet(f"{scratch}/rows")
    assert counts.rows("all") == n and counts.fan_out("all", "all", rows, ["id"]) is None


def test_null_keys_are_no_repeats(spark):
    lookup = spark.createDataFrame([(None, "a"), (None, "a"), ("x", "a"), ("x", "a"), ("y", "b")], "k string, v string")
    assert repeated_keys(lookup, ["k"]) == 1 and repeated_keys(lookup, ["k", "v"]) == 1
