"""A respondent holding a third of all diary rows is split over several join tasks
(AQE's skew join), and the results equal those computed without the split."""

from __future__ import annotations


from tests.tiny import individual, listen, person, weight, world
from waveband.operators import pending_quarters
from waveband.plans.stages import Run

HOT_ROWS = 6000
COLD_PEOPLE = 400
COLD_ROWS_EACH = 30  # 12000 cold rows: the hot respondent holds a third


def skewed_world(spark):
    hot = person(0)
    people = [person(i) for i in range(1, COLD_PEOPLE + 1)]
    rows = [listen(hot, 1 + i % 50, i) for i in range(HOT_ROWS)]
    rid = HOT_ROWS
    for p in people:
        for j in range(COLD_ROWS_EACH):
            rows.append(listen(p, 1 + j, rid))
            rid += 1
    everyone = [hot] + people
    return world(
        spark,
        listening=rows,
        individuals=[individual(p) for p in everyone],
        weights=[weight(p, 1.0 + (i % 8) / 8) for i, p in enumerate(everyone)],
    )


def _bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_hot_respondent_is_split_and_results_are_whole(spark):
    t = skewed_world(spark)
    pending = pending_quarters(t.quarters)
    expected_facts = _bag(Run(t, pending).facts)
    expected_summary = _bag(Run(t, pending).demographic_summary())
    conf = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",  # keep the shuffle join
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        base = Run(t, pending).base
        got_base = base.count()
        joined = base.select("respid", "mins")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got_facts = _bag(Run(t, pending).facts)
        got_summary = _bag(Run(t, pending).demographic_summary())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    assert "skew=true" in plan, plan
    assert got_base == HOT_ROWS + COLD_PEOPLE * COLD_ROWS_EACH == len(got_facts)
    assert got_facts == expected_facts
    assert got_summary == expected_summary
