"""Tables bucketed by respondent: the same results, no exchange of the diary, and another way for a hot respondent."""

from __future__ import annotations

from contextlib import contextmanager

import pytest

from tests.conftest import SF_SMALL
from tests.test_plans import plan_of
from tests.test_skew import skewed_world
from waveband.operators import pending_quarters
from waveband.operators import read_table
from waveband.operators.control import listed_quarters
from waveband.plans.__main__ import main
from waveband.plans.build import OUTPUTS, build
from waveband.plans.stages import Run
from waveband.sources.bucketed import BUCKETED, _NAMES, _table, bucket_sizes, read_bucketed_tables, write_bucketed_tables
from waveband.sources.fixture import survey_fixture
from waveband.sources.tables import write_survey_tables


def _bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@contextmanager
def settings(spark, **conf):
    named = {f"spark.sql.{k}": v for k, v in conf.items()} | {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k, None) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucketed"))
    plain = survey_fixture(spark, SF_SMALL)
    write_bucketed_tables(plain, root, buckets=6)
    return root, plain


def test_results_are_those_of_the_plain_tables(spark, stored):
    root, plain = stored
    with settings(spark):
        tables = read_bucketed_tables(spark, root)
        pending = pending_quarters(plain.quarters)
        got, want = Run(tables, pending), Run(plain, pending)
        assert _bag(got.facts) == _bag(want.facts) and _bag(got.population) == _bag(want.population)
        assert _bag(got.demographic_summary()) == _bag(want.demographic_summary())
        assert listed_quarters(tables.weights) == listed_quarters(plain.weights)


def test_a_later_session_finds_the_buckets_again(spark, stored):
    root, plain = stored
    for field in BUCKETED:
        spark.sql(f"DROP TABLE {_table(root, _NAMES[field])}")
    with settings(spark, **{"adaptive.enabled": "false", "autoBroadcastJoinThreshold": "-1"}):
        tables = read_bucketed_tables(spark, root)
        assert tables.listening.count() == plain.listening.count()
        assert "Bucketed: true" in plan_of(Run(tables, ["1998q1"]).listening_with_people)


@pytest.mark.parametrize("adaptive", ["false", "true"])
def test_the_diary_is_joined_where_it_lies(spark, stored, adaptive):
    root, plain = stored
    with settings(spark, **{"adaptive.enabled": adaptive, "autoBroadcastJoinThreshold": "-1"}):  # as with tables that are too large for it
        run = Run(read_bucketed_tables(spark, root), pending_quarters(plain.quarters))
        # diary and individuals: distinct and join without any exchange
        text = plan_of(run.listening_with_people)
        assert text.count("SortMergeJoin") == 1 and "Exchange" not in text, text
        # weights and individuals: the only exchange is that of the grouped population
        joined = run.weights.join(run.individuals, ["respid", "file_quarter"])
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
        # people who come by their households' key are moved to the diary's buckets, the diary stays
        text = plan_of(run.listening.join(run.people, ["respid", "file_quarter"]))
        diary = text.index("row_id", text.index("FileScan"))
        above = [line for line in text[:diary].split("\n") if "Exchange" in line]
        assert not above, text


def test_a_hot_respondent_is_read_without_buckets(spark, scratch):
    plain = skewed_world(spark)
    write_bucketed_tables(plain, scratch, buckets=8, files_per_bucket=3)
    conf = {"adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "adaptive.skewJoin.skewedPartitionFactor": "2"}
    sizes = bucket_sizes(spark, f"{scratch}/{_NAMES['listening']}-by-respid").collect()
    assert len(sizes) == 8 and all(r["bucket"] in range(8) and r["bytes"] > 0 for r in sizes)
    with settings(spark, **conf):
        tables = read_bucketed_tables(spark, scratch)
        assert "Bucketed: true" not in plan_of(tables.listening.groupBy("respid").count())
        assert "Bucketed: true" in plan_of(tables.individuals.groupBy("respid").count())
        pending = pending_quarters(plain.quarters)
        assert _bag(Run(tables, pending).facts) == _bag(Run(plain, pending).facts)


def test_the_commands_build_the_same_outputs(spark, scratch):
    plain = survey_fixture(spark, SF_SMALL)
    quarters = plain.quarters.where("in_data <> 'No'").unionByName(plain.quarters.where("in_data = 'No'").orderBy("file_quarter").limit(1))
    plain = plain.replace(quarters=quarters)
    write_survey_tables(plain, f"{scratch}/plain")
    with settings(spark):
        main(["bucket", "--tables", f"{scratch}/plain", "--out", f"{scratch}/in", "--buckets", "3"])
        main(["build", "--tables", f"{scratch}/in", "--bucketed", "--no-register", "--out", f"{scratch}/out"])
    build(spark, plain, f"{scratch}/want", register=False)
    for name, (key, schema) in OUTPUTS.items():
        got, want = (_bag(read_table(spark, f"{scratch}/{root}/{name}", key, schema)) for root in ("out", "want"))
        assert got == want and got
