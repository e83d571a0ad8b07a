
from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from waveband.plans.registry import fixture_run

KEYS = ["quarter", "station", "reporting_period", "bbc_or_commercial"]


@pytest.fixture(scope="module")
def summary(spark):
    return fixture_run(spark, SF_SMALL).demographic_summary().toPandas()


@pytest.fixture(scope="module")
def slots(spark):
    return fixture_run(spark, SF_SMALL).slot_summary().toPandas()


def test_minutes_between_zero_and_sixty(summary, slots):
    for df in (summary, slots):
        assert df.numerical_minutes_account.between(0, 60).all()
        assert (df.hours >= df.numerical_hours_account * df.accounts - 1e-6).all()


def test_a15_reach_within_a10_reach(summary):
    adults = summary[summary.demographic_type.str.startswith("All Adults")]
    wide = adults.pivot_table(index=KEYS, columns="age_break", values="accounts", dropna=False).fillna(0)
    assert (wide["A15+"] <= wide["A10+"] + 1e-9).all()


@pytest.mark.parametrize("cut", ["Gender", "Age", "Regions", "Social Grade"])
def test_person_cuts_add_up_to_all_adults(summary, cut):
    # one sex, age, region and grade per person in the fixture, so each cut partitions All Adults
    for band in ("A15+", "A10+"):
        part = summary[(summary.demographic_type == cut) & (summary.age_break == band)]
        total = summary[(summary.demographic_type == f"All Adults {band}")]
        got = part.groupby(KEYS, dropna=False)[["accounts", "hours", "respondents"]].sum()
        want = total.groupby(KEYS, dropna=False)[["accounts", "hours", "respondents"]].sum()
        assert got.index.equals(want.index) or sorted(got.index) == sorted(want.index)
        diff = (got.sort_index() - want.sort_index()).abs()
        assert (diff.accounts < 1e-6).all() and (diff.hours < 1e-6).all() and (diff.respondents == 0).all()


def test_any_digital_within_all_adults(summary):
    anyd = summary[summary.demographic == "Any Digital"].set_index(KEYS + ["age_break"]).respondents
    adults = summary[summary.demographic_type.str.startswith("All Adults")].set_index(KEYS + ["age_break"]).respondents
    joined = anyd.to_frame("d").join(adults.to_frame("a"), how="left")
    assert (joined.d <= joined.a).all()


def test_single_pass_equals_two_aggregates(spark, summary):
    from waveband.operators.summaries import demographic_summary

    run = fixture_run(spark, SF_SMALL)
    two = demographic_summary(run.person_time, run.person_platform_time).toPandas()
    cols = sorted(summary.columns)
    key = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False)))
    assert key(two) == key(summary)
