"""Published summaries: reach and hours by demographic, by time slot, and population.

All listening summaries aggregate in two steps, as the original does:

1. **person level** - minutes per respondent and reporting key (weight is a key,
   so each person's weight counts once per station and period, never once per
   diary row);
2. **group level** - exact ``count(distinct respid)``, ``sum(weight)`` and
   weighted hours per published cut.

The original writes every cut and age band as its own UNION ALL branch (12
branches re-reading the person-level CTE). Here one pass over the facts emits
both person-level kinds (:func:`person_rows_all`), one generator turns each
person row into its (band, cut) rows and **one** aggregate computes all of them
(:func:`single_pass_summary`). The facts are shuffled once, on :data:`CLUSTER`:
these columns are part of the person keys and of (group keys, respid), so the
person aggregate and the distinct step both run inside that partitioning and the
exploded rows are never shuffled; only rows reduced by group are, at the end. A
respondent's or a station's rows are spread by the other columns of the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveband.functions.expressions import (
    ANY_DIGITAL,
    DIGITAL_PLATFORMS,
    STATION_RELABELS,
    age_band,
    case,
    platform_label,
    quote,
    relabel_station,
    slot_label,
    social_grade,
)
from waveband.functions.measures import reach_aggregates, reach_measures
from waveband.operators.writes import replace_partitions
from waveband.schemas import POPULATION_COLUMNS, SUMMARY_1_COLUMNS, SUMMARY_2_COLUMNS

# ---- fixed values (must equal the published survey outputs) -------------------
# Age breaks: label and minimum age.
AGE_BREAKS = [("A15+", 15), ("A10+", 10)]
# "All Adults" cut: demographic_type and demographic per age break.
ALL_ADULTS_LABELS = {
    "A15+": ("All Adults A15+", "Adults A15+"),
    "A10+": ("All Adults A10+", "Adults A10+"),
}
# demographic_type of the other cuts.
CUT_TYPES = {
    "age": "Age",
    "gender": "Gender",
    "region": "Regions",
    "social_grade": "Social Grade",
    "platform": "Platform",
}
PERSON_CUTS = ["all_adults", "age", "gender", "region", "social_grade"]
# The slot summary's person base only keeps respondents aged 10 and over.
SLOT_MIN_AGE = 10
# Population: weight_a15 sums the unscaled weights of respondents aged 15+.
POPULATION_A15_AGE = 15

PERSON_KEYS = [
    "file_quarter", "report_name", "reporting_period", "bbc_or_commercial", "age", "sex",
    "bbc_regions", "household_social_grade", "respid", "weight", "quarter_date",
]
PLATFORM_PERSON_KEYS = [
    "file_quarter", "report_name", "reporting_period", "bbc_or_commercial", "age", "respid",
    "platform_name", "pooled", "weight", "quarter_date",
]
SLOT_PERSON_KEYS = [
    "file_quarter", "report_name", "bbc_or_commercial", "reporting_period", "respid", "dayofweek",
    "hhmm_start", "hhmm_end", "weight", "age", "quarter_date",
]
# what the facts are clustered by: common to the person keys and to (group keys, respid)
CLUSTER = ["file_quarter", "report_name", "reporting_period", "bbc_or_commercial", "respid", "quarter_date"]
GROUP_KEYS = [
    "file_quarter", "demographic_type", "demographic", "age_break", "report_name",
    "reporting_period", "bbc_or_commercial", "quarter_date",
]


def with_quarter_date(facts: DataFrame, control: DataFrame) -> DataFrame:
    """Attach the quarter's first week from the control table (inner join)."""
    qd = control.select("file_quarter", "quarter_date")
    return facts.join(qd, "file_quarter", "inner")


def _minutes() -> Column:
    return F.sum("mins").cast("long").alias("minutes")


def person_time(facts: DataFrame, control: DataFrame) -> DataFrame:
    """Minutes per respondent, report, period, age, sex, region, grade and weight (weight > 0)."""
    base = with_quarter_date(facts, control).filter(F.col("weight") > 0)
    return base.groupBy(*PERSON_KEYS).agg(_minutes())


def person_platform_time(facts: DataFrame, control: DataFrame) -> DataFrame:
    """Minutes per respondent and platform, plus the pooled 'anydigital' platform.

    Each row of a digital platform is emitted a second time under
    ``anydigital`` before the person aggregate, so a person listening on DAB
    and online counts once in "Any Digital". ``pooled`` marks the synthetic rows
    so that a raw platform literally named 'anydigital' stays a separate row.
    """
    base = with_quarter_date(facts, control).filter(F.col("weight") > 0)
    own = F.struct(F.col("platform_name").alias("platform_name"), F.lit(False).alias("pooled"))
    pooled = F.when(
        F.col("platform_name").isin(DIGITAL_PLATFORMS),
        F.struct(F.lit(ANY_DIGITAL).alias("platform_name"), F.lit(True).alias("pooled")),
    )
    keep = [c for c in base.columns if c != "platform_name"]
    expanded = base.select(*keep, F.explode(F.array(own, pooled)).alias("_p")).filter(F.col("_p").isNotNull())
    expanded = expanded.select(*keep, "_p.platform_name", "_p.pooled")
    return expanded.groupBy(*PLATFORM_PERSON_KEYS).agg(_minutes())


def person_slot_time(facts: DataFrame, control: DataFrame) -> DataFrame:
    """Minutes per respondent, station, day and slot (weight > 0, age >= 10)."""
    base = with_quarter_date(facts, control).filter((F.col("weight") > 0) & (F.col("age") >= SLOT_MIN_AGE))
    return base.groupBy(*SLOT_PERSON_KEYS).agg(_minutes())


def _age_breaks(df: DataFrame) -> DataFrame:
    """One row per age break the person qualifies for (none for a NULL age)."""
    breaks = F.array(*[F.when(F.col("age") >= lo, F.lit(label)) for label, lo in AGE_BREAKS])
    return df.select("*", F.explode(breaks).alias("age_break")).filter(F.col("age_break").isNotNull())


def _cut(kind: str) -> Column:
    if kind == "all_adults":
        dtype = case([(f"age_break = {quote(b)}", quote(t)) for b, (t, _) in ALL_ADULTS_LABELS.items()])
        label = case([(f"age_break = {quote(b)}", quote(d)) for b, (_, d) in ALL_ADULTS_LABELS.items()])
        return F.struct(dtype.alias("demographic_type"), label.alias("demographic"))
    values = {
        "age": age_band("age"),
        "gender": F.col("sex"),
        "region": F.col("bbc_regions"),
        "social_grade": social_grade("household_social_grade"),
        "platform": platform_label("platform_name"),
    }
    return F.struct(F.lit(CUT_TYPES[kind]).alias("demographic_type"), values[kind].cast("string").alias("demographic"))


def _publish(grouped: DataFrame, columns: list[str], relabel: bool) -> DataFrame:
    """Measures, published names (quarter, station), relabelled stations, column order."""
    station = relabel_station("report_name") if relabel else F.col("report_name")
    names = {"quarter": F.col("file_quarter"), "station": station}
    out = reach_measures(grouped)
    return out.select(*[names[c].alias(c) if c in names else F.col(c) for c in columns])


def cut_summary(person_rows: DataFrame, cuts: list[str], relabel: bool = False) -> DataFrame:
    """Reach and hours for the given cuts and both age breaks, in one aggregate.

    ``person_rows`` is :func:`person_time` for the person cuts, or
    :func:`person_platform_time` for ``["platform"]``.
    """
    rows = _age_breaks(person_rows)
    cut_rows = rows.select("*", F.inline(F.array(*[_cut(c) for c in cuts])))
    grouped = cut_rows.groupBy(*GROUP_KEYS).agg(*reach_aggregates())
    return _publish(grouped, SUMMARY_1_COLUMNS, relabel)


def demographic_summary(person: DataFrame, person_platform: DataFrame, relabel: bool = True) -> DataFrame:
    """Summary table 1 from separate person and person-platform rows (two aggregates)."""
    people = cut_summary(person, PERSON_CUTS, relabel)
    platforms = cut_summary(person_platform, ["platform"], relabel)
    return people.unionByName(platforms)


ALL_PERSON_KEYS = [
    "file_quarter", "report_name", "reporting_period", "bbc_or_commercial", "age", "respid", "weight",
    "quarter_date", "kind", "sex", "bbc_regions", "household_social_grade", "platform_name", "pooled",
]


def person_rows_all(facts: DataFrame, control: DataFrame) -> DataFrame:
    """Person-level minutes of both kinds from **one** pass over the facts.

    Each fact row is emitted as a ``person`` row (keyed by sex, region and
    grade; no platform) and as a ``platform`` row (keyed by platform; no sex,
    region or grade), plus a pooled ``anydigital`` row for digital platforms.
    Grouping by all keys then gives exactly :func:`person_time` (kind
    ``person``) and :func:`person_platform_time` (kind ``platform``).
    """
    base = with_quarter_date(facts, control).filter(F.col("weight") > 0)
    none = F.lit(None).cast("string")
    person = F.struct(
        F.lit("person").alias("kind"), F.col("sex").alias("sex"), F.col("bbc_regions").alias("bbc_regions"),
        F.col("household_social_grade").alias("household_social_grade"), none.alias("platform_name"),
        F.lit(None).cast("boolean").alias("pooled"),
    )
    own = F.struct(
        F.lit("platform").alias("kind"), none.alias("sex"), none.alias("bbc_regions"),
        none.alias("household_social_grade"), F.col("platform_name").alias("platform_name"),
        F.lit(False).alias("pooled"),
    )
    pooled = F.when(F.col("platform_name").isin(DIGITAL_PLATFORMS), F.struct(
        F.lit("platform").alias("kind"), none.alias("sex"), none.alias("bbc_regions"),
        none.alias("household_social_grade"), F.lit(ANY_DIGITAL).alias("platform_name"),
        F.lit(True).alias("pooled"),
    ))
    common = ["file_quarter", "report_name", "reporting_period", "bbc_or_commercial", "age", "respid",
              "weight", "quarter_date", "mins"]
    used = [*common, "sex", "bbc_regions", "household_social_grade", "platform_name"]
    base = base.select(*used).repartition(*CLUSTER)
    rows = base.select(*common, F.explode(F.array(person, own, pooled)).alias("_k")).filter(F.col("_k").isNotNull())
    rows = rows.select(*common, "_k.*")
    return rows.groupBy(*ALL_PERSON_KEYS).agg(_minutes())


def single_pass_summary(person_rows: DataFrame, relabel: bool = True) -> DataFrame:
    """Summary table 1 from :func:`person_rows_all` with one generator and one aggregate."""
    rows = _age_breaks(person_rows)
    is_person = F.col("kind") == "person"
    cuts = [F.when(is_person, _cut(c)) for c in PERSON_CUTS] + [F.when(~is_person, _cut("platform"))]
    cut_rows = rows.select("*", F.explode(F.array(*cuts)).alias("_c")).filter(F.col("_c").isNotNull())
    cut_rows = cut_rows.select("*", "_c.demographic_type", "_c.demographic")
    grouped = cut_rows.groupBy(*GROUP_KEYS).agg(*reach_aggregates())
    return _publish(grouped, SUMMARY_1_COLUMNS, relabel)


def slot_summary(person_slot: DataFrame, relabel: bool = True) -> DataFrame:
    """Summary table 2: reach and hours by station, day of week and time slot."""
    rows = _age_breaks(person_slot)
    keys = ["file_quarter", "bbc_or_commercial", "reporting_period", "report_name", "dayofweek",
            slot_label("hhmm_start", "hhmm_end").alias("slot"), "age_break", "quarter_date"]
    grouped = rows.groupBy(*keys).agg(*reach_aggregates(with_respondents=False))
    return _publish(grouped, SUMMARY_2_COLUMNS, relabel)


def relabel_stations(df: DataFrame, column: str = "station") -> DataFrame:
    """Rename stations in an already aggregated table (applied after aggregation)."""
    return df.withColumn(column, relabel_station(column).alias(column)).select(*df.columns)


def old_names(df: DataFrame, column: str = "station") -> DataFrame:
    """The rows whose station still has an old name; a list of names, so that files without them are skipped by their statistics."""
    return df.where(F.col(column).isin([old for old, new in STATION_RELABELS if old != new]))


def relabel_history(stored: DataFrame, new: DataFrame, touched: DataFrame, key: str = "quarter") -> DataFrame:
    """The whole summary table after a load: the touched quarters are replaced, then every row is relabelled.

    The original renames the stations of the whole table, so earlier quarters get the new names too.
    """
    return relabel_stations(replace_partitions(stored, new, key, touched))


def population_summary(weights: DataFrame, individuals: DataFrame, control: DataFrame) -> DataFrame:
    """Weighted population by quarter, reporting period and age.

    Zero weights are kept (only NULL weights were dropped at staging); a person
    with two individual rows counts their weight twice, as the original join
    does. ``weight_a15`` is not scaled by 1000 and is NULL when no one is 15+.
    """
    w = weights.select("file_quarter", "respid", "reporting_period", "weight")
    i = individuals.select("file_quarter", "respid", "age")
    qd = control.select("file_quarter", "quarter_date")
    joined = w.join(i, ["respid", "file_quarter"], "inner").join(qd, "file_quarter", "inner")
    grouped = joined.groupBy("file_quarter", "reporting_period", "age", "quarter_date").agg(
        F.countDistinct("respid").alias("sample_size"),
        (F.sum("weight") * F.lit(1000)).alias("weight_total"),
        F.sum(F.when(F.col("age") >= POPULATION_A15_AGE, F.col("weight"))).alias("weight_a15"),
    )
    return grouped.select(*POPULATION_COLUMNS)
