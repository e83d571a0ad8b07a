"""Survey-shaped tables derived from the TPC-H-style test tables.

No survey data is public, so the build is exercised on tables that Spark derives
from ``orders``, ``lineitem``, ``customer``, ``nation`` and ``region``. The
derived tables grow with the source tables: diary rows come from line items,
respondents from the (customer, quarter) pairs that have orders. Every step is a
join, aggregate or generator (``explode``) - no cross joins.

The same derivation is written in SQL in :mod:`waveband.sources.fixture_sql`
for the DuckDB oracle; the two must stay identical.

Shape (27 quarters, 1995q1-2001q3):

* control table: every quarter but the last; 1995q1-1997q4 loaded, 1998q1-2001q2
  pending, so the next quarter to register is 2001q3;
* a customer is a respondent; two customers share a household (the respondent
  id starts with the 16-digit household id); some respondents have no
  individual record, NULL or zero weights, NULL age, no household, or a
  household without region or grade;
* 24 stations in 6 reports per quarter, one station excluded by source, two
  stations on platforms that map to "Unknown", one report without a name;
* 25 sample points, three of them in two segments (fan-out);
* a few diary rows repeated with the same row id;
* one pending quarter (1999q2) that has reports and people but no diary rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waveband.schemas import INPUT_SCHEMAS
from waveband.session import size_shuffles
from waveband.sources.tables import SurveyTables

# ---- fixed values of the derived fixture -----------------------------------
FIRST_PENDING_QUARTER = "1998q1"
LAST_REGISTERED_QUARTER = "2001q2"
SILENT_QUARTER = "1999q2"
REPORTING_PERIODS = ["H", "Q", "Y"]
REPORT_NAMES = {
    0: "BBC Radio 2",
    1: "1Xtra from the BBC",
    2: "BBC Radio 5 live sports extra",
    3: "Absolute Radio",
    4: "Radio bbc Local",
}
STATIONS = 24
SLOTS_PER_DAY = 96


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file_quarter(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("q"), F.quarter(ts).cast("string"))


def _hhmm(k: Column) -> Column:
    """Clock time 'HH:MM' of broadcast-day slot k (slot 0 starts at 04:00)."""
    hour = (F.lit(4) + (k - k % 4) / 4).cast("int") % 24
    minute = F.lit(15) * (k % 4)
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0"))


def _slot_hour(k: Column) -> Column:
    return (F.lit(4) + (k - k % 4) / 4).cast("int") % 24


def _hhid(custkey: Column) -> Column:
    return F.lpad((custkey - custkey % 2).cast("string"), 16, "0")


def _respid(custkey: Column) -> Column:
    return F.concat(_hhid(custkey), F.lit("0"), (F.lit(1) + custkey % 2).cast("string"))


def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = INPUT_SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def survey_fixture(spark: SparkSession, sf_dir: str) -> SurveyTables:
    size_shuffles(spark, *(f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem", "customer")))
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", _file_quarter(F.col("o_orderdate")).alias("file_quarter")
    )
    lineitem = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")

    week = F.to_date(F.date_trunc("week", F.col("o_orderdate")))
    # nation (25 rows) and region (5 rows) have fixed sizes in the TPC-H schema
    # at every scale factor, so broadcasting them needs no run-time check.

    # control table and calendar
    quarters = (
        orders.groupBy("file_quarter")
        .agg(F.min(week).alias("quarter_date"))
        .filter(F.col("file_quarter") <= LAST_REGISTERED_QUARTER)
        .withColumn("in_data", F.when(F.col("file_quarter") < FIRST_PENDING_QUARTER, "Yes").otherwise("No"))
    )
    date_lookup = orders.select(
        F.replace(F.col("file_quarter"), F.lit("q"), F.lit(" Q")).alias("quarter"), week.alias("week_beginning")
    ).distinct()

    # respondents: (customer, quarter) pairs with orders
    surveyed = (
        orders.select(F.col("o_custkey").alias("c_custkey"), "file_quarter").distinct()
        .join(customer, "c_custkey", "inner")
    )
    c = F.col("c_custkey")
    age = F.when(c % 41 == 0, F.lit(None)).otherwise(F.lit(8) + c % 80).cast("int")
    individuals = surveyed.filter(c % 23 != 0).select(
        "file_quarter",
        _respid(c).alias("respid"),
        F.col("c_nationkey").alias("sample_point"),
        F.when(age >= 15, 1).otherwise(0).alias("age_15plus"),
        F.when(c % 3 == 0, "Male").otherwise("Female").alias("sex"),
        age.alias("age"),
    )
    weight = (
        F.when(c % 17 == 0, F.lit(None))
        .when(c % 13 == 0, F.lit(0.0))
        .otherwise((F.lit(1) + c % 16).cast("double") / 8)
    )
    weights = surveyed.select(
        "file_quarter",
        _respid(c).alias("respid"),
        F.explode(F.array(*[F.lit(p) for p in REPORTING_PERIODS])).alias("reporting_period"),
        weight.alias("weight"),
    )
    hh_num = (c - c % 2).alias("hh_num")
    grade = F.col("hh_num") % 14
    households = (
        surveyed.select("file_quarter", hh_num).distinct()
        .filter(F.col("hh_num") % 10 != 0)
        .join(F.broadcast(region), F.col("r_regionkey") * 2 == F.col("hh_num") % 12, "left")
        .select(
            "file_quarter",
            F.lpad(F.col("hh_num").cast("string"), 16, "0").alias("hhid"),
            F.col("r_name").alias("bbc_regions"),
            F.when(grade == 0, "A").when(grade == 2, "B").when(grade == 4, "C1")
            .when(grade == 6, "C2").when(grade == 8, "D").when(grade == 10, "E").alias("household_social_grade"),
        )
    )

    # diary rows
    diary = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    k = (F.col("l_partkey") + F.col("l_orderkey")) % SLOTS_PER_DAY
    repeat = F.when((F.col("l_orderkey") % 50 == 0) & (F.col("l_linenumber") == 1), 2).otherwise(1)
    listening = diary.where(F.col("file_quarter") != SILENT_QUARTER).select(
        "file_quarter",
        _respid(F.col("o_custkey")).alias("respid"),
        (F.lit(1) + F.col("l_orderkey") % 7).alias("dayofweek"),
        F.concat(F.lit("S"), (F.col("l_partkey") % STATIONS).cast("string")).alias("station_code"),
        F.col("l_returnflag").alias("location"),
        F.col("l_linestatus").alias("code"),
        F.col("l_linenumber").alias("value"),
        _hhmm(k).alias("hhmm_start"),
        F.when(k == SLOTS_PER_DAY - 1, F.lit("28:00")).otherwise(_hhmm(k + 1)).alias("hhmm_end"),
        (F.lit(1) + F.col("l_linenumber") % 3).alias("n_occasions"),
        F.col("l_quantity").cast("int").alias("mins"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.explode(F.sequence(F.lit(1), repeat)).alias("_copy"),
    )

    slot_k = (F.col("l_partkey") % SLOTS_PER_DAY).alias("k")
    slots = lineitem.select(slot_k).distinct().select(
        _hhmm(F.col("k")).alias("slot_time"),
        _slot_hour(F.col("k")).alias("slot_hour"),
        (F.col("k") + 1).alias("slot_id"),
        (F.lit(1) + (F.col("k") + 16) % SLOTS_PER_DAY).alias("clock_slot_id"),
    )

    # report list: every (quarter, station) with diary rows
    s = F.col("s")
    report_name = None
    for rid, name in REPORT_NAMES.items():
        cond = s % 6 == rid
        report_name = F.when(cond, F.lit(name)) if report_name is None else report_name.when(cond, F.lit(name))
    platform = (
        F.when(s == 11, "dtv").when(s == 17, "other_a").when(s == 5, "other_b")
        .when(s < 6, "dab").when(s < 12, "amfm").when(s < 18, "online").otherwise("smartsp")
    )
    replist = diary.select("file_quarter", (F.col("l_partkey") % STATIONS).alias("s")).distinct().select(
        "file_quarter",
        (s % 6).alias("report_id"),
        report_name.alias("report_name"),
        F.concat(F.lit("S"), s.cast("string")).alias("station_code"),
        F.when(s % 3 == 0, "Q").when(s % 3 == 1, "H").otherwise("Y").alias("reporting_period"),
        platform.alias("platform_name"),
        (s % 2).alias("ooa_type"),
        F.when(s == STATIONS - 1, 2).otherwise(1).alias("source"),
    )
    report_keys = replist.select("file_quarter", F.col("report_id").cast("int").alias("report_id")).distinct()
    tsa = report_keys.select(
        "file_quarter", "report_id", F.explode(F.array(*[F.lit(i) for i in range(5)])).alias("segment")
    ).filter((F.col("report_id") + F.col("segment")) % 3 != 0)
    segs = (
        tsa.join(replist.select("file_quarter", F.col("report_id").cast("int").alias("report_id"), "station_code"),
                 ["file_quarter", "report_id"], "inner")
        .select("file_quarter", "segment", "station_code")
        .distinct()
    )
    second = F.when(F.col("n_nationkey") % 12 == 0, (F.col("n_regionkey") + 1) % 5)
    postal_sector = (
        surveyed.select("file_quarter", "c_nationkey").distinct()
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            "file_quarter",
            F.col("c_nationkey").alias("sample_point"),
            F.explode(F.filter(F.array(F.col("n_regionkey"), second), lambda x: x.isNotNull())).alias("segment"),
        )
    )

    return SurveyTables(
        replist=_conform(replist, "replist"),
        tsa=_conform(tsa, "tsa"),
        segs=_conform(segs, "segs"),
        postal_sector=_conform(postal_sector, "postal_sector"),
        listening=_conform(listening, "listening"),
        individuals=_conform(individuals, "individuals"),
        weights=_conform(weights, "weights"),
        households=_conform(households, "households"),
        quarters=_conform(quarters, "quarters"),
        date_lookup=_conform(date_lookup, "date_lookup"),
        slots=_conform(slots, "slots"),
    )
