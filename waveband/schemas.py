"""Table schemas of the survey data model and the column order of every output.

The source tables have no published DDL; the types below follow how each column
is used (compared with integers, concatenated, summed, joined). Outputs are
written positionally by the original load, so their column order is part of the
contract and every writer selects these lists before writing. The lists of columns
are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# ---- inputs -----------------------------------------------------------------

REPLIST = _struct(
    ("file_quarter", S), ("report_id", I), ("report_name", S), ("station_code", S),
    ("reporting_period", S), ("platform_name", S), ("ooa_type", I), ("source", I),
)
TSA = _struct(("file_quarter", S), ("report_id", I), ("segment", I))
SEGS = _struct(("file_quarter", S), ("segment", I), ("station_code", S))
POSTAL_SECTOR = _struct(("file_quarter", S), ("sample_point", I), ("segment", I))
LISTENING = _struct(
    ("file_quarter", S), ("respid", S), ("dayofweek", I), ("station_code", S),
    ("location", S), ("code", S), ("value", I), ("hhmm_start", S), ("hhmm_end", S),
    ("n_occasions", I), ("mins", I), ("row_id", L),
)
INDIVIDUALS = _struct(
    ("file_quarter", S), ("respid", S), ("sample_point", I), ("age_15plus", I),
    ("sex", S), ("age", I),
)
WEIGHTS = _struct(("file_quarter", S), ("respid", S), ("reporting_period", S), ("weight", D))
HOUSEHOLDS = _struct(
    ("file_quarter", S), ("hhid", S), ("bbc_regions", S), ("household_social_grade", S),
)
QUARTERS = _struct(("file_quarter", S), ("in_data", S), ("quarter_date", DT))
DATE_LOOKUP = _struct(("quarter", S), ("week_beginning", DT))
SLOTS = _struct(("slot_time", S), ("slot_hour", I), ("slot_id", I), ("clock_slot_id", I))

INPUT_SCHEMAS: dict[str, T.StructType] = {
    "replist": REPLIST,
    "tsa": TSA,
    "segs": SEGS,
    "postal_sector": POSTAL_SECTOR,
    "listening": LISTENING,
    "individuals": INDIVIDUALS,
    "weights": WEIGHTS,
    "households": HOUSEHOLDS,
    "quarters": QUARTERS,
    "date_lookup": DATE_LOOKUP,
    "slots": SLOTS,
}

# ---- staged and output column orders ------------------------------------------

REPORT_COLUMNS = [
    "file_quarter", "report_id", "report_name", "station_code", "reporting_period",
    "bbc_or_commercial", "platform_name", "ooa_type",
]

METADATA_COLUMNS = [
    "file_quarter", "report_id", "report_name", "station_code", "reporting_period",
    "bbc_or_commercial", "platform_name", "segment", "sample_point",
]

# listening facts (first summary), 25 columns
FACT_COLUMNS = [
    "file_quarter", "respid", "dayofweek", "station_code", "location", "code", "sex", "age",
    "value", "hhmm_start", "hhmm_end", "n_occasions", "mins", "row_id", "age_15plus",
    "report_id", "report_name", "reporting_period", "segment", "sample_point",
    "bbc_or_commercial", "platform_name", "weight", "bbc_regions", "household_social_grade",
]

# respondent sessions (second summary), 28 columns
SESSION_COLUMNS = FACT_COLUMNS + ["optional_start_id", "optional_end_id", "quarter_date"]

MEASURE_COLUMNS = [
    "accounts", "hours", "time_per_account", "numerical_hours_account", "numerical_minutes_account",
]

# reach and hours by demographic (summary table 1), 14 columns
SUMMARY_1_COLUMNS = [
    "quarter", "demographic_type", "demographic", "age_break", "station", "reporting_period",
    "bbc_or_commercial", "quarter_date", "respondents",
] + MEASURE_COLUMNS

# reach and hours by day and slot (summary table 2), 13 columns
SUMMARY_2_COLUMNS = [
    "quarter", "bbc_or_commercial", "reporting_period", "station", "dayofweek", "slot",
    "age_break", "quarter_date",
] + MEASURE_COLUMNS

# weighted population, 7 columns
POPULATION_COLUMNS = [
    "file_quarter", "reporting_period", "age", "quarter_date", "sample_size", "weight_total",
    "weight_a15",
]

# ---- output schemas, for reading stored outputs (also empty ones) ---------------

_MEASURES = [(name, D) for name in MEASURE_COLUMNS]
SUMMARY_1 = _struct(
    ("quarter", S), ("demographic_type", S), ("demographic", S), ("age_break", S), ("station", S), ("reporting_period", S),
    ("bbc_or_commercial", S), ("quarter_date", DT), ("respondents", L), *_MEASURES,
)
SUMMARY_2 = _struct(
    ("quarter", S), ("bbc_or_commercial", S), ("reporting_period", S), ("station", S), ("dayofweek", I), ("slot", S),
    ("age_break", S), ("quarter_date", DT), *_MEASURES,
)
POPULATION = _struct(
    ("file_quarter", S), ("reporting_period", S), ("age", I), ("quarter_date", DT), ("sample_size", L), ("weight_total", D), ("weight_a15", D),
)
_TYPES = {f.name: f.dataType for table in (REPLIST, LISTENING, INDIVIDUALS, POSTAL_SECTOR, WEIGHTS, HOUSEHOLDS) for f in table}
SESSIONS = _struct(
    *((name, _TYPES.get(name, S)) for name in FACT_COLUMNS), ("optional_start_id", I), ("optional_end_id", I), ("quarter_date", DT),
)
