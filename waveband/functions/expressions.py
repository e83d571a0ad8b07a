"""Scalar column expressions of the survey pipeline.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the published survey outputs) -------------------
# Age bands: (label, lowest age, highest age); None means open-ended.
AGE_BANDS = [
    ("U15", None, 14),
    ("15-24", 15, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55-64", 55, 64),
    ("65+", 65, None),
]
# Social grade groups.
GRADE_GROUPS = [("ABC1", ["A", "B", "C1"]), ("C2DE", ["C2", "D", "E"])]
GRADE_OTHER = "Unknown"
# Platform codes and their published labels; any other code (or NULL) is "Unknown".
PLATFORM_LABELS = [
    ("smartsp", "Smart Speaker"),
    ("amfm", "AM/FM"),
    ("dtv", "DTV"),
    ("online", "Internet"),
    ("dab", "DAB"),
    ("anydigital", "Any Digital"),
]
PLATFORM_OTHER = "Unknown"
# Platforms pooled into the synthetic "anydigital" platform.
DIGITAL_PLATFORMS = ["smartsp", "dtv", "dab", "online"]
ANY_DIGITAL = "anydigital"
# Station names renamed in the published summaries (old name, new name).
STATION_RELABELS = [
    ("1Xtra from the BBC", "BBC Radio 1Xtra"),
    ("BBC Radio 5 live sports extra", "BBC Radio 5 Sports Extra"),
]
# Report names matching this case-insensitive pattern are BBC stations.
BBC_PATTERN = "%bbc%"
# The broadcast day ends at 28:00, which is 04:00 on the clock.
BROADCAST_DAY_END = ("28:00", "04:00")
# A respondent id starts with the 16-character household id.
HOUSEHOLD_ID_LENGTH = 16
# Survey weights are stored in thousands of people.
WEIGHT_SCALE = 1000


def _name(col: str) -> str:
    if not isinstance(col, str):
        raise TypeError("pass a column name")
    return f"`{col}`"


def quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def case(branches: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """One SQL CASE expression: a single parse instead of one JVM call per branch."""
    body = " ".join(f"WHEN {cond} THEN {value}" for cond, value in branches)
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return F.expr(f"CASE {body}{tail} END")


def ownership(report_name: str = "report_name") -> Column:
    """'BBC' when the report name contains "bbc" in any case, else 'Commercial' (NULL too)."""
    return case([(f"{_name(report_name)} ILIKE {quote(BBC_PATTERN)}", "'BBC'")], "'Commercial'")


def age_band(age: str = "age") -> Column:
    """Published age band; NULL for a NULL age (the CASE has no ELSE)."""
    col = _name(age)
    branches = []
    for label, lo, hi in AGE_BANDS:
        if lo is None:
            cond = f"{col} < {hi + 1}"
        elif hi is None:
            cond = f"{col} > {lo - 1}"
        else:
            cond = f"{col} BETWEEN {lo} AND {hi}"
        branches.append((cond, quote(label)))
    return case(branches)


def social_grade(grade: str = "household_social_grade") -> Column:
    """ABC1 / C2DE, everything else (including NULL) 'Unknown'."""
    col = _name(grade)
    branches = [(f"{col} IN ({', '.join(map(quote, members))})", quote(label)) for label, members in GRADE_GROUPS]
    return case(branches, quote(GRADE_OTHER))


def platform_label(platform: str = "platform_name") -> Column:
    """Published platform label; unknown codes and NULL become 'Unknown'."""
    col = _name(platform)
    return case([(f"{col} = {quote(code)}", quote(label)) for code, label in PLATFORM_LABELS],
                 quote(PLATFORM_OTHER))


def relabel_station(station: str = "station") -> Column:
    """Rename the stations listed in :data:`STATION_RELABELS`; others unchanged."""
    col = _name(station)
    return case([(f"{col} = {quote(old)}", quote(new)) for old, new in STATION_RELABELS], col)


def broadcast_day_end(hhmm: str = "hhmm_end") -> Column:
    """Map the broadcast-day end '28:00' to the clock time '04:00'."""
    late, clock = BROADCAST_DAY_END
    col = _name(hhmm)
    return case([(f"{col} = {quote(late)}", quote(clock))], col)


def slot_label(start: str = "hhmm_start", end: str = "hhmm_end") -> Column:
    """'HH:MM - HH:MM'; NULL when either end is NULL."""
    return F.concat(F.col(start), F.lit(" - "), F.col(end))


def household_id(respid: str = "respid") -> Column:
    """The household id: the first 16 characters of the respondent id."""
    return F.substring(F.col(respid), 1, HOUSEHOLD_ID_LENGTH)


def date_lookup_quarter(file_quarter: str = "file_quarter") -> Column:
    """'2020q1' -> '2020 Q1', the quarter key of the week calendar."""
    return F.replace(F.col(file_quarter), F.lit("q"), F.lit(" Q"))
