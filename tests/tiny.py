"""Hand-made survey worlds for edge-case tests.

Defaults: quarter ``2020q1`` pending, report 1 "Test FM" (station S, period Q,
platform dab) on segment 1, sample point 100, every person aged 30, female.
"""

from __future__ import annotations

import datetime as dt

from waveband.schemas import INPUT_SCHEMAS
from waveband.sources.tables import SurveyTables

Q = "2020q1"
QDATE = dt.date(2020, 1, 6)


def person(i: int) -> str:
    return f"{i:016d}01"


def listen(respid: str, mins: int, row_id: int, station: str = "S", start: str = "10:00",
           end: str | None = "10:15", day: int = 1, quarter: str = Q):
    return (quarter, respid, day, station, "L", "C", 1, start, end, 1, mins, row_id)


def individual(respid: str, age: int | None = 30, sex: str = "Female", sample_point: int = 100,
               quarter: str = Q):
    return (quarter, respid, sample_point, 1 if (age or 0) >= 15 else 0, sex, age)


def weight(respid: str, w: float | None, period: str = "Q", quarter: str = Q):
    return (quarter, respid, period, w)


def report(station: str = "S", name: str | None = "Test FM", platform: str | None = "dab",
           report_id: int = 1, period: str = "Q", source: int = 1, quarter: str = Q):
    return (quarter, report_id, name, station, period, platform, 0, source)


def world(spark, listening=(), individuals=(), weights=(), replist=None, tsa=None, postal=None,
          households=(), quarters=None, date_lookup=None, slots=(), segs=None) -> SurveyTables:
    replist = [report()] if replist is None else replist
    tsa = [(Q, 1, 1)] if tsa is None else tsa
    postal = [(Q, 100, 1)] if postal is None else postal
    segs = [(Q, 1, "S")] if segs is None else segs
    quarters = [(Q, "No", QDATE)] if quarters is None else quarters
    date_lookup = [("2020 Q1", QDATE)] if date_lookup is None else date_lookup
    data = {
        "replist": replist, "tsa": tsa, "segs": segs, "postal_sector": postal,
        "listening": listening, "individuals": individuals, "weights": weights,
        "households": households, "quarters": quarters, "date_lookup": date_lookup, "slots": slots,
    }
    frames = [spark.createDataFrame(list(data[name]), INPUT_SCHEMAS[name]) for name in INPUT_SCHEMAS]
    return SurveyTables(*frames)
