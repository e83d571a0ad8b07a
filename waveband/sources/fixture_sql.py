"""The fixture derivation of :mod:`waveband.sources.fixture` as SQL CTEs.

Used by the DuckDB oracle (``oracle_sql`` in ``__spark_entry__.py``) over the
raw test tables ``orders lineitem customer nation region``. The CTE names are
the survey table names; a query is ``WITH <FIXTURE_CTES>, ... SELECT ...``.
The CTEs are ``MATERIALIZED``: DuckDB 2.0 raises an internal error
("dict-surviving cache") on some plans when they are inlined.
Keep this text and the DataFrame derivation in step.
"""

from __future__ import annotations

from waveband.sources.fixture import FIRST_PENDING_QUARTER, LAST_REGISTERED_QUARTER, SILENT_QUARTER


def _hhmm(k: str) -> str:
    return (
        f"lpad(cast(cast(4 + ({k} - {k} % 4) / 4 as integer) % 24 as varchar), 2, '0') || ':' || "
        f"lpad(cast(15 * ({k} % 4) as varchar), 2, '0')"
    )


def _respid(c: str) -> str:
    return f"lpad(cast({c} - {c} % 2 as varchar), 16, '0') || '0' || cast(1 + {c} % 2 as varchar)"


FIXTURE_CTES = f"""
fx_orders AS MATERIALIZED (
  SELECT o_orderkey, o_custkey, o_orderdate,
         cast(year(o_orderdate) as varchar) || 'q' || cast(quarter(o_orderdate) as varchar) AS file_quarter
  FROM orders
),
quarters AS MATERIALIZED (
  SELECT file_quarter,
         CASE WHEN file_quarter < '{FIRST_PENDING_QUARTER}' THEN 'Yes' ELSE 'No' END AS in_data,
         min(cast(date_trunc('week', o_orderdate) as date)) AS quarter_date
  FROM fx_orders WHERE file_quarter <= '{LAST_REGISTERED_QUARTER}' GROUP BY file_quarter
),
date_lookup AS MATERIALIZED (
  SELECT DISTINCT replace(file_quarter, 'q', ' Q') AS quarter,
         cast(date_trunc('week', o_orderdate) as date) AS week_beginning
  FROM fx_orders
),
fx_surveyed AS MATERIALIZED (
  SELECT s.c_custkey, s.file_quarter, c.c_nationkey
  FROM (SELECT DISTINCT o_custkey AS c_custkey, file_quarter FROM fx_orders) s
  JOIN customer c ON c.c_custkey = s.c_custkey
),
individuals AS MATERIALIZED (
  SELECT file_quarter, {_respid('c_custkey')} AS respid, cast(c_nationkey as integer) AS sample_point,
         CASE WHEN age >= 15 THEN 1 ELSE 0 END AS age_15plus,
         CASE WHEN c_custkey % 3 = 0 THEN 'Male' ELSE 'Female' END AS sex,
         age
  FROM (SELECT *, CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE cast(8 + c_custkey % 80 as integer) END AS age
        FROM fx_surveyed) z
  WHERE c_custkey % 23 <> 0
),
weights AS MATERIALIZED (
  SELECT file_quarter, {_respid('c_custkey')} AS respid, unnest(['H', 'Q', 'Y']) AS reporting_period,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN cast(0 as double)
              ELSE cast(1 + c_custkey % 16 as double) / 8 END AS weight
  FROM fx_surveyed
),
households AS MATERIALIZED (
  SELECT h.file_quarter, lpad(cast(h.hh_num as varchar), 16, '0') AS hhid, r.r_name AS bbc_regions,
         CASE h.hh_num % 14 WHEN 0 THEN 'A' WHEN 2 THEN 'B' WHEN 4 THEN 'C1' WHEN 6 THEN 'C2'
              WHEN 8 THEN 'D' WHEN 10 THEN 'E' END AS household_social_grade
  FROM (SELECT DISTINCT file_quarter, c_custkey - c_custkey % 2 AS hh_num FROM fx_surveyed) h
  LEFT JOIN region r ON r.r_regionkey * 2 = h.hh_num % 12
  WHERE h.hh_num % 10 <> 0
),
fx_diary AS MATERIALIZED (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_returnflag, l.l_linestatus,
         o.o_custkey, o.file_quarter, (l.l_partkey + l.l_orderkey) % 96 AS k
  FROM lineitem l JOIN fx_orders o ON l.l_orderkey = o.o_orderkey
),
listening AS MATERIALIZED (
  SELECT file_quarter, {_respid('o_custkey')} AS respid,
         cast(1 + l_orderkey % 7 as integer) AS dayofweek,
         'S' || cast(l_partkey % 24 as varchar) AS station_code,
         l_returnflag AS location, l_linestatus AS code, cast(l_linenumber as integer) AS value,
         {_hhmm('k')} AS hhmm_start,
         CASE WHEN k = 95 THEN '28:00' ELSE {_hhmm('(k + 1)')} END AS hhmm_end,
         cast(1 + l_linenumber % 3 as integer) AS n_occasions,
         cast(l_quantity as integer) AS mins,
         cast(l_orderkey * 10 + l_linenumber as bigint) AS row_id
  FROM (SELECT *, unnest(generate_series(1, CASE WHEN l_orderkey % 50 = 0 AND l_linenumber = 1 THEN 2 ELSE 1 END)) AS copy_no
        FROM fx_diary WHERE file_quarter <> '{SILENT_QUARTER}') z
),
slots AS MATERIALIZED (
  SELECT {_hhmm('k')} AS slot_time, cast(4 + (k - k % 4) / 4 as integer) % 24 AS slot_hour,
         cast(k + 1 as integer) AS slot_id, cast(1 + (k + 16) % 96 as integer) AS clock_slot_id
  FROM (SELECT DISTINCT l_partkey % 96 AS k FROM lineitem) z
),
replist AS MATERIALIZED (
  SELECT file_quarter, cast(s % 6 as integer) AS report_id,
         CASE s % 6 WHEN 0 THEN 'BBC Radio 2' WHEN 1 THEN '1Xtra from the BBC'
              WHEN 2 THEN 'BBC Radio 5 live sports extra' WHEN 3 THEN 'Absolute Radio'
              WHEN 4 THEN 'Radio bbc Local' END AS report_name,
         'S' || cast(s as varchar) AS station_code,
         CASE s % 3 WHEN 0 THEN 'Q' WHEN 1 THEN 'H' ELSE 'Y' END AS reporting_period,
         CASE WHEN s = 11 THEN 'dtv' WHEN s = 17 THEN 'other_a' WHEN s = 5 THEN 'other_b'
              WHEN s < 6 THEN 'dab' WHEN s < 12 THEN 'amfm' WHEN s < 18 THEN 'online' ELSE 'smartsp' END AS platform_name,
         cast(s % 2 as integer) AS ooa_type,
         CASE WHEN s = 23 THEN 2 ELSE 1 END AS source
  FROM (SELECT DISTINCT file_quarter, l_partkey % 24 AS s FROM fx_diary) z
),
tsa AS MATERIALIZED (
  SELECT file_quarter, report_id, segment FROM (
    SELECT file_quarter, report_id, unnest([0, 1, 2, 3, 4]) AS segment
    FROM (SELECT DISTINCT file_quarter, report_id FROM replist) r) z
  WHERE (report_id + segment) % 3 <> 0
),
segs AS MATERIALIZED (
  SELECT DISTINCT t.file_quarter, t.segment, r.station_code
  FROM tsa t JOIN replist r ON t.file_quarter = r.file_quarter AND t.report_id = r.report_id
),
postal_sector AS MATERIALIZED (
  SELECT file_quarter, sample_point, segment FROM (
    SELECT p.file_quarter, cast(p.c_nationkey as integer) AS sample_point,
           unnest([n.n_regionkey, CASE WHEN n.n_nationkey % 12 = 0 THEN (n.n_regionkey + 1) % 5 END]) AS segment
    FROM (SELECT DISTINCT file_quarter, c_nationkey FROM fx_surveyed) p
    JOIN nation n ON p.c_nationkey = n.n_nationkey) z
  WHERE segment IS NOT NULL
)
"""


def with_fixture(body_ctes: str, select: str) -> str:
    """``WITH <fixture>, <body_ctes> <select>``; ``body_ctes`` may be empty."""
    extra = f",\n{body_ctes}" if body_ctes.strip() else ""
    return f"WITH {FIXTURE_CTES.strip()}{extra}\n{select}"
