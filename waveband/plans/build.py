"""The quarterly build job, the backfill in steps, and the release-day publish job.

Order of work (all outputs are replace-by-quarter, so a rerun after a failure
gives the same end state):

1. register the next quarter that has weights (one row; the quarters come from the
   listing of the weights' folders);
2. snapshot the control table once; every stage is scoped by its pending quarters;
3. hand over the person side, the station metadata and the enriched diary rows
   (reduced to distinct rows with a repeat count in the same stage) as Parquet
   in the folder named by ``spark.checkpoint.dir`` (shared storage on a cluster).
   This cuts the lineage behind the large shuffle, and each later step reads only
   its own columns; the folder goes when the job ends;
4. the listening facts are the stored rows without the count and feed the
   three summaries; the sessions re-expand the count, so repeated diary rows stay
   repeated;
5. check the strict rule (one staged quarter) before anything is written;
6. write the rows of the four outputs, for the touched quarters; earlier quarters of the
   two summaries in which a station still has an old name are written anew with them;
7. one release switches the four outputs and the control flags together (the original
   flips the flag before loading; here a run that fails leaves the quarter
   pending and the outputs as they were, not "loaded but empty").
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from waveband.functions import STATION_RELABELS
from waveband.operators import append_quarter, counted_facts, mark_loaded, register_next_quarter, relabel_stations
from waveband.operators.control import check_single_quarter, listed_quarters
from waveband.operators.fanout import FanOut, JoinCounts
from waveband.operators.summaries import old_names
from waveband.operators.writes import read_parts, split, write_rows
from waveband.plans.stages import Run
from waveband.schemas import POPULATION, QUARTERS, SESSIONS, SUMMARY_1, SUMMARY_2
from waveband.sources.releases import Part, Release, commit, latest
from waveband.sources.stored import handed_over, handover_folder
from waveband.sources.tables import SurveyTables

# output table -> (partition key, columns in published order)
OUTPUTS = {
    "summary_table_1": ("quarter", SUMMARY_1),
    "summary_table_2": ("quarter", SUMMARY_2),
    "second_summary": ("file_quarter", SESSIONS),
    "population": ("file_quarter", POPULATION),
}
# the outputs whose stations are renamed, over the whole table
RELABELLED = ("summary_table_1", "summary_table_2")
# names the rules of renaming; a quarter written under them has no old name
RULES = hashlib.sha256(repr(sorted(STATION_RELABELS)).encode()).hexdigest()[:12]
# tables copied to the reporting area on release day
PUBLISHED = ["summary_table_1", "summary_table_2", "population"]


@dataclass
class BuildResult:
    registered: list[str]
    pending: list[str]
    summary_quarters: list[str]
    report_quarters: list[str]
    control_version: int
    outputs: dict[str, str] = field(default_factory=dict)
    # lookups that repeat keys and so have multiplied rows, by name
    fan_outs: dict[str, list[FanOut]] = field(default_factory=dict)


@contextmanager
def _step(spark: SparkSession, description: str):
    """Label the Spark jobs of one build step (shown in the event log and history server)."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"waveband build: {description}")
    try:
        yield
    finally:
        sc.setLocalProperty("spark.job.description", previous)


def _distinct_keys(df: DataFrame, column: str) -> list[str]:
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


# ---- the control table: rows of a release -----------------------------------------

ControlRows = list[list]  # [file_quarter, in_data, quarter_date as text or None]


def _rows(control: DataFrame) -> ControlRows:
    """The control table (one row for each survey quarter) as a release holds it."""
    found = control.select(*QUARTERS.fieldNames()).coalesce(1).collect()
    return sorted(([r[0], r[1], r[2] and r[2].isoformat()] for r in found), key=lambda r: [(v is not None, v or "") for v in r])


def _frame(spark: SparkSession, rows: ControlRows) -> DataFrame:
    return spark.createDataFrame([(q, flag, day and dt.date.fromisoformat(day)) for q, flag, day in rows], QUARTERS)


def control_version(spark: SparkSession, path: str) -> int:
    """The release that the control table at ``path`` is read from, 0 if there is no such table."""
    root, name = split(path)
    number, release = latest(spark, root)
    return number if name in release.control else 0


def read_control(spark: SparkSession, path: str) -> DataFrame | None:
    """The control table at ``path`` as of the last release (None if there is none)."""
    root, name = split(path)
    rows = latest(spark, root)[1].control.get(name)
    return None if rows is None else _frame(spark, rows)


def write_control(spark: SparkSession, control: DataFrame, path: str) -> int:
    """Make ``control`` the control table at ``path``; returns the release that has it."""
    root, name = split(path)
    rows = _rows(control)
    return commit(spark, root, lambda release: release.control.__setitem__(name, rows))


def _merged(stored: ControlRows | None, before: ControlRows, after: ControlRows) -> ControlRows:
    """What a run changed (from ``before`` to ``after``), made on the stored rows, which another run may have changed meanwhile."""
    if stored is None:
        return after
    of = lambda rows, q: [r for r in rows if r[0] == q]
    changed = {q for q in {r[0] for r in after} if of(before, q) != of(after, q) or not of(stored, q)}
    return [r for r in stored if r[0] not in changed] + [r for r in after if r[0] in changed]


# ---- the jobs ------------------------------------------------------------------

@dataclass
class _Loaded:
    """What a load has written, not yet named by a release."""

    summary_quarters: list[str]
    report_quarters: list[str]
    control: ControlRows
    changes: list[Callable[[Release], None]]
    fan_outs: dict[str, FanOut]


def _load(spark: SparkSession, tables: SurveyTables, control: ControlRows, quarters: list[str], mode: str, out_root: str,
          strict: bool, work: str) -> _Loaded:
    """Write the rows of the four outputs for the quarters in scope."""
    with _step(spark, "hand over control"):
        # joins with a stored table are planned by its size, so this one is broadcast; dealt by quarter, a task would hold a whole quarter
        frame = handed_over(_frame(spark, control), "control", folder=work)
    counts = JoinCounts()
    run = Run(tables.replace(quarters=frame), quarters, mode, counts=counts)
    if strict:
        with _step(spark, "strict check"):
            check_single_quarter(run.reports)

    with _step(spark, "hand over people and stations"):
        people, metadata = handed_over(run.people, "people", folder=work), handed_over(run.metadata, "metadata", folder=work)
    run = Run(run.tables, quarters, mode, metadata_override=metadata, people_override=people)
    with _step(spark, "enrich and hand over facts"):
        # every later step reads all of the run's quarters, so a file for each task will do
        counted = handed_over(counted_facts(run.base), "facts", folder=work)
    run = Run(run.tables, quarters, mode, metadata_override=metadata, people_override=people, counted_override=counted, counts=counts)

    with _step(spark, "touched quarters"):
        summary_quarters = _distinct_keys(counted, "file_quarter")
        report_quarters = _distinct_keys(run.reports, "file_quarter")
    results = {
        "summary_table_1": (run.demographic_summary(), summary_quarters),
        "summary_table_2": (run.slot_summary(), summary_quarters),
        "second_summary": (run.sessions, report_quarters),
        "population": (run.population, report_quarters),
    }
    release = latest(spark, out_root)[1]
    changes: list[Callable[[Release], None]] = []
    for name, (df, touched) in results.items():
        with _step(spark, f"write {name}"):
            changes.append(_written(spark, df, out_root, name, touched, release))
    with _step(spark, "mark loaded"):
        after = _rows(mark_loaded(frame, run.reports))
    with _step(spark, "look for fan-outs"):
        fan_outs = _fan_outs(run, counts, control, mode)
    return _Loaded(summary_quarters, report_quarters, after, changes, fan_outs)


def _fan_outs(run: Run, counts: JoinCounts, control: ControlRows, mode: str) -> dict[str, FanOut]:
    """The lookups of a run that gave more than one row for a key."""
    slots = run.tables.slots
    found = {
        "households": counts.fan_out("people", "people with households", run.households, ["hhid", "file_quarter"]),
        "slots (start)": counts.fan_out("sessions", "sessions with starts", slots, ["slot_time"]),
        "slots (end)": counts.fan_out("sessions with starts", "sessions with ends", slots, ["slot_time"]),
    }
    # the control rows are here already
    named = [q for q, _, _ in control if q is not None and (q in run.quarters) == (mode == "pending")]
    if len(named) > len(set(named)):
        found["control"] = FanOut(len(set(named)), len(named), sum(named.count(q) > 1 for q in set(named)))
    return {name: fan for name, fan in found.items() if fan}


def _written(spark: SparkSession, new: DataFrame, out_root: str, name: str, touched: list[str],
             release: Release) -> Callable[[Release], None]:
    """Write an output's rows; returns the change that names them.

    Earlier quarters whose rows follow other rules of names are looked through for old names, by a filter that
    Parquet's statistics serve; those that have one are written anew. All of them follow the rules then, so the next run
    doesn't look at them again. A quarter that another run has replaced meanwhile is left as that run wrote it.
    """
    key, schema = OUTPUTS[name]
    path, rules = f"{out_root}/{name}", RULES if name in RELABELLED else ""
    earlier = {q: p for q, p in release.tables.get(name, {}).items() if q not in touched and p.rules != rules}
    stale: dict[str, Part] = {}
    if earlier:
        found = _distinct_keys(old_names(read_parts(spark, path, key, schema, earlier)), key)
        stale = {q: earlier[q] for q in found}
    if stale:
        renamed = relabel_stations(read_parts(spark, path, key, schema, stale))
        new = new.select(*schema.fieldNames()).unionByName(renamed)
    run, values = write_rows(spark, new, path, key, schema)
    parts = {q: Part(run, rules=rules) for q in values}
    gone = {q for q in [*touched, *values] if q not in stale}

    def change(now: Release) -> None:
        now.replaced(name, gone, {q: p for q, p in parts.items() if q not in stale})
        for q, before in earlier.items():
            if now.tables[name].get(q) == before:
                now.tables[name][q] = parts[q] if q in stale else Part(before.run, before.of, rules)

    return change


def _released(spark: SparkSession, out_root: str, control_path: str, before: ControlRows, after: ControlRows,
              changes: list[Callable[[Release], None]]) -> int:
    """One release for the outputs and the control table; two, the control table's last, if that is kept elsewhere."""
    root, name = split(control_path)

    def outputs(release: Release) -> None:
        for change in changes:
            change(release)

    def flags(release: Release) -> None:
        release.control[name] = _merged(release.control.get(name), before, after)

    if root == out_root.rstrip("/"):
        return commit(spark, root, lambda release: (outputs(release), flags(release)))
    if changes:
        commit(spark, out_root, outputs)
    return commit(spark, root, flags)


def build(spark: SparkSession, tables: SurveyTables, out_root: str, mode: str = "pending",
          register: bool = True, strict: bool = False, control_path: str | None = None) -> BuildResult:
    """Run the quarterly build over ``tables`` and write the outputs under ``out_root``.

    ``tables.quarters`` is the control table as it is now; what the run changes in it is kept
    in the release of ``control_path`` (default ``out_root/quarters``).
    """
    control_path = control_path or f"{out_root}/quarters"
    registered: list[str] = []
    control = tables.quarters.select(*QUARTERS.fieldNames())
    with _step(spark, "snapshot control"):
        before = _rows(control)
    after = before
    if register:
        with _step(spark, "register"):
            weighted = spark.createDataFrame([(q,) for q in listed_quarters(tables.weights)], "file_quarter string")
            new_rows = register_next_quarter(weighted, tables.date_lookup, _frame(spark, before)).collect()  # one at most
        if new_rows:
            registered = [r["file_quarter"] for r in new_rows]
            after = _rows(append_quarter(_frame(spark, before), spark.createDataFrame(new_rows, QUARTERS)))

    # The control table is read once; every later step sees this state, whatever
    # happens to the stored table.
    pending = sorted({q for q, flag, _ in after if flag == "No" and q is not None})
    if mode == "pending" and not pending:
        # nothing registered and not loaded: the outputs stay as they are
        version = _released(spark, out_root, control_path, before, after, [])
        return BuildResult(registered, pending, [], [], version, {})
    with handover_folder(spark) as work:
        loaded = _load(spark, tables, after, pending, mode, out_root, strict, work)
        with _step(spark, "release"):
            version = _released(spark, out_root, control_path, before, loaded.control, loaded.changes)
    outputs = {name: f"{out_root}/{name}" for name in OUTPUTS}
    fan_outs = {lookup: [fan] for lookup, fan in loaded.fan_outs.items()}
    return BuildResult(registered, pending, loaded.summary_quarters, loaded.report_quarters, version, outputs, fan_outs)


def backfill(spark: SparkSession, tables: SurveyTables, out_root: str, step: int = 4, name: str = "backfill",
             control_path: str | None = None) -> BuildResult:
    """Reload every quarter that isn't pending, ``step`` quarters at a time, each with a release of its own.

    A release remembers the quarters that are done, under ``name``, until all are; so a backfill that
    failed goes on, when it is run again, with those that are not. The end state is that of
    ``build(mode="not_pending")``.
    """
    control_path = control_path or f"{out_root}/quarters"
    rows = _rows(tables.quarters)
    pending = {q for q, flag, _ in rows if flag == "No"}
    with _step(spark, "list quarters"):
        there = {q for t in (tables.replist, tables.listening, tables.weights) for q in listed_quarters(t)}
    done = set(latest(spark, out_root)[1].done.get(name, []))
    left = sorted(there - pending - done)
    summary_quarters: list[str] = []
    report_quarters: list[str] = []
    fan_outs: dict[str, list[FanOut]] = {}
    version = latest(spark, out_root)[0]
    for at in range(0, len(left), step):
        quarters = left[at : at + step]
        with handover_folder(spark) as work:
            loaded = _load(spark, tables, rows, quarters, "pending", out_root, False, work)

            def ledger(release: Release, quarters=quarters) -> None:
                release.done[name] = sorted({*release.done.get(name, []), *quarters})

            version = _released(spark, out_root, control_path, rows, loaded.control, [*loaded.changes, ledger])
        rows = loaded.control
        summary_quarters += loaded.summary_quarters
        report_quarters += loaded.report_quarters
        for lookup, fan in loaded.fan_outs.items():
            fan_outs.setdefault(lookup, []).append(fan)
    if left or done:
        version = commit(spark, out_root, lambda release: release.done.pop(name, None))
    return BuildResult([], sorted(pending), summary_quarters, report_quarters, version, {n: f"{out_root}/{n}" for n in OUTPUTS}, fan_outs)


def publish_outputs(spark: SparkSession, src_root: str, dst_root: str,
                    tables: list[str] | None = None) -> dict[str, list[str]]:
    """Release day: the built tables go to the reporting area, all in one release.

    For each table the reporting copy loses the quarters present in the source
    and receives all source rows; quarters only in the reporting copy stay. Quarters
    whose rows are a copy of the source's present run are there already and aren't copied again.
    """
    src, dst = latest(spark, src_root)[1], latest(spark, dst_root)[1]
    names = tables or PUBLISHED
    copies: dict[str, dict[str, Part]] = {}
    for name in names:
        key, schema = OUTPUTS[name]
        there = dst.tables.get(name, {})
        changed = {q: p for q, p in src.tables.get(name, {}).items() if q not in there or there[q].of != p.run}
        if changed:
            with _step(spark, f"publish {name}"):
                rows = read_parts(spark, f"{src_root}/{name}", key, schema, changed)
                # the files have their size already
                run, _ = write_rows(spark, rows, f"{dst_root}/{name}", key, schema, rebalance=False)
            copies[name] = {q: Part(run, p.run, p.rules) for q, p in changed.items()}
    if copies:
        commit(spark, dst_root, lambda release: [release.replaced(name, set(parts), parts) for name, parts in copies.items()] and None)
    return {name: sorted(src.tables.get(name, {})) for name in names}
