"""DataFrame operators of the quarterly survey build."""

from waveband.operators.control import append_quarter, mark_loaded, register_next_quarter
from waveband.operators.enrich import (
    counted_facts,
    expand_copies,
    diary_base,
    listening_facts,
    listening_with_people,
    person_attributes,
    report_segments,
    session_facts,
    station_metadata,
)
from waveband.operators.scope import pending_quarters, registered_quarters, scope_quarters
from waveband.operators.staging import (
    stage_distinct,
    stage_individuals,
    stage_listening,
    stage_postal,
    stage_reports,
    stage_segs,
    stage_tsa,
    stage_weights,
)
from waveband.operators.summaries import (
    PERSON_CUTS,
    cut_summary,
    demographic_summary,
    person_platform_time,
    person_slot_time,
    person_time,
    population_summary,
    relabel_history,
    relabel_stations,
    slot_summary,
    with_quarter_date,
)
from waveband.operators.writes import (
    publish,
    read_table,
    replace_partitions,
    write_replacing,
)

__all__ = [
    "PERSON_CUTS",
    "append_quarter",
    "counted_facts",
    "expand_copies",
    "cut_summary",
    "demographic_summary",
    "diary_base",
    "listening_facts",
    "listening_with_people",
    "mark_loaded",
    "pending_quarters",
    "person_attributes",
    "person_platform_time",
    "person_slot_time",
    "person_time",
    "population_summary",
    "publish",
    "read_table",
    "registered_quarters",
    "register_next_quarter",
    "relabel_history",
    "relabel_stations",
    "replace_partitions",
    "report_segments",
    "scope_quarters",
    "session_facts",
    "slot_summary",
    "stage_distinct",
    "stage_individuals",
    "stage_listening",
    "stage_postal",
    "stage_reports",
    "stage_segs",
    "stage_tsa",
    "stage_weights",
    "station_metadata",
    "with_quarter_date",
    "write_replacing",
]
