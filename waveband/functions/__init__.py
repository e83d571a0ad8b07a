"""Column expressions (built-in Spark functions only; no Python UDFs)."""

from waveband.functions.expressions import (
    AGE_BANDS,
    DIGITAL_PLATFORMS,
    PLATFORM_LABELS,
    STATION_RELABELS,
    age_band,
    broadcast_day_end,
    date_lookup_quarter,
    household_id,
    ownership,
    platform_label,
    relabel_station,
    slot_label,
    social_grade,
)
from waveband.functions.measures import reach_measures, reach_aggregates

__all__ = [
    "AGE_BANDS",
    "DIGITAL_PLATFORMS",
    "PLATFORM_LABELS",
    "STATION_RELABELS",
    "age_band",
    "broadcast_day_end",
    "date_lookup_quarter",
    "household_id",
    "ownership",
    "platform_label",
    "reach_aggregates",
    "reach_measures",
    "relabel_station",
    "slot_label",
    "social_grade",
]
