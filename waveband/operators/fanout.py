"""Lookup joins that multiply rows: counted in the pass that runs anyway, explained only where it happened.

The lookups by household, time slot and quarter are taken to have one row for each key; a second row
would repeat diary rows or weights without an error. A left join with such a lookup gives as many rows as it takes,
so rows are counted before and after it by observed metrics of the write that runs them; nothing is
scanned, shuffled or run for it. Only where the counts differ are the lookup's repeated keys counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class FanOut(NamedTuple):
    """A lookup join that gave more rows than it took, and the keys that its lookup repeats."""

    rows_in: int
    rows_out: int
    repeated_keys: int


@dataclass
class JoinCounts:
    """The rows before and after the lookup joins of one run."""

    _seen: dict[str, Observation] = field(default_factory=dict)

    def counted(self, df: DataFrame, point: str) -> DataFrame:
        """``df``, whose rows are counted under ``point`` when they are first written."""
        self._seen[point] = Observation()
        return df.observe(self._seen[point], F.count(F.lit(1)).alias("rows"))

    def rows(self, point: str) -> int:
        """The rows counted at ``point``; waits for the write that counts them.

        Where the plan was found to be empty while it ran, its counts are gone with it, and are 0.
        """
        counted = self._seen[point]._jo.getRow()  # Observation.get can't give a row without fields
        return counted.getLong(0) if counted.length() else 0

    def fan_out(self, before: str, after: str, lookup: DataFrame, keys: list[str]) -> FanOut | None:
        """What the join between two points multiplied, or None."""
        rows_in, rows_out = self.rows(before), self.rows(after)
        return FanOut(rows_in, rows_out, repeated_keys(lookup, keys)) if rows_out > rows_in else None


def repeated_keys(lookup: DataFrame, keys: list[str]) -> int:
    """How many keys, null ones apart, more than one row of ``lookup`` has."""
    return lookup.dropna(subset=keys).groupBy(*keys).count().where("count > 1").count()
