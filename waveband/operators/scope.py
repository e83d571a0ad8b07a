"""Quarter scoping: restrict a survey table to the quarters of one run.

A run works on the quarters that are registered in the control table but not
yet loaded (``in_data = 'No'``). The list is read once at the start of the run
(:func:`pending_quarters`) and then passed to every operator, so flipping the
control flag later cannot change what the lazily evaluated plans read.

Scoping by a literal list is a plain ``IN`` filter on the partition column,
which Spark turns into static partition pruning when the table is stored
partitioned by ``file_quarter``: only the pending quarters' files are listed
and read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def control_rows(control: DataFrame) -> list:
    """The control table's rows (one per quarter), read in a single task."""
    return control.select("file_quarter", "in_data").coalesce(1).collect()


def pending_quarters(control: DataFrame) -> list[str]:
    """Snapshot of the quarters registered but not loaded, sorted."""
    return sorted({r[0] for r in control_rows(control) if r[1] == "No" and r[0] is not None})


def registered_quarters(control: DataFrame) -> list[str]:
    """Snapshot of every quarter in the control table, loaded or not, sorted."""
    return sorted({r[0] for r in control_rows(control) if r[0] is not None})


def scope_quarters(df: DataFrame, quarters: Iterable[str], mode: str = "pending",
                   column: str = "file_quarter") -> DataFrame:
    """Keep rows of the listed quarters (``pending``) or of all other quarters (``not_pending``).

    ``not_pending`` is the backfill mode: it reloads everything that is not in
    the list. Rows with a NULL quarter are in neither scope, as with SQL
    ``IN``/``NOT IN``; NULL entries of the list are ignored (SQL ``NOT IN``
    would return no rows at all if the list held a NULL).
    """
    keys = sorted({q for q in quarters if q is not None})
    col = F.col(column)
    if mode == "pending":
        return df.filter(col.isin(keys)) if keys else df.filter(F.lit(False))
    if mode == "not_pending":
        return df.filter(col.isNotNull() & ~col.isin(keys)) if keys else df.filter(col.isNotNull())
    raise ValueError(f"unknown scope mode {mode!r}")
