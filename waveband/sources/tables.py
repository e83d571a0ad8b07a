"""The survey tables as a bundle of DataFrames, read from or written to Parquet.

On storage every quarterly table is partitioned by ``file_quarter`` so the
run's ``IN (pending quarters)`` filter prunes partitions at listing time. The
calendar and slot lookups are small unpartitioned tables.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveband.schemas import INPUT_SCHEMAS

TABLE_NAMES = list(INPUT_SCHEMAS)
UNPARTITIONED = {"date_lookup", "slots"}


@dataclass
class SurveyTables:
    replist: DataFrame
    tsa: DataFrame
    segs: DataFrame
    postal_sector: DataFrame
    listening: DataFrame
    individuals: DataFrame
    weights: DataFrame
    households: DataFrame
    quarters: DataFrame
    date_lookup: DataFrame
    slots: DataFrame

    def by_table_name(self) -> dict[str, DataFrame]:
        return dict(zip(TABLE_NAMES, (getattr(self, f.name) for f in fields(self))))

    def replace(self, **changes: DataFrame) -> "SurveyTables":
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        values.update(changes)
        return SurveyTables(**values)


def read_survey_tables(spark: SparkSession, root: str) -> SurveyTables:
    """Read the eleven tables from ``root/<table name>`` with their fixed schemas."""
    frames = []
    for name in TABLE_NAMES:
        schema = INPUT_SCHEMAS[name]
        frames.append(spark.read.schema(schema).parquet(f"{root}/{name}").select(*schema.fieldNames()))
    return SurveyTables(*frames)


def write_survey_tables(tables: SurveyTables, root: str, mode: str = "errorifexists",
                        files_per_quarter: int | None = None) -> None:
    """Write the bundle as Parquet, quarterly tables partitioned by ``file_quarter``.

    ``files_per_quarter`` compacts the layout: rows are spread over that many
    files per quarter by a deterministic hash of the row (no ``rand()``, so a
    retried task writes the same rows). ``None`` keeps the incoming
    partitioning (one file per task and quarter).
    """
    for name, df in tables.by_table_name().items():
        if name in UNPARTITIONED:
            df.coalesce(1).write.mode(mode).parquet(f"{root}/{name}")
            continue
        if files_per_quarter:
            spread = F.pmod(F.hash(*df.columns), F.lit(files_per_quarter))
            df = df.repartition("file_quarter", spread)
        df.write.mode(mode).partitionBy("file_quarter").parquet(f"{root}/{name}")
