"""Tables on shared storage that a job hands over to its next steps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from waveband.session import ensure_checkpoint_dir
from waveband.sources.releases import Folder


def _handovers(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/handover"


@contextmanager
def handover_folder(spark: SparkSession) -> Iterator[str]:
    """A folder below the checkpoint folder for what one job hands over; it goes when the job ends, however it ends."""
    name = f"job-{uuid.uuid4().hex}"
    try:
        yield f"{_handovers(spark)}/{name}"
    finally:
        Folder(spark, _handovers(spark)).removed(name)


def sweep_handovers(spark: SparkSession, grace_hours: float = 24.0) -> list[str]:
    """Remove what jobs handed over that died, and so could not remove it themselves: folders older than ``grace_hours``."""
    folder = Folder(spark, _handovers(spark))
    before = folder.jvm.java.lang.System.currentTimeMillis() - grace_hours * 3_600_000
    gone = sorted(name for name, at in folder.names().items() if at <= before)
    for name in gone:
        folder.removed(name)
    return gone


def handed_over(df: DataFrame, name: str, partition_by: str | None = None, folder: str | None = None) -> DataFrame:
    """``df`` written once as Parquet below the checkpoint folder (or in ``folder``), and read back.

    Later steps read their own columns only, plan with the real file sizes, and a lost
    executor costs a read, not the work before it.
    """
    spark = df.sparkSession
    path = f"{folder or _handovers(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
