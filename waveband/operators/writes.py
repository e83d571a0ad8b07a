"""Replace-by-quarter writes and the release-day publish.

The original deletes every row whose quarter is in a "touched" list and then
inserts the new rows. Two forms are provided:

* :func:`replace_partitions` / :func:`publish` - the resulting table as a
  DataFrame (anti-join on the touched keys plus union). Exact, including NULL
  keys: a NULL quarter never matches ``IN``, so NULL-keyed target rows survive.
* :func:`write_replacing` - the same on storage. Files are never changed: each
  write puts its rows in a folder of its own (``data/run=…/<key>=…``), and a
  release of the folder of tables (:mod:`waveband.sources.releases`) then says for
  each quarter which run holds it. A reader sees the table before or after, never
  between, and a write that fails leaves the table as it was. Work is in proportion
  to the touched quarters, not to the table's history.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.sources.releases import Folder, Part, Release, commit, latest

# characters Spark escapes in partition directory names
_UNSAFE = re.compile(r"[\"#%'*/:=?\\\x00-\x1f\x7f{}\[\]^]")


def replace_partitions(target: DataFrame, new: DataFrame, key: str, touched: DataFrame) -> DataFrame:
    """``target`` minus rows whose ``key`` is in ``touched``, plus all ``new`` rows."""
    keys = touched.select(F.col(key)).distinct()
    survivors = target.join(keys, key, "left_anti")
    return survivors.unionByName(new.select(*target.columns))


def publish(src: DataFrame, dst: DataFrame, key: str) -> DataFrame:
    """Copy every source row to the reporting table, replacing the source's quarters there.

    Quarters that exist only in the reporting table are kept.
    """
    return replace_partitions(dst, src, key, src)


def split(path: str) -> tuple[str, str]:
    """The folder of tables and the table's name."""
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def write_rows(spark: SparkSession, new: DataFrame, path: str, key: str, schema: T.StructType,
               rebalance: bool = True) -> tuple[str, list[str]]:
    """Write rows that no release names yet; returns their run and quarters.

    ``new`` must hold non-NULL keys only (the build scopes every table with ``IN``, which never yields
    a NULL quarter). Rows are rebalanced by the key, so that files have the advisory partition size:
    large quarters are split, small ones share a task; without that, each task writes a file for each of its quarters.
    """
    run = uuid.uuid4().hex
    data = f"{path.rstrip('/')}/data/run={run}"
    rows = new.select(*schema.fieldNames())
    (rows.hint("rebalance", key) if rebalance else rows).write.partitionBy(key).parquet(data)
    values = sorted(name.partition("=")[2] for name in Folder(spark, data).names() if name.startswith(f"{key}="))
    for value in values:
        if value == "__HIVE_DEFAULT_PARTITION__" or _UNSAFE.search(value):
            raise ValueError(f"a quarter that can't name a folder: {value!r}")
    return run, values


def write_replacing(spark: SparkSession, new: DataFrame, path: str, key: str, touched: Iterable[str],
                    schema: T.StructType) -> None:
    """Replace the touched quarters of the table at ``path`` with ``new``, which must hold only such (see :func:`write_rows`)."""
    run, values = write_rows(spark, new, path, key, schema)
    root, name = split(path)
    gone = {v for v in touched if v is not None} | set(values)
    commit(spark, root, lambda release: release.replaced(name, gone, {v: Part(run) for v in values}))


def read_parts(spark: SparkSession, path: str, key: str, schema: T.StructType, parts: dict[str, Part]) -> DataFrame:
    """The rows of the given parts of a table, in its published column order."""
    if not parts:
        return spark.createDataFrame([], schema)
    path = path.rstrip("/")
    folders = [f"{path}/data/run={part.run}/{key}={value}" for value, part in sorted(parts.items())]
    stored = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return stored.select(*schema.fieldNames())


def read_table(spark: SparkSession, path: str, key: str, schema: T.StructType, release: Release | None = None) -> DataFrame:
    """A table of the folder's last release, or of the given one; empty if there is none."""
    root, name = split(path)
    release = latest(spark, root)[1] if release is None else release
    return read_parts(spark, path, key, schema, release.tables.get(name, {}))
