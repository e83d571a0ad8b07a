"""A task's share doesn't grow with the tables, and two loads of one query enrich the diary once."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from waveband import session
from waveband.plans.registry import QUERIES

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _mb(spark, key: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) // 2**20


def test_shuffles_begin_with_partitions_for_the_stored_bytes(spark, scratch):
    for i in (1, 2):
        spark.range(200_000 * i).repartition(1).write.parquet(f"{scratch}/t{i}")
    least, before = int(spark.conf.get("spark.sql.shuffle.partitions")), session.STORED_BYTES_PER_PARTITION
    session.STORED_BYTES_PER_PARTITION = 10_000
    try:
        small, large = (session.size_shuffles(spark, f"{scratch}/t{i}") for i in (1, 2))
        assert least < small and 1.8 * small < large < 2.2 * small and spark.conf.get(INITIAL) == str(large)
        assert session.size_shuffles(spark, f"{scratch}/absent") == least
    finally:
        session.STORED_BYTES_PER_PARTITION = before
        session.size_shuffles(spark)


def test_a_task_reads_few_shuffled_bytes(spark):
    session.apply_conf(spark)
    # the widest stage takes about a hundred times what it reads
    assert 100 * _mb(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes") < 1000
    assert _mb(spark, "spark.sql.files.maxPartitionBytes") <= 32


@pytest.mark.parametrize("name", ["replace_partitions", "relabel_history", "relabel_slot_history", "publish_summary", "publish_slot_summary", "replace_sessions"])
def test_two_loads_read_the_enriched_diary(spark, name):
    read = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert any("handover/facts" in f for f in read) and not any("lineitem" in f or "orders" in f for f in read), read
