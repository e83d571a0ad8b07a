"""Replace-by-quarter on storage: versions, what readers see, failures between the steps."""

from __future__ import annotations

import os

import pytest

from waveband.operators import read_table, write_replacing, writes
from waveband.schemas import _struct, I, S
from waveband.sources.releases import Folder

SCHEMA = _struct(("v", I), ("quarter", S))


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(spark, path):
    return sorted((r.quarter, r.v) for r in read_table(spark, path, "quarter", SCHEMA).collect())


def test_write_replacing_on_storage(spark, scratch):
    path = f"{scratch}/t"
    assert _rows(spark, path) == []
    first = _table(spark, [(1, "2020q1"), (2, "2020q2"), (3, "2020q3")])
    write_replacing(spark, first, path, "quarter", ["2020q1", "2020q2", "2020q3"], SCHEMA)
    assert _rows(spark, path) == [("2020q1", 1), ("2020q2", 2), ("2020q3", 3)]

    # 2020q2 replaced, 2020q3 touched without new rows (deleted), 2020q1 untouched (kept)
    new = _table(spark, [(20, "2020q2"), (21, "2020q2")])
    for _ in range(2):  # the rerun gives the same state
        write_replacing(spark, new, path, "quarter", ["2020q2", "2020q3"], SCHEMA)
        assert _rows(spark, path) == [("2020q1", 1), ("2020q2", 20), ("2020q2", 21)]


def test_table_without_rows_can_be_read(spark, scratch):
    path = f"{scratch}/t"
    write_replacing(spark, _table(spark, []), path, "quarter", ["2020q1"], SCHEMA)
    assert _rows(spark, path) == []
    write_replacing(spark, _table(spark, [(1, "2020q1")]), path, "quarter", [], SCHEMA)
    write_replacing(spark, _table(spark, []), path, "quarter", ["2020q1"], SCHEMA)
    assert _rows(spark, path) == []


def test_reader_during_the_switch_and_failure_before_it(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    write_replacing(spark, _table(spark, [(1, "2020q1"), (2, "2020q2")]), path, "quarter", [], SCHEMA)
    before = read_table(spark, path, "quarter", SCHEMA)
    seen = []

    def failing(*_):
        seen.append(_rows(spark, path))  # the new rows are written, no release names them yet
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(writes, "commit", failing)
        with pytest.raises(OSError):
            write_replacing(spark, _table(spark, [(9, "2020q2")]), path, "quarter", [], SCHEMA)
    assert seen == [[("2020q1", 1), ("2020q2", 2)]] == [_rows(spark, path)]
    write_replacing(spark, _table(spark, [(9, "2020q2")]), path, "quarter", [], SCHEMA)
    assert _rows(spark, path) == [("2020q1", 1), ("2020q2", 9)]
    assert sorted(r.v for r in before.collect()) == [1, 2]  # a reader that began before still reads the old files


def test_one_release_is_taken_once(spark, scratch):
    path = f"{scratch}/t"
    write_replacing(spark, _table(spark, [(1, "2020q1")]), path, "quarter", [], SCHEMA)
    folder = Folder(spark, scratch)
    assert not folder.taken("{}", "_releases", "0000000001.json")
    assert not folder._renamed("{}", "_releases", "_attempt-x", "0000000001.json")
    assert os.listdir(f"{scratch}/_releases") == ["0000000001.json"]
    assert _rows(spark, path) == [("2020q1", 1)]


def test_damaged_release_is_an_error(spark, scratch):
    path = f"{scratch}/t"
    write_replacing(spark, _table(spark, [(1, "2020q1")]), path, "quarter", [], SCHEMA)
    with open(f"{scratch}/_releases/0000000001.json", "w") as file:
        file.write("damaged")
    with pytest.raises(ValueError):
        _rows(spark, path)


@pytest.mark.parametrize("quarter", [None, "a/b", "a%b"])
def test_a_quarter_that_cannot_name_a_folder_is_an_error(spark, scratch, quarter):
    path = f"{scratch}/t"
    with pytest.raises(ValueError, match="name a folder"):
        write_replacing(spark, _table(spark, [(1, quarter)]), path, "quarter", [], SCHEMA)
    assert _rows(spark, path) == []
