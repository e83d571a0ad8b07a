"""The command-line entry point: build twice (the second run reads the stored
control table and finds nothing pending), then publish."""

from __future__ import annotations

import json

from tests.conftest import SF_SMALL
from waveband.plans.__main__ import main
from waveband.sources.fixture import survey_fixture
from waveband.sources.tables import write_survey_tables


def test_build_then_rebuild_then_publish(spark, scratch, capsys):
    write_survey_tables(survey_fixture(spark, SF_SMALL), f"{scratch}/in", files_per_quarter=1)
    assert main(["build", "--tables", f"{scratch}/in", "--out", f"{scratch}/out"]) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["registered"] == ["2001q3"] and len(first["pending"]) == 15

    assert main(["build", "--tables", f"{scratch}/in", "--out", f"{scratch}/out"]) == 0
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert second["pending"] == [] and second["control_version"] == 2

    assert main(["publish", "--src", f"{scratch}/out", "--dst", f"{scratch}/rep"]) == 0
    copied = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(copied) == {"summary_table_1", "summary_table_2", "population"}
    assert copied["summary_table_1"] == first["summary_quarters"]
