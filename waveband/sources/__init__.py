"""Survey table sources: Parquet storage and the derived test fixture."""

from waveband.sources.bucketed import read_bucketed_tables, write_bucketed_tables
from waveband.sources.fixture import survey_fixture
from waveband.sources.tables import SurveyTables, read_survey_tables, write_survey_tables

__all__ = ["SurveyTables", "read_bucketed_tables", "read_survey_tables", "survey_fixture", "write_bucketed_tables", "write_survey_tables"]
