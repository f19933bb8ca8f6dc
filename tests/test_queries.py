"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_module
from compare import differences, duck
from conftest import SF_SMALL

SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", SQL)
def test_matches_sql(spark, connection, key):
    assert differences(spark, connection, SF_SMALL, key, SQL[key]) == []


def test_entry_and_registry(spark):
    assert set(SQL) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns == [
        "id",
        "actor1_name",
        "actor2_name",
        "event_date",
        "num_mentions",
        "avg_tone",
        "confidence",
        "source_url",
        "source",
        "theme",
        "image",
        "title",
    ]
