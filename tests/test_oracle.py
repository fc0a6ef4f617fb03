"""Every named query runs, and equals its SQL twin where it has one."""

import os

import pytest

from tablewright.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_as_sql(spark, duck, name):
    assert compare(duck, QUERIES[name](spark, FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_probabilities(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows
    for row in rows:
        for label in ("toxic", "quality"):
            assert 0.0 <= row[f"proba_{label}"] <= 1.0
            assert row[f"pred_{label}"] == (1.0 if row[f"proba_{label}"] > 0.5 else 0.0)
