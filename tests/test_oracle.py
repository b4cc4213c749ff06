"""Every registered query against its SQL on the smallest data.
"""

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1] / x) for x in ("", "tools")]
import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from given import DATA  # noqa: E402

ALL = entry.queries()
NAMES = list(entry.registered.QUERIES)


@pytest.fixture(scope="module")
def con():
    return check.connect(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, con, name):
    note, ok = check.compare(spark, con, name, ALL[name], entry.oracle_sql().get(name), DATA)
    assert ok, note


def test_every_query_has_sql():
    assert set(entry.registered.ORACLES) == set(entry.registered.QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
