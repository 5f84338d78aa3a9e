"""Every registered query against its SQL in a second engine, on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402
from conftest import SMALL  # noqa: E402

from stormledger import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees(spark, con, name):
    # An empty answer is only wrong where the SQL gives rows.
    assert compare.difference(spark, con, SMALL, name) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["ano", "total_ocorrencias", "media_movel_3anos"]
    assert entry.entry(spark).count() == 7
