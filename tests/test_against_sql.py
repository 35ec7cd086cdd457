"""Every query with checking SQL gives the same rows in DuckDB."""

import compare
import pytest

from scorespark.plans import catalog


@pytest.fixture(scope="module")
def duck(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, duck, folder, name):
    verdict = compare.compare(spark, duck, catalog.QUERIES[name], catalog.SQL[name], folder)
    assert verdict.startswith("ok"), verdict


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 5
