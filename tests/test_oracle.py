"""Every query with an oracle matches DuckDB exactly on the sf0.001 tables (fast subset of the sf0.01 gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import same_result
from tests.conftest import SF_SMALL

SLOW = {"overwrite_latest_partition", "stream_land_prices", "job_daily"}  # write-heavy; covered by scripts/oracle_check.py
NAMES = sorted(k for k in entry.oracle_sql() if k not in SLOW)


def test_registry_consistent():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 90


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert same_result(sdf.columns, srows, dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
