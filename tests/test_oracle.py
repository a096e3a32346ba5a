"""Spark result vs the DuckDB oracle SQL on sf0.001, as the driver compares them (sorted values)."""
import math

import duckdb
import pytest

from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()
KEYS = ["trips", "error_log", "load_summary", "overview_kpis", "profitability_by_borough", "tips_payment_comparison",
        "anomalies_list", "zone_stats", "zone_shapes", "client_tip_insight", "aggregate_groups", "stable_sort"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    return repr(v.item() if hasattr(v, "item") else v)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as entry
    df = entry.queries()[key](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    rel = con.sql(entry.oracle_sql()[key])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    si = sorted(range(len(cols)), key=lambda i: cols[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert sorted(tuple(_norm(r[i]) for i in si) for r in rows) == sorted(tuple(_norm(r[i]) for i in oi) for r in orows)
