"""Driver contract and differential test of every query against its oracle
(the driver runs the same comparison at sf0.01; here sf0.001 keeps it fast)."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

# the training-data queries are tested in tests/llm
QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
ORACLES = {k: s for k, s in E.oracle_sql().items() if k not in E.LLM_ORACLES}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except Exception:  # noqa: BLE001
        pass
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([_norm(r[i]) for i in order]) for r in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 100


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["product", "orders", "quantity", "share_pct"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(ORACLES[key])
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert _rows(srows, sdf.columns) == _rows(orows, rel.columns)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.columns) > 0


def test_bench_headline_queries_are_registered():
    import bench

    assert set(bench.HEADLINE) - {"pruned_count"} <= set(QUERIES)
    assert "parquet_scan" in QUERIES  # used as the warm-up
