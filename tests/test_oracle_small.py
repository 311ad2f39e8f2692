"""Spark queries against their DuckDB SQL on the smallest scale factor."""

import math

import pytest

import __spark_entry__ as E
from reelrank.plans.catalog import REGISTRY

from .conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k in REGISTRY))
def test_matches_sql(spark, duck, key):
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython"))
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["userId", "rank", "movieId", "title", "predicted_rating"]
