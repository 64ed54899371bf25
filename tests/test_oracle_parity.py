"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names and an order-insensitive multiset of rounded values)."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as E
from tributary.plans.catalog import QUERIES as OWN
from tributary.plans.oracle import ORACLE

QUERIES = {name: fn for name, fn in E.queries().items() if name in OWN}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    from conftest import SF001
    df = QUERIES[name](spark, SF001)
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    from conftest import SF001
    assert QUERIES[name](spark, SF001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "anio", "mes", "revenue", "orders", "lines", "avg_order_value"]
