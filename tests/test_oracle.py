"""Every registered query against its DuckDB oracle SQL (the driver's gate), at sf0.001."""


import duckdb
import pytest

import __spark_entry__ as E
from martlet.plans.catalog import queries

from helpers import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if not hasattr(v, "hour") or (v.hour, v.minute, v.second) == (0, 0, 0) else v.isoformat()
    return str(v)


def _digest(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rs)


def test_every_query_has_oracle_sql():
    missing = set(queries()) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == sorted(df.columns)
    want = _digest(ocols, cur.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["sale_channel_name", "order_date", "category_name"]
