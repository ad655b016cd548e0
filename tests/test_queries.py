"""Every query with SQL against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from helixframe.plans.all import QUERIES, SQL

D = "/root/testdata/sf0.001"


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 4) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, D)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got
        return
    con = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(SQL[name])
    want = rows([c[0] for c in cur.description], cur.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and isinstance(y, (int, float)) and math.isclose(x, y, abs_tol=2e-4)) for x, y in zip(a, b)), (a, b)
