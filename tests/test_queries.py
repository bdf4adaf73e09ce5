"""Every registered query of the base part against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from cogwright import plans


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_against_sql(spark, duck, sf_dir, name):
    df = plans.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(norm(x) for x in r)) for r in df.select(*cols).collect())
    r = duck.execute(plans.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    at = sorted(range(len(names)), key=lambda i: names[i])
    assert got == sorted(repr(tuple(norm(x[i]) for i in at)) for x in r.fetchall())
