"""Every query with SQL against DuckDB, over whole small tables."""

import datetime
import math
from decimal import Decimal

import duckdb
import pytest

from quaysight import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.5g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.5g}" if abs(v) < 10**5 else str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    df = plans.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    cur = duck.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def test_all_named_alike():
    assert set(plans.oracle_sql()) <= set(plans.queries())


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_runs_without_sql(spark, sf_dir, name):
    plans.queries()[name](spark, sf_dir).collect()
