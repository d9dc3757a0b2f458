"""Every core query against its SQL in DuckDB."""

import datetime
import decimal
import math

import duckdb
import pytest

from chainframe import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 9))
    return None if value is None else str(value)


def same_rows(df, con, sql):
    columns = sorted(df.columns)
    found = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    names = [d[0] for d in con.execute(sql).description]
    assert sorted(names) == columns
    wanted = sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in columns]) for r in con.execute(sql).fetchall())
    assert found == wanted


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, sf_dir, duck, name):
    df = core.queries()[name](spark, sf_dir)
    if name in core.oracle_sql():
        same_rows(df, duck, core.oracle_sql()[name])
    else:
        df.collect()


def test_every_query_has_sql():
    assert set(core.queries()) == set(core.oracle_sql())
