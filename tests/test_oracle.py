"""Every registered query with SQL equals DuckDB on sf0.001 (the driver's gate at small scale)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from scoreloop.plans.oracle import SQL
from scoreloop.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(k for k in SQL if k in QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 35


def test_every_query_has_sql_or_is_rows_only():
    rows_only = set(QUERIES) - set(E.oracle_sql())
    assert rows_only == {"file_checksum", "file_tree", "train_score_model", "score_ml", "retrain_report"}
