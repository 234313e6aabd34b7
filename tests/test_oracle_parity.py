"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.plans import catalog

KEYS = sorted(catalog.QUERIES)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else "~" + x for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer orders lineitem events".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_oracle():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_segment" in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
ORACLE = E.oracle_sql()


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    rel = duck.sql(ORACLE[key])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert s_types == dict(zip(d_cols, (str(t) for t in rel.types)))
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


EXACT = {"customer_360": ["total_balance", "total_transaction_amount", "external_overdue_amount"],
         "branch_performance": ["total_deposits", "total_transaction_amount"],
         "daily_bank_kpi": ["total_balance", "total_transaction_amount"],
         "risk_customer_summary": ["external_overdue_amount", "total_balance"],
         "transaction_channel_summary": ["total_transaction_amount"]}


@pytest.mark.parametrize("mart", sorted(EXACT))
def test_mart_decimals_are_exact(spark, duck, mart):
    """Money before any cast to double: decimals of scale 2, equal to the last digit."""
    from ledgerflow.plans import gold, oracle
    from ledgerflow.sources import testdata

    got = gold.MARTS[mart](testdata.silver_tables(spark, SF_SMALL)).select(*EXACT[mart])
    assert all(f.dataType.simpleString().endswith(",2)") for f in got.schema.fields), got.schema
    want = duck.sql(oracle.with_tables(f"SELECT {', '.join(EXACT[mart])} FROM {mart}")).fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
