"""Landing and conforming operators, and the small DDL/DML stand-ins."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.conform import (
    add_audit_columns, add_column, conform, empty_like, land_as_string, project, reject_reason, update_where,
)
from ledgerflow.schemas import TRANSACTIONS


def _landed(spark, amount="12.50", ts="2024-01-02 03:04:05"):
    return spark.createDataFrame([("1", "7", "DEBIT", amount, ts, "UPI", "SUCCESS", None)],
                                 ", ".join(f"{f.name} string" for f in TRANSACTIONS.fields))


def test_land_then_conform_round_trips(spark):
    typed = conform(_landed(spark), TRANSACTIONS)
    assert [f.dataType.simpleString() for f in typed.schema.fields][:5] == \
        ["bigint", "bigint", "string", "decimal(18,2)", "timestamp_ntz"]
    back = land_as_string(typed)
    assert back.collect()[0].amount == "12.50"


def test_conform_is_strict_and_rejects_are_named(spark):
    bad = _landed(spark, amount="12,50")
    with pytest.raises(Exception):
        conform(bad, TRANSACTIONS).collect()
    both = bad.unionByName(_landed(spark))
    out = both.select(reject_reason(both, TRANSACTIONS).alias("why")).collect()
    assert sorted((r.why or "") for r in out) == ["", "amount"]


def test_missing_contract_columns_become_typed_nulls(spark):
    short = project(_landed(spark), ["TXN_ID", "AMOUNT"])
    typed = conform(short, TRANSACTIONS)
    assert typed.columns == [f.name for f in TRANSACTIONS.fields]
    assert typed.collect()[0].channel is None


def test_empty_like_folds_to_empty_relation(spark):
    df = _landed(spark)
    e = empty_like(df)
    assert e.schema == df.schema and e.count() == 0
    assert "LocalRelation" in e._jdf.queryExecution().optimizedPlan().toString()


def test_add_column_and_update_where(spark):
    df = add_column(_landed(spark), "note", "string")
    assert df.columns[-1] == "note" and add_column(df, "NOTE", "string").columns == df.columns
    upd = update_where(df, F.col("status") == "SUCCESS", {"status": "DONE", "note": F.lit("x")})
    r = upd.collect()[0]
    assert (r.status, r.note) == ("DONE", "x")
    assert update_where(df, F.lit(None).cast("boolean"), {"status": "DONE"}).collect()[0].status == "SUCCESS"


def test_audit_columns_from_one_run_timestamp(spark):
    out = add_audit_columns(_landed(spark), "2025-01-01 00:00:00").collect()[0]
    assert out.insert_timestamp == out.update_timestamp
