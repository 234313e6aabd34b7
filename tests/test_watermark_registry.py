"""Marks (strict rule, NULLs) and control-table operators."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.conform import parse_column_list
from ledgerflow.operators.watermark import watermark_filter, watermark_max, watermark_upsert
from ledgerflow.plans import registry


def _events(spark):
    return spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, None), (4, "2024-01-02 00:00:00.5")],
        "id int, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_strict_boundary_and_null_rows(spark):
    df = _events(spark)
    assert sorted(r.id for r in watermark_filter(df, "ts", "2024-01-02 00:00:00").collect()) == [4]
    # no mark -> everything, NULL rows included
    assert watermark_filter(df, "ts", None).count() == 4
    # seed mark in date-only text form
    assert watermark_filter(df, "ts", "1900-01-01").count() == 3


def test_mark_text_round_trips(spark):
    df = _events(spark)
    mark = watermark_max(df, "ts").collect()[0].mark
    assert mark == "2024-01-02 00:00:00.5"
    assert watermark_filter(df, "ts", mark).count() == 0


def test_watermark_upsert_skips_null(spark):
    marks = registry.seed_control_tables(spark)["table_watermarks"]
    new = spark.createDataFrame([(1, "2024-05-01 00:00:00"), (2, None), (9, "x")], "table_id int, mark string")
    out = {r.table_id: (r.last_watermark_value, r.last_run_id)
           for r in watermark_upsert(marks, new, run_id=5).collect()}
    assert out[1] == ("2024-05-01 00:00:00", 5)
    assert out[2] == ("1900-01-01 00:00:00.000000", None)  # NULL mark leaves it
    assert out[9] == ("x", 5)  # insert writes the run id too


def test_active_tables_ordered_by_load_order(spark):
    tables = registry.seed_control_tables(spark)["tables"]
    shuffled = tables.withColumn("load_order", F.when(F.col("table_id") == 4, 0).otherwise(F.col("load_order")))
    shuffled = shuffled.withColumn("active_flag", F.col("table_id") != 6)
    ids = [r.table_id for r in registry.active_tables(shuffled).collect()]
    assert ids == [4, 1, 2, 3, 5]


def test_next_run_id_is_numeric(spark):
    runs = spark.createDataFrame([("999",), ("1000",)], "run_id string")
    assert registry.next_run_id(runs).collect()[0].run_id == 1001
    empty = spark.createDataFrame([], "run_id string")
    assert registry.next_run_id(empty).collect()[0].run_id == 1


def test_parameters_pivot_and_conflict(spark):
    params = registry.seed_control_tables(spark)["table_parameters"]
    piv = {r.table_id: r for r in registry.parameters_pivot(params).collect()}
    assert piv[3].load_type == "APPEND" and piv[4].watermark_column is None
    bad = params.unionByName(params.where("table_id = 1 AND parameter_name = 'load_type'")
                             .withColumn("parameter_value", F.lit("FULL")))
    with pytest.raises(Exception, match="conflicting"):
        registry.parameters_pivot(bad).collect()


def test_runtime_config_and_column_list(spark):
    ctl = registry.seed_control_tables(spark)
    cfg = registry.load_config(ctl, 4)
    assert cfg.load_type == "FULL" and cfg.columns[0] == "BRANCH_CODE"
    assert cfg.source_system == "oracledb"
    assert parse_column_list(" A, B ,C") == ["A", "B", "C"]


def test_run_audit_keyed_on_layer(spark):
    import datetime as dt

    t0 = dt.datetime(2025, 1, 1)
    runs = registry.seed_control_tables(spark)["pipeline_runs"]
    b = registry.audit_row(spark, 7, "BRONZE", table_id=1, start=t0, end=t0, records=10)
    s = registry.audit_row(spark, 7, "SILVER", table_id=1, start=t0, end=t0, records=9)
    g = registry.audit_row(spark, 7, "GOLD", kpi_id=1, start=t0, end=t0, records=3)
    out = registry.run_audit_upsert(registry.run_audit_upsert(registry.run_audit_upsert(runs, b), s), g)
    retry = registry.audit_row(spark, 7, "SILVER", table_id=1, start=t0, end=t0, records=11)
    out = registry.run_audit_upsert(out, retry)
    got = sorted((r.layer, r.number_of_records) for r in out.collect())
    assert got == [("BRONZE", 10), ("GOLD", 3), ("SILVER", 11)]


def test_watermark_column_is_optional(spark):
    ctl = registry.seed_control_tables(spark)
    ctl["table_parameters"] = ctl["table_parameters"].where("parameter_name <> 'watermark_column'")
    assert registry.load_config(ctl, 2).watermark_column is None
    ctl["table_parameters"] = ctl["table_parameters"].where("parameter_name <> 'primary_key'")
    with pytest.raises(ValueError, match="primary_key"):
        registry.load_config(ctl, 2)
