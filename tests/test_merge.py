"""Keyed upsert: SQL MERGE semantics on hand-made rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from ledgerflow.operators.merge import latest_then_merge, merge_conflicts, merge_upsert

SCHEMA = "k int, v string, insert_timestamp string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple("" if x is None else str(x) for x in t))


def test_update_insert_keep(spark):
    t = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0"), (None, "n", "t0")], SCHEMA)
    s = spark.createDataFrame([(2, "B", "t1"), (3, "c", "t1"), (None, "m", "t1")], SCHEMA)
    out = rows(merge_upsert(t, s, ["k"]))
    # 2 updated (first insert time kept), 3 inserted, NULL keys never match
    assert out == sorted([(1, "a", "t0"), (2, "B", "t0"), (3, "c", "t1"), (None, "n", "t0"), (None, "m", "t1")],
                         key=lambda t: tuple("" if x is None else str(x) for x in t))


def test_faithful_audit_replaces_insert_time(spark):
    t = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(1, "A", "t1")], SCHEMA)
    assert rows(merge_upsert(t, s, ["k"], keep_from_target=())) == [(1, "A", "t1")]


def test_unmatched_duplicate_source_rows_all_insert(spark):
    t = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(5, "x", "t1"), (5, "y", "t1")], SCHEMA)
    assert len(rows(merge_upsert(t, s, ["k"]))) == 3


def test_cardinality_violation_raises(spark):
    t = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(1, "x", "t1"), (1, "y", "t1")], SCHEMA)
    with pytest.raises((PySparkException, CapturedException, Exception)) as err:
        merge_upsert(t, s, ["k"]).collect()
    assert "MERGE_CARDINALITY_VIOLATION" in str(err.value)
    conflicts = merge_conflicts(t, s, ["k"]).collect()
    assert [(r.k, r.source_rows) for r in conflicts] == [(1, 2)]


def test_duplicate_target_rows_each_updated(spark):
    t = spark.createDataFrame([(1, "a", "t0"), (1, "b", "t0")], SCHEMA)
    s = spark.createDataFrame([(1, "z", "t1")], SCHEMA)
    assert rows(merge_upsert(t, s, ["k"], keep_from_target=())) == [(1, "z", "t1"), (1, "z", "t1")]


def test_insert_only_and_update_only(spark):
    t = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0")], SCHEMA)
    s = spark.createDataFrame([(2, "B", "t1"), (3, "c", "t1")], SCHEMA)
    assert rows(merge_upsert(t, s, ["k"], update=False)) == [(1, "a", "t0"), (2, "b", "t0"), (3, "c", "t1")]
    assert rows(merge_upsert(t, s, ["k"], insert=False)) == [(1, "a", "t0"), (2, "B", "t0")]


def test_merge_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0")], SCHEMA)
    s = spark.createDataFrame([(2, "B", "t1"), (3, "c", "t1")], SCHEMA)
    once = merge_upsert(t, s, ["k"])
    twice = merge_upsert(once, s, ["k"])
    assert rows(once) == rows(twice)


def test_null_safe_keys_match(spark):
    t = spark.createDataFrame([(None, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(None, "b", "t1")], SCHEMA)
    assert rows(merge_upsert(t, s, ["k"], null_safe=True, keep_from_target=())) == [(None, "b", "t1")]


def test_latest_then_merge_cures_ambiguity(spark):
    t = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(1, "x", "t1"), (1, "y", "t2")], SCHEMA)
    out = rows(latest_then_merge(t, s, ["k"], ["insert_timestamp"], keep_from_target=()))
    assert out == [(1, "y", "t2")]


def test_plan_has_no_full_outer_or_cartesian(spark):
    t = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(1, "x", "t1")], SCHEMA)
    plan = merge_upsert(t, s, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "Cross" not in plan


def test_merge_evolves_schema_for_added_column(spark):
    t = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    s = spark.createDataFrame([(1, "A", "t1", "x"), (2, "b", "t1", "y")], SCHEMA + ", extra string")
    out = merge_upsert(t, s, ["k"], evolve=True)
    assert out.columns == ["k", "v", "insert_timestamp", "extra"]
    assert rows(out) == [(1, "A", "t0", "x"), (2, "b", "t1", "y")]
    assert merge_upsert(t, s, ["k"]).columns == ["k", "v", "insert_timestamp"]


def test_target_statistics_only_for_source_keys_and_nulls_meet_no_join(spark, scratch):
    t = spark.range(1000).selectExpr("id as k", "'a' as v", "'t0' as insert_timestamp")
    s = spark.createDataFrame([(3, "B", "t1"), (None, "m", "t1")], "k long, v string, insert_timestamp string")
    t.write.parquet(f"{scratch}/t")
    s.write.parquet(f"{scratch}/s")
    merged = merge_upsert(spark.read.parquet(f"{scratch}/t"), spark.read.parquet(f"{scratch}/s"), ["k"])
    plan = merged._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(plan)}
    semi = [i for i, line in enumerate(plan) if "Join LeftSemi" in line]
    target = [i for i, line in enumerate(plan) if "Aggregate" in line and "_merge_n_target" in line]
    assert semi and target and any(t < i and depth[t] < depth[i] for t in target for i in semi)
    # every join of source rows is below a filter that leaves NULL keys out
    assert sum("isnull(k" in line for line in plan) == 1
    assert merged.count() == 1001 and merged.where("k is null").count() == 1
