"""Plan properties and small models: pushdown, pruning, latest-per-key."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.operators.aggregate import latest_per_key
from ledgerflow.operators.watermark import watermark_filter
from ledgerflow.sources import testdata
from ledgerflow.sources.store import TableStore


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mark_predicate_and_projection_reach_parquet_scan(spark):
    t = testdata.transactions(spark, SF_SMALL)
    df = watermark_filter(t, "txn_timestamp", "1999-12-31 00:00:00").select("account_id", "amount")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate," in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "l_returnflag" not in scan and "l_quantity" not in scan  # unused columns pruned


def test_full_load_twice_equals_once(spark, scratch):
    store = TableStore(spark, scratch)
    b = testdata.branches(spark, SF_SMALL)
    store.write_snapshot("silver", "branches", b, run_id=1)
    once = sorted(map(tuple, store.read("silver", "branches").collect()))
    store.write_snapshot("silver", "branches", b, run_id=2)
    assert sorted(map(tuple, store.read("silver", "branches").collect())) == once


report = st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(report, max_size=8))
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, d int, score int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["d"]).collect())
    best = {}
    for k, d, s in rows:
        # latest d first (NULLs last), then the higher score
        rank = (d is not None, d if d is not None else 0, s)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, d, s))
    assert got == sorted(v for _, v in best.values())


def test_latest_plan_aggregates_before_the_shuffle(spark):
    t = testdata.credit_bureau_reports(spark, SF_SMALL)
    plan = latest_per_key(t, ["customer_id"], ["bureau_pull_date"])._jdf.queryExecution().sparkPlan().toString()
    nodes = [line.strip(" +-:*()0123456789") for line in plan.splitlines() if "Aggregate" in line]
    # Spark aggregates structs by sorting; the partial one stands below the exchange, and no window above
    assert len(nodes) == 2 and all(n.startswith("SortAggregate") for n in nodes) and "partial_max" in nodes[1]
    assert "Window" not in plan and "max_by" not in plan


def test_transactions_are_reduced_before_the_join(spark):
    from ledgerflow.operators.aggregate import transaction_totals

    t, a = testdata.transactions(spark, SF_SMALL), testdata.accounts(spark, SF_SMALL)
    plan = transaction_totals(t, a)._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count(txn_id" in plan.split("Join")[1]


def test_registered_queries_stay_jvm_side_without_cross_joins(spark):
    from ledgerflow.plans import catalog

    banned = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "localCheckpoint")
    for key, q in catalog.QUERIES.items():
        plan = q(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in banned if b in plan]
        assert not hits, (key, hits)
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "BroadcastNestedLoopJoin" in line:
                # Only Catalyst's existence check survives: a semi/anti join whose
                # keys folded to constants, against a one-row (LocalLimit 1) side.
                window = "\n".join(lines[i:i + 12])
                assert ("LeftAnti" in line or "LeftSemi" in line) and "LocalLimit 1" in window, (key, line)
