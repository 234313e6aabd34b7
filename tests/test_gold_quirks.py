"""Gold marts on hand-made rows: one case per behaviour kept from the reference."""

import datetime as dt
from decimal import Decimal

from ledgerflow import schemas
from ledgerflow.plans import gold, reports

TS = dt.datetime


def _nullable(sch):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in sch.fields])


def silver(spark, customers=(), accounts=(), transactions=(), reports_=(), branches=()):
    mk = lambda rows, sch: spark.createDataFrame(list(rows), _nullable(sch))
    return {
        "customers": mk(customers, schemas.CUSTOMERS),
        "accounts": mk(accounts, schemas.ACCOUNTS),
        "transactions": mk(transactions, schemas.TRANSACTIONS),
        "credit_bureau_reports": mk(reports_, schemas.CREDIT_BUREAU_REPORTS),
        "branches": mk(branches, schemas.BRANCHES),
        "payment_gateway_logs": mk((), schemas.PAYMENT_GATEWAY_LOGS),
    }


def cust(cid, first="A", last="B", kyc="VERIFIED", branch="BR1"):
    return (cid, first, last, dt.date(1990, 1, 1), None, None, None, kyc, branch, None, None)


def acct(aid, cid, bal, status="ACTIVE", branch="BR1"):
    return (aid, cid, "SAV", Decimal(bal), "INR", branch, status, dt.date(2020, 1, 1), None, None)


def txn(tid, aid, amt, ts=TS(2024, 1, 1), status="SUCCESS", channel="UPI"):
    return (tid, aid, "DEBIT", Decimal(amt), ts, channel, status, None)


def rep(cid, score, grade, loans, overdue, ts):
    return (cid, score, grade, loans, Decimal(overdue), ts)


def branch(code, name):
    return (code, name, "c", "s", "r", None)


def test_risk_fan_out_matches_hand_numbers(spark):
    # HIGH customer with 2 reports x 3 active accounts: loans/overdue x3, balance x2
    s = silver(
        spark,
        customers=[cust(1)],
        accounts=[acct(10, 1, "100.00"), acct(11, 1, "200.00"), acct(12, 1, "300.00"),
                  acct(13, 1, "999.00", status="CLOSED")],
        reports_=[rep(1, 700, "HIGH", 2, "10.50", TS(2024, 1, 1)), rep(1, 650, "HIGH", 3, "1.25", TS(2024, 2, 1))],
    )
    r = gold.risk_customer_summary(s).collect()[0]
    assert r.credit_score == 700
    assert r.external_active_loans == (2 + 3) * 3
    assert r.external_overdue_amount == Decimal("11.75") * 3
    assert r.total_balance == Decimal("600.00") * 2
    d = gold.risk_customer_summary_dedup(s).collect()[0]
    assert (d.external_active_loans, d.external_overdue_amount, d.total_balance) == (5, Decimal("11.75"), Decimal("600.00"))


def test_customer_360_quirks(spark):
    s = silver(
        spark,
        customers=[cust(1), cust(2, last=None), cust(3, branch="NOPE")],
        accounts=[acct(10, 1, "600000.00"), acct(20, 2, "150000.00")],
        transactions=[txn(1, 10, "5.00"), txn(2, 10, "7.00", status="FAILED"), txn(3, 99, "1.00")],
        reports_=[rep(1, 500, "LOW", 0, "0", TS(2024, 1, 1)), rep(1, 800, "HIGH", 0, "0", TS(2024, 1, 1)),
                  rep(1, 400, "MEDIUM", 0, "0", TS(2023, 1, 1))],
        branches=[branch("BR1", "Main")],
    )
    out = {r.customer_id: r for r in gold.customer_360(s).collect()}
    assert out[1].customer_segment == "HIGH_VALUE"
    assert out[1].total_transactions == 2  # every status counts (Q20)
    assert out[1].credit_score == 800  # latest date, tie broken by the higher score (Q26)
    assert out[2].customer_name is None  # CONCAT with NULL (Q19)
    assert out[2].customer_segment == "MEDIUM_VALUE"
    assert out[3].customer_segment == "LOW_VALUE" and out[3].total_balance == 0  # no accounts (Q18)
    assert out[3].branch_name is None


def test_branch_performance_home_branch_and_empty(spark):
    s = silver(
        spark,
        customers=[cust(1, branch="BR1"), cust(2, branch="BR1")],
        accounts=[acct(10, 1, "10.00", branch="BR2")],  # account's own branch is ignored (Q17)
        transactions=[txn(1, 10, "3.00")],
        branches=[branch("BR1", "Main"), branch("BR2", "Empty")],
    )
    out = {r.branch_code: r for r in gold.branch_performance(s).collect()}
    assert (out["BR1"].total_customers, out["BR1"].total_accounts, out["BR1"].total_deposits) == (2, 1, Decimal("10.00"))
    assert out["BR1"].total_transaction_amount == Decimal("3.00")
    assert (out["BR2"].total_customers, out["BR2"].total_deposits) == (0, 0)


def test_daily_kpi_repeats_snapshot_and_null_date(spark):
    s = silver(
        spark,
        customers=[cust(1), cust(2)],
        accounts=[acct(10, 1, "10.00")],
        transactions=[txn(1, 10, "1.00", ts=TS(2024, 1, 1, 5)), txn(2, 10, "2.00", ts=TS(2024, 1, 2)),
                      txn(3, 10, "4.00", ts=None)],
        reports_=[rep(1, 600, "HIGH", 0, "0", TS(2024, 1, 1)), rep(2, 700, "LOW", 0, "0", TS(2024, 1, 1))],
    )
    out = {r.txn_date: r for r in gold.daily_bank_kpi(s).collect()}
    assert set(out) == {dt.date(2024, 1, 1), dt.date(2024, 1, 2), None}
    for r in out.values():
        assert (r.total_customers, r.total_accounts, r.high_risk_customers) == (2, 1, 1)
        assert r.avg_credit_score == 650.0


def test_channel_summary_success_known_accounts(spark):
    s = silver(
        spark,
        accounts=[acct(10, 1, "1.00")],
        transactions=[txn(1, 10, "1.005"), txn(2, 10, "2.00", channel=None), txn(3, 10, "9.00", status="FAILED"),
                      txn(4, 77, "5.00")],
    )
    out = {r.channel: (r.total_transaction, r.total_transaction_amount)
           for r in gold.transaction_channel_summary(s).collect()}
    assert out == {"UPI": (1, Decimal("1.01")), None: (1, Decimal("2.00"))}


def test_empty_inputs(spark):
    s = silver(spark)
    for name in ("customer_360", "daily_bank_kpi", "branch_performance", "risk_customer_summary",
                 "risk_customer_summary_dedup", "transaction_channel_summary"):
        assert getattr(gold, name)(s).count() == 0, name
    # branches without any customer still appear, with zero totals
    s2 = silver(spark, branches=[branch("BR9", "Lonely")])
    only = gold.branch_performance(s2).collect()
    assert [(r.branch_code, r.total_customers, r.total_deposits) for r in only] == [("BR9", 0, 0)]
    m = {"customer_360": gold.customer_360(s)}
    assert reports.total_deposits(m).collect()[0].total_deposits is None  # global SUM over nothing
    assert reports.total_customers(m).collect()[0].total_customers == 0


def test_top_dates_month_rollup_merges_dates(spark):
    s = silver(
        spark,
        transactions=[txn(i, 10, str(100 - i), ts=TS(2024, 1 + (i % 2), 1 + i)) for i in range(8)],
    )
    m = {"daily_bank_kpi": gold.daily_bank_kpi(s)}
    top = reports.top_dates(m).collect()
    assert len(top) == 5
    months = reports.widget_top_dates_month(m).collect()
    assert sum(r.total_transaction_amount for r in months) == sum(r.total_transaction_amount for r in top)
    assert len(months) == 2


def test_marts_have_no_cartesian_or_window(spark):
    s = silver(spark, customers=[cust(1)])
    for name, build in gold.MARTS.items():
        plan = build(s)._jdf.queryExecution().optimizedPlan().toString()
        assert "CartesianProduct" not in plan and "Join Cross" not in plan, name
        assert "Window" not in plan, name


def test_shared_totals_match_marts(spark):
    from conftest import SF_SMALL
    from ledgerflow.functions.scalars import for_comparison
    from ledgerflow.operators.aggregate import account_totals, transaction_totals
    from ledgerflow.sources import testdata

    s = testdata.silver_tables(spark, SF_SMALL)
    both = account_totals(s["accounts"]).checkpoint(), transaction_totals(s["transactions"], s["accounts"]).checkpoint()
    for name in ("customer_360", "branch_performance"):
        a = sorted(map(tuple, for_comparison(gold.build(name, s, lambda: both)).collect()), key=repr)
        b = sorted(map(tuple, for_comparison(gold.build(name, s)).collect()), key=repr)
        assert a == b, name


def test_widget_merges_branches_sharing_a_name(spark):
    s = silver(
        spark,
        customers=[cust(1, branch="BR1"), cust(2, branch="BR2"), cust(3, branch="BR2")],
        branches=[branch("BR1", "Twin"), branch("BR2", "Twin"), branch("BR3", "Solo")],
    )
    m = {"branch_performance": gold.branch_performance(s)}
    per_code = {r.branch_name: r.total_customers for r in reports.branch_customers(m).collect() if r.branch_name == "Solo"}
    assert per_code == {"Solo": 0}
    pie = {r.branch_name: r.total_customers for r in reports.widget_branch_customers(m).collect()}
    assert pie == {"Twin": 3, "Solo": 0}


def test_cli_lists_reports(capsys):
    from ledgerflow.__main__ import main

    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "report_top_customers" in out and "widget_month_amount" in out and len(out) == 23
