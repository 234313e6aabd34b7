"""Gold marts, built from silver DataFrames.

Each builder takes ``silver: dict[str, DataFrame]`` (entity name -> typed
DataFrame) and returns a lazy DataFrame; the batch job writes it, the
report queries read it, and ``__spark_entry__.queries`` returns it.

Plan shape, per mart:

* the fact table (transactions) is always reduced per account before any
  join, so no join shuffles raw transactions;
* dimension lookups (branches) are plain joins: AQE turns them into
  broadcasts only after measuring the build side, and splits skewed
  partitions otherwise;
* no cross joins: global figures are scalar subqueries (computed once);
* many-to-many joins are replaced by per-side aggregates multiplied by the
  partner counts, which gives the same numbers without emitting pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.aggregate import account_totals, latest_per_key, transaction_totals

Silver = dict[str, DataFrame]


def credit_latest(silver: Silver) -> DataFrame:
    """Most recent bureau report per customer."""
    return latest_per_key(silver["credit_bureau_reports"], ["customer_id"], ["bureau_pull_date"])


def customer_360(silver: Silver, acct: DataFrame | None = None, txn: DataFrame | None = None) -> DataFrame:
    """One row per customer row: accounts, transactions, branch, latest credit report."""
    acct = account_totals(silver["accounts"]) if acct is None else acct
    txn = transaction_totals(silver["transactions"], silver["accounts"]) if txn is None else txn
    credit = credit_latest(silver).select(
        "customer_id", "credit_score", "risk_grade", "external_active_loans", "external_overdue_amount"
    )
    branch_names = silver["branches"].select("branch_code", "branch_name")
    c = silver["customers"].select("customer_id", "first_name", "last_name", "branch_code")
    # All customer_id joins first (one co-partitioned chain), the small
    # branch lookup last: even unbroadcast it never splits that chain.
    joined = (
        c.join(acct, "customer_id", "left")
        .join(txn, "customer_id", "left")
        .join(credit, "customer_id", "left")
        .join(branch_names, "branch_code", "left")
    )
    return joined.select(
        "customer_id",
        S.full_name("first_name", "last_name").alias("customer_name"),
        "branch_name",
        S.zero_if_null("total_accounts").alias("total_accounts"),
        S.zero_if_null("total_balance").alias("total_balance"),
        S.zero_if_null("total_txn").alias("total_transactions"),
        S.zero_if_null("total_txn_amount").alias("total_transaction_amount"),
        "credit_score",
        "risk_grade",
        "external_active_loans",
        "external_overdue_amount",
        S.customer_segment("total_balance").alias("customer_segment"),
    )


def branch_performance(
    silver: Silver, acct: DataFrame | None = None, txn: DataFrame | None = None
) -> DataFrame:
    """One row per branch (branches without customers included).

    Customers are attributed to their home branch (the customer's
    branch_code), and so are their accounts and transactions.  Customer
    rows are aggregated per branch code first (partial aggregation copes
    with a hot branch); only then the result meets the branch table, whose
    duplicate rows, if any, multiply sums exactly as a row-level join would.
    """
    acct = account_totals(silver["accounts"]) if acct is None else acct
    txn = transaction_totals(silver["transactions"], silver["accounts"]) if txn is None else txn
    per_customer = (
        silver["customers"]
        .select("customer_id", "branch_code")
        .join(acct, "customer_id", "left")
        .join(txn, "customer_id", "left")
    )
    # COUNT(DISTINCT customer_id) as two plain aggregations: the rows are
    # already hash-partitioned by customer_id after the joins, so the first
    # level needs no shuffle, and the second is a partial+final aggregate
    # (no Expand of every row as the generic distinct rewrite would do).
    per_branch = (
        per_customer.groupBy("branch_code", "customer_id")
        .agg(
            F.sum("total_accounts").alias("total_accounts"),
            F.sum("total_balance").alias("total_balance"),
            F.sum("total_txn").alias("total_txn"),
            F.sum("total_txn_amount").alias("total_txn_amount"),
        )
        .groupBy("branch_code")
        .agg(
            F.count("customer_id").alias("n_customers"),
            F.sum("total_accounts").alias("n_accounts"),
            F.sum("total_balance").alias("deposits"),
            F.sum("total_txn").alias("n_txn"),
            F.sum("total_txn_amount").alias("txn_amount"),
        )
    )
    # Duplicate branch rows: the row-level join would repeat a branch's
    # customers once per duplicate, so sums scale by the number of copies of
    # (code, name) while the distinct count does not.  The copies are counted
    # on the small branch table, off the critical path of the fact stages.
    branch_rows = silver["branches"].groupBy("branch_code", "branch_name").agg(
        F.count(F.lit(1)).alias("copies")
    )
    times = lambda c: S.zero_if_null(F.col(c) * F.col("copies"))
    return branch_rows.join(per_branch, "branch_code", "left").select(
        "branch_code",
        "branch_name",
        S.zero_if_null("n_customers").alias("total_customers"),
        times("n_accounts").alias("total_accounts"),
        times("deposits").alias("total_deposits"),
        times("n_txn").alias("total_transactions"),
        times("txn_amount").alias("total_transaction_amount"),
    )


def daily_transactions(silver: Silver) -> DataFrame:
    """Transactions per calendar day (NULL timestamp -> NULL day row)."""
    return (
        silver["transactions"]
        .groupBy(S.day_of("txn_timestamp").alias("txn_date"))
        .agg(
            F.count("txn_id").alias("total_transactions"),
            F.sum("amount").alias("total_transaction_amount"),
        )
    )


def bank_snapshot(silver: Silver):
    """Bank-wide figures as scalar subqueries (each a one-row aggregate)."""
    customers = silver["customers"].agg(F.count_distinct("customer_id").alias("v")).scalar()
    accounts = (
        silver["accounts"]
        .agg(F.struct(F.count("account_id").alias("n"), F.sum("balance").alias("total")).alias("v"))
        .scalar()
    )
    credit = (
        silver["credit_bureau_reports"]
        .agg(
            F.struct(
                F.avg("credit_score").alias("avg_score"),
                S.count_if(F.col("risk_grade") == S.RISK_HIGH).alias("high"),
            ).alias("v")
        )
        .scalar()
    )
    return customers, accounts, credit


def daily_bank_kpi(silver: Silver) -> DataFrame:
    """Per transaction day, with today's bank-wide totals repeated on every row."""
    customers, accounts, credit = bank_snapshot(silver)
    return (
        daily_transactions(silver)
        .withColumn("_acct", accounts)
        .withColumn("_credit", credit)
        .select(
            "txn_date",
            customers.alias("total_customers"),
            F.col("_acct.n").alias("total_accounts"),
            F.col("_acct.total").alias("total_balance"),
            "total_transactions",
            "total_transaction_amount",
            F.col("_credit.avg_score").alias("avg_credit_score"),
            F.col("_credit.high").alias("high_risk_customers"),
        )
    )


def _risk_sides(silver: Silver):
    reports = (
        silver["credit_bureau_reports"]
        .where(F.col("risk_grade") == S.RISK_HIGH)
        .groupBy("customer_id", "risk_grade")
        .agg(
            F.count(F.lit(1)).alias("n_reports"),
            F.max("credit_score").alias("credit_score"),
            F.sum("external_active_loans").alias("loans"),
            F.sum("external_overdue_amount").alias("overdue"),
        )
    )
    accounts = (
        silver["accounts"]
        .where(F.col("status") == S.ACCOUNT_ACTIVE)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n_accounts"), F.sum("balance").alias("balance"))
    )
    customers = (
        silver["customers"]
        .where(F.col("kyc_status") == S.KYC_VERIFIED)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )
    return reports.join(accounts, "customer_id").join(customers, "customer_id")


def risk_customer_summary(silver: Silver) -> DataFrame:
    """HIGH-grade customers with an ACTIVE account and VERIFIED KYC.

    Reproduces the row-level three-way join exactly, fan-out included: each
    report is counted once per (active account x customer row) and each
    balance once per (report x customer row).  Computed as per-side
    aggregates times partner counts, so no report x account pairs are built.
    """
    return _risk_sides(silver).select(
        "customer_id",
        "risk_grade",
        "credit_score",
        (F.col("loans") * F.col("n_accounts") * F.col("n_customers")).alias("external_active_loans"),
        (F.col("overdue") * F.col("n_accounts") * F.col("n_customers")).alias("external_overdue_amount"),
        (F.col("balance") * F.col("n_reports") * F.col("n_customers")).alias("total_balance"),
    )


def risk_customer_summary_dedup(silver: Silver) -> DataFrame:
    """Same population, each figure summed once over its own table."""
    return _risk_sides(silver).select(
        "customer_id",
        "risk_grade",
        "credit_score",
        F.col("loans").alias("external_active_loans"),
        F.col("overdue").alias("external_overdue_amount"),
        F.col("balance").alias("total_balance"),
    )


def transaction_channel_summary(silver: Silver) -> DataFrame:
    """SUCCESS transactions of known accounts, per channel (NULL channel kept).

    Where account ids are unique, which one count of them tells, transactions
    meet them row by row and are reduced per channel in the same task: they are
    not shuffled where adaptive execution broadcasts the ids, and once, with a
    hot account split, where it can't.  Else they are reduced per (account,
    channel) first and the partials multiplied by the rows that each id has,
    which equals the row-level join without its pairs.
    """
    success = silver["transactions"].where(F.col("status") == S.TXN_SUCCESS)
    account_ids = silver["accounts"].select("account_id").where("account_id IS NOT NULL")
    account_rows = account_ids.groupBy("account_id").agg(F.count(F.lit(1)).alias("copies"))
    if account_rows.where("copies > 1").isEmpty():
        known = success.select("account_id", "channel", "amount").join(account_ids, "account_id")
        return known.groupBy("channel").agg(
            F.count(F.lit(1)).alias("total_transaction"), S.round_half_up(F.sum("amount"), 2).alias("total_transaction_amount")
        )
    per_account = success.groupBy("account_id", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    return (
        per_account.join(account_rows, "account_id")
        .groupBy("channel")
        .agg(
            F.sum(F.col("n") * F.col("copies")).alias("total_transaction"),
            S.round_half_up(F.sum(F.col("amount") * F.col("copies")), 2).alias("total_transaction_amount"),
        )
    )


# Registry order and names as stored in the gold KPI control table.
MARTS = {
    "branch_performance": branch_performance,
    "customer_360": customer_360,
    "daily_bank_kpi": daily_bank_kpi,
    "risk_customer_summary": risk_customer_summary,
    "transaction_channel_summary": transaction_channel_summary,
}


def build(name: str, silver: Silver, totals: Callable[[], tuple[DataFrame, DataFrame]] | None = None) -> DataFrame:
    """One mart.  totals: gives the per-customer account and transaction
    totals that customer_360 and branch_performance share."""
    if totals is not None and name in ("customer_360", "branch_performance"):
        return MARTS[name](silver, *totals())
    return MARTS[name](silver)
