"""Report queries over the gold marts, and the chart-level roll-ups.

Each report takes the mart DataFrame(s) it reads, so it runs the same over
freshly built (lazy) marts or over stored gold tables.  Reports are small
aggregations of already aggregated rows; limited sorts compile to
``TakeOrderedAndProject`` (a per-partition top-k then a merge), never a
global sort.  Every limited sort ends with a tiebreak over all output
columns so the rows returned are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

Marts = dict[str, DataFrame]


# ----------------------------------------------------------- report queries
def total_customers(m: Marts) -> DataFrame:
    return m["customer_360"].agg(F.count(F.lit(1)).alias("total_customers"))


def total_deposits(m: Marts) -> DataFrame:
    return m["customer_360"].agg(S.round_half_up(F.sum("total_balance"), 2).alias("total_deposits"))


def total_transactions(m: Marts) -> DataFrame:
    return m["customer_360"].agg(
        S.round_half_up(F.sum("total_transaction_amount"), 2).alias("total_transaction_value")
    )


def high_risk(m: Marts) -> DataFrame:
    return (
        m["customer_360"]
        .where(F.col("risk_grade") == S.RISK_HIGH)
        .agg(F.count(F.lit(1)).alias("high_risk_customers"))
    )


def channel_summary(m: Marts) -> DataFrame:
    return m["transaction_channel_summary"]


def by_segment(m: Marts) -> DataFrame:
    return m["customer_360"].groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


def by_risk_grade(m: Marts) -> DataFrame:
    return (
        m["customer_360"]
        .where(F.col("risk_grade").isNotNull())
        .groupBy("risk_grade")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def top_customers(m: Marts, k: int = 10) -> DataFrame:
    """Ten largest customers by *rounded* balance (the sort binds to the alias)."""
    return (
        m["customer_360"]
        .select(
            "customer_name",
            S.round_half_up("total_balance").alias("total_balance"),
            "branch_name",
            "risk_grade",
        )
        .orderBy(
            F.col("total_balance").desc_nulls_last(),
            F.col("customer_name").asc_nulls_last(),
            F.col("branch_name").asc_nulls_last(),
            F.col("risk_grade").asc_nulls_last(),
        )
        .limit(k)
    )


def branch_customers(m: Marts) -> DataFrame:
    return m["branch_performance"].select("branch_name", "total_customers")


def branch_deposits(m: Marts) -> DataFrame:
    return m["branch_performance"].select(
        "branch_code", S.round_half_up("total_deposits").alias("total_deposits")
    )


def daily_amount(m: Marts) -> DataFrame:
    return (
        m["daily_bank_kpi"]
        .groupBy("txn_date")
        .agg(S.round_half_up(F.sum("total_transaction_amount")).alias("total_transaction_amount"))
    )


def top_dates(m: Marts, k: int = 5) -> DataFrame:
    return daily_amount(m).orderBy(
        F.col("total_transaction_amount").desc_nulls_last(), F.col("txn_date").asc_nulls_last()
    ).limit(k)


# ------------------------------------------------- chart-level roll-ups
def _sum_all(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.sum(column).alias(alias))


def _sum_by(df: DataFrame, key, column: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(column).alias(alias))


def widget_total_customers(m: Marts) -> DataFrame:
    return _sum_all(total_customers(m), "total_customers", "total_customers")


def widget_total_deposits(m: Marts) -> DataFrame:
    return _sum_all(total_deposits(m), "total_deposits", "total_deposits")


def widget_total_transactions(m: Marts) -> DataFrame:
    return _sum_all(total_transactions(m), "total_transaction_value", "total_transaction_value")


def widget_high_risk(m: Marts) -> DataFrame:
    return _sum_all(high_risk(m), "high_risk_customers", "high_risk_customers")


def widget_channel(m: Marts) -> DataFrame:
    return _sum_by(channel_summary(m), "channel", "total_transaction", "total_transaction")


def widget_segment(m: Marts) -> DataFrame:
    return _sum_by(by_segment(m), "customer_segment", "customers", "customers")


def widget_risk_grade(m: Marts) -> DataFrame:
    return _sum_by(by_risk_grade(m), "risk_grade", "customers", "customers")


def widget_branch_customers(m: Marts) -> DataFrame:
    """Pie by branch name: branches sharing a name merge into one slice."""
    return _sum_by(branch_customers(m), "branch_name", "total_customers", "total_customers")


def widget_branch_deposits(m: Marts) -> DataFrame:
    return _sum_by(branch_deposits(m), "branch_code", "total_deposits", "total_deposits")


def widget_top_dates_month(m: Marts) -> DataFrame:
    """The five top dates truncated to months and summed (dates in one month merge)."""
    return _sum_by(
        top_dates(m), S.month_of("txn_date").alias("txn_month"),
        "total_transaction_amount", "total_transaction_amount",
    )


def widget_month_amount(m: Marts) -> DataFrame:
    return _sum_by(
        daily_amount(m), S.month_of("txn_date").alias("txn_month"),
        "total_transaction_amount", "total_transaction_amount",
    )


# key -> (builder, marts it reads)
REPORTS = {
    "report_total_customers": (total_customers, ("customer_360",)),
    "report_total_deposits": (total_deposits, ("customer_360",)),
    "report_total_transactions": (total_transactions, ("customer_360",)),
    "report_high_risk": (high_risk, ("customer_360",)),
    "report_channel_summary": (channel_summary, ("transaction_channel_summary",)),
    "report_segment": (by_segment, ("customer_360",)),
    "report_risk_grade": (by_risk_grade, ("customer_360",)),
    "report_top_customers": (top_customers, ("customer_360",)),
    "report_branch_customers": (branch_customers, ("branch_performance",)),
    "report_branch_deposits": (branch_deposits, ("branch_performance",)),
    "report_top_dates": (top_dates, ("daily_bank_kpi",)),
    "report_daily_amount": (daily_amount, ("daily_bank_kpi",)),
    "widget_total_customers": (widget_total_customers, ("customer_360",)),
    "widget_total_deposits": (widget_total_deposits, ("customer_360",)),
    "widget_total_transactions": (widget_total_transactions, ("customer_360",)),
    "widget_high_risk": (widget_high_risk, ("customer_360",)),
    "widget_channel": (widget_channel, ("transaction_channel_summary",)),
    "widget_segment": (widget_segment, ("customer_360",)),
    "widget_risk_grade": (widget_risk_grade, ("customer_360",)),
    "widget_branch_customers": (widget_branch_customers, ("branch_performance",)),
    "widget_branch_deposits": (widget_branch_deposits, ("branch_performance",)),
    "widget_top_dates_month": (widget_top_dates_month, ("daily_bank_kpi",)),
    "widget_month_amount": (widget_month_amount, ("daily_bank_kpi",)),
}
