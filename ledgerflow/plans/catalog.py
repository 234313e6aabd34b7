"""Registered queries: key -> Spark callable, key -> DuckDB oracle SQL.

Every callable reads the driver's tables (whole tables, mapped to the
banking entities by ``sources.testdata``) and returns a lazy DataFrame whose
output is normalised by ``for_comparison`` (money as double, integral
numbers as bigint).  The oracle side lives in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import for_comparison
from ..sources import testdata
from . import gold, reports
from .oracle import with_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None):
    def deco(fn: Callable[[dict[str, DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_comparison(fn(testdata.silver_tables(spark, sf_dir)))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def _oracle_mart(name: str) -> str:
    return with_tables(f"SELECT * FROM {name}")


# --------------------------------------------------------------- gold marts
for _name in (
    "customer_360",
    "branch_performance",
    "daily_bank_kpi",
    "risk_customer_summary",
    "risk_customer_summary_dedup",
    "transaction_channel_summary",
):
    _builder = getattr(gold, _name)
    register(_name, _oracle_mart(_name))(lambda silver, _b=_builder: _b(silver))


# ---------------------------------------------------- reports and widgets
def _marts(silver: dict[str, DataFrame], names) -> dict[str, DataFrame]:
    return {n: getattr(gold, n)(silver) for n in names}


REPORT_SQL = {
    "report_total_customers": "SELECT COUNT(1) AS total_customers FROM customer_360",
    "report_total_deposits": "SELECT ROUND(SUM(total_balance), 2) AS total_deposits FROM customer_360",
    "report_total_transactions": (
        "SELECT ROUND(SUM(total_transaction_amount), 2) AS total_transaction_value FROM customer_360"
    ),
    "report_high_risk": (
        "SELECT COUNT(*) AS high_risk_customers FROM customer_360 WHERE risk_grade = 'HIGH'"
    ),
    "report_channel_summary": "SELECT * FROM transaction_channel_summary",
    "report_segment": (
        "SELECT customer_segment, COUNT(*) AS customers FROM customer_360 GROUP BY customer_segment"
    ),
    "report_risk_grade": (
        "SELECT risk_grade, COUNT(*) AS customers FROM customer_360 "
        "WHERE risk_grade IS NOT NULL GROUP BY risk_grade"
    ),
    "report_top_customers": (
        "SELECT customer_name, ROUND(total_balance) AS total_balance, branch_name, risk_grade "
        "FROM customer_360 ORDER BY total_balance DESC NULLS LAST, customer_name ASC NULLS LAST, "
        "branch_name ASC NULLS LAST, risk_grade ASC NULLS LAST LIMIT 10"
    ),
    "report_branch_customers": "SELECT branch_name, total_customers FROM branch_performance",
    "report_branch_deposits": (
        "SELECT branch_code, ROUND(total_deposits) AS total_deposits FROM branch_performance"
    ),
    "report_top_dates": (
        "SELECT txn_date, ROUND(SUM(total_transaction_amount)) AS total_transaction_amount "
        "FROM daily_bank_kpi GROUP BY txn_date "
        "ORDER BY total_transaction_amount DESC NULLS LAST, txn_date ASC NULLS LAST LIMIT 5"
    ),
    "report_daily_amount": (
        "SELECT txn_date, ROUND(SUM(total_transaction_amount)) AS total_transaction_amount "
        "FROM daily_bank_kpi GROUP BY txn_date"
    ),
}

WIDGET_SQL = {
    "widget_total_customers": (
        "SELECT SUM(total_customers) AS total_customers FROM ({report_total_customers})"
    ),
    "widget_total_deposits": "SELECT SUM(total_deposits) AS total_deposits FROM ({report_total_deposits})",
    "widget_total_transactions": (
        "SELECT SUM(total_transaction_value) AS total_transaction_value FROM ({report_total_transactions})"
    ),
    "widget_high_risk": (
        "SELECT SUM(high_risk_customers) AS high_risk_customers FROM ({report_high_risk})"
    ),
    "widget_channel": (
        "SELECT channel, SUM(total_transaction) AS total_transaction "
        "FROM ({report_channel_summary}) GROUP BY channel"
    ),
    "widget_segment": (
        "SELECT customer_segment, SUM(customers) AS customers FROM ({report_segment}) "
        "GROUP BY customer_segment"
    ),
    "widget_risk_grade": (
        "SELECT risk_grade, SUM(customers) AS customers FROM ({report_risk_grade}) GROUP BY risk_grade"
    ),
    "widget_branch_customers": (
        "SELECT branch_name, SUM(total_customers) AS total_customers "
        "FROM ({report_branch_customers}) GROUP BY branch_name"
    ),
    "widget_branch_deposits": (
        "SELECT branch_code, SUM(total_deposits) AS total_deposits "
        "FROM ({report_branch_deposits}) GROUP BY branch_code"
    ),
    "widget_top_dates_month": (
        "SELECT CAST(date_trunc('month', txn_date) AS DATE) AS txn_month, "
        "SUM(total_transaction_amount) AS total_transaction_amount "
        "FROM ({report_top_dates}) GROUP BY 1"
    ),
    "widget_month_amount": (
        "SELECT CAST(date_trunc('month', txn_date) AS DATE) AS txn_month, "
        "SUM(total_transaction_amount) AS total_transaction_amount "
        "FROM ({report_daily_amount}) GROUP BY 1"
    ),
}


def _report_sql(key: str) -> str:
    if key in REPORT_SQL:
        return REPORT_SQL[key]
    return WIDGET_SQL[key].format(**REPORT_SQL)


for _key, (_fn, _reads) in reports.REPORTS.items():
    register(_key, with_tables(_report_sql(_key)))(
        lambda silver, _f=_fn, _r=_reads: _f(_marts(silver, _r))
    )


# Operator-level keys register themselves on import.
from . import operator_queries  # noqa: E402,F401
