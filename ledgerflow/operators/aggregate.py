"""Aggregation building blocks shared by the marts.

Every operator here aggregates partially in the map tasks, so a hot key (one
account or customer holding a third of all rows) is reduced before the
shuffle; no group is ever collected in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def account_totals(accounts: DataFrame) -> DataFrame:
    """Per customer: number of accounts and summed balance."""
    return accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("total_accounts"),
        F.sum("balance").alias("total_balance"),
    )


def transactions_per_account(transactions: DataFrame) -> DataFrame:
    """Per account: transaction count and amount (the fact table shrinks here)."""
    return transactions.groupBy("account_id").agg(
        F.count("txn_id").alias("n_txn"),
        F.sum("amount").alias("txn_amount"),
    )


def transaction_totals(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per customer: transactions of the customer's accounts (inner join).

    Transactions are first reduced to one row per account (partial and final
    aggregate), so the join shuffles per-account partials instead of raw rows
    and a hot account collapses map-side; adaptive execution broadcasts the
    owner lookup where it has measured it to be small.  Duplicate account rows
    multiply the totals exactly as the row-level join would.
    """
    owners = accounts.select("account_id", "customer_id")
    return (
        transactions_per_account(transactions)
        .join(owners, "account_id")
        .groupBy("customer_id")
        .agg(F.sum("n_txn").alias("total_txn"), F.sum("txn_amount").alias("total_txn_amount"))
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Latest row per key: ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY
    order_by DESC) = 1``.

    The maximum of a struct that holds every column once, ``order_by`` first
    and the rest in schema order, so ties resolve the same way each time
    (descending, NULLs last); rows equal on all columns are interchangeable.
    Spark aggregates structs by sorting, so each task sorts its rows, but one
    row per key and task is all that is shuffled: no window, and a hot key is
    reduced before the shuffle.
    """
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    ordering = list(order_by) + [c for c in values if c not in order_by]
    picked = F.max(F.struct(*ordering)).alias("_latest")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_latest")[c].alias(c) for c in values])
