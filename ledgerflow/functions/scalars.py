"""Scalar column functions used by the marts and reports.

All are built-in Catalyst expressions (they stay inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ------------------------------------------------------------------
# Fixed values the results depend on (domain codes and cut-offs).
HIGH_VALUE_FLOOR = 500000
MEDIUM_VALUE_FLOOR = 100000
SEGMENT_HIGH = "HIGH_VALUE"
SEGMENT_MEDIUM = "MEDIUM_VALUE"
SEGMENT_LOW = "LOW_VALUE"
RISK_HIGH = "HIGH"
ACCOUNT_ACTIVE = "ACTIVE"
KYC_VERIFIED = "VERIFIED"
TXN_SUCCESS = "SUCCESS"
# ------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first: str | Column, last: str | Column) -> Column:
    """``CONCAT(first, ' ', last)``: NULL when either part is NULL."""
    return F.concat(col(first), F.lit(" "), col(last))


def customer_segment(balance: str | Column) -> Column:
    """Value band of a balance; NULL (no accounts) falls through to LOW."""
    b = col(balance)
    return (
        F.when(b >= HIGH_VALUE_FLOOR, SEGMENT_HIGH)
        .when(b >= MEDIUM_VALUE_FLOOR, SEGMENT_MEDIUM)
        .otherwise(SEGMENT_LOW)
    )


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0))


def day_of(ts: str | Column) -> Column:
    """``DATE(ts)``."""
    return F.to_date(col(ts))


def month_of(d: str | Column) -> Column:
    """``DATE_TRUNC('MONTH', d)`` as a date."""
    return F.trunc(col(d), "month")


def round_half_up(c: str | Column, scale: int = 0) -> Column:
    """``ROUND`` (half away from zero on decimals, as in SQL)."""
    return F.round(col(c), scale)


def count_if(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)``: NULL on empty input, like SUM."""
    return F.sum(F.when(pred, 1).otherwise(0))


def for_comparison(df: DataFrame) -> DataFrame:
    """Output normalisation shared with the DuckDB oracle.

    decimals -> double, integral numbers -> bigint; everything else kept.
    Applied at the very end of a query only; internal arithmetic stays exact.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
