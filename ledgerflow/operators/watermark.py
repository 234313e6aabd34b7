"""Stored high-water marks.

A mark is kept per table as text (the control table has one string column
for every type) and compared after casting it to the mark column's own
type.  The rule is strict: rows *after* the mark load, rows equal to it do
not, rows whose mark column is NULL never load; with no mark every row
loads.  The new mark is the maximum over the rows loaded; a NULL maximum
(nothing loaded) leaves the stored mark alone.

Landed rows hold the mark as text, which no scan can skip by.  ``order_key``
gives it a form that Parquet keeps bounds of, and ``may_be_past`` the scan's
predicate: it lets pass every row that the rule may load, and perhaps others.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import merge_upsert

#: two sessions' time zones are at most 26 hours apart
ZONES_APART = 26 * 3600 * 1_000_000
STAMPS = (T.TimestampType, T.TimestampNTZType)


def typed_mark(df: DataFrame, column: str, last_value: str | None) -> Column | None:
    if last_value is None or str(last_value).strip() == "":
        return None
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return F.lit(last_value)
    return F.lit(last_value).cast(dtype)


def watermark_filter(df: DataFrame, column: str, last_value: str | None) -> DataFrame:
    """Rows strictly after the stored mark (a pushed-down scan predicate)."""
    mark = typed_mark(df, column, last_value)
    if mark is None:
        return df
    return df.where(F.col(column) > mark)


def order_name(column: str, dtype: T.DataType) -> str:
    """The column that holds ``order_key``; another mark column or type has another name."""
    return "_order_" + re.sub(r"\W+", "_", f"{column.lower()}_{dtype.simpleString()}")


def order_key(text: Column, dtype: T.DataType) -> Column:
    """A landed mark in a type that Parquet skips by; NULL if it isn't of its type.

    Timestamps as microseconds: Spark writes them as INT96 by default, which has
    no bounds, and skips by none of those without a zone.  Other types as they are.
    """
    typed = text.try_cast(dtype)
    return F.unix_micros(typed.cast("timestamp")) if isinstance(dtype, STAMPS) else typed


def may_be_past(column: str, dtype: T.DataType, last_value: str) -> Column:
    """A predicate on ``order_name``'s column that every row past the mark meets.

    So do rows without a key, if only the mark itself is set: they were written
    without one, or their text doesn't cast, which the cast is to report.  The
    session that wrote a timestamp's key may have had another time zone, so keys
    up to ``ZONES_APART`` before the mark pass.
    """
    key = F.col(order_name(column, dtype))
    mark = F.lit(last_value).cast(dtype)
    if isinstance(dtype, STAMPS):
        mark = F.unix_micros(mark.cast("timestamp")) - F.lit(ZONES_APART)
    return (key > mark) | (key.isNull() & F.col(column).isNotNull())


def watermark_max(df: DataFrame, column: str) -> DataFrame:
    """One row: the new mark, typed (``max_value``) and as stored text (``mark``).

    The text form is Spark's own cast, which round-trips exactly (timestamps
    keep their microseconds).
    """
    m = F.max(column)
    return df.agg(m.alias("max_value")).select("max_value", F.col("max_value").cast("string").alias("mark"))


def watermark_upsert(
    marks: DataFrame,
    new_marks: DataFrame,
    run_id: int | Column | None = None,
    updated_at: str | Column | None = None,
) -> DataFrame:
    """Merge ``new_marks(table_id, mark)`` into the ``table_watermarks`` table.

    NULL marks are skipped (the stored mark stays); ``last_run_id`` is
    written on insert as well as update.
    """
    def lit_or(c, dtype):
        if c is None:
            return F.lit(None).cast(dtype)
        return c.cast(dtype) if isinstance(c, Column) else F.lit(c).cast(dtype)

    src = new_marks.where(F.col("mark").isNotNull()).select(
        F.col("table_id").cast("int").alias("table_id"),
        F.col("mark").alias("last_watermark_value"),
        lit_or(updated_at, "timestamp").alias("last_updated_at"),
        lit_or(run_id, "bigint").alias("last_run_id"),
    )
    return merge_upsert(marks, src, ["table_id"], keep_from_target=())
