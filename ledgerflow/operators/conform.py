"""Landing, conforming and small table-maintenance operators.

Bronze keeps what the source sent, as text; silver casts once to the
contract.  Casts are ANSI (a bad value fails the job instead of turning
into NULL); ``reject_reason`` tells the rows that don't fit, for quarantine.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AUDIT_COLUMNS


def parse_column_list(text: str) -> list[str]:
    """``'A, B,C'`` -> ``['A', 'B', 'C']`` (the registry stores lists as text)."""
    return [c.strip() for c in text.split(",") if c.strip()]


def resolve(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Map requested names to the frame's own names, case-insensitively."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for n in names:
        if n.lower() not in by_lower:
            raise ValueError(f"column {n!r} not in {df.columns}")
        out.append(by_lower[n.lower()])
    return out


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Select a registry column list; output names in lower case."""
    cols = resolve(df, names)
    return df.select(*[F.col(c).alias(c.lower()) for c in cols])


def land_as_string(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Bronze landing: the chosen columns, every one a nullable string."""
    cols = resolve(df, names) if names is not None else df.columns
    return df.select(*[F.col(c).cast("string").alias(c.lower()) for c in cols])


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Cast to the contract, in contract column order.

    Columns the contract names but the input lacks become typed NULLs (a
    column added to the source later, or a short registry list).  With
    ``strict`` a value that does not parse raises (ANSI cast).
    """
    present = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        if f.name.lower() in present:
            c = F.col(present[f.name.lower()])
            c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name))
    extra = [F.col(c) for c in df.columns if c.lower() in AUDIT_COLUMNS]
    return df.select(*out, *extra)


def reject_reason(df: DataFrame, schema: T.StructType) -> Column:
    """Comma-separated names of the columns whose text does not fit the
    contract type (present but not castable); NULL when the row is fine."""
    present = {c.lower(): c for c in df.columns}
    failed = [
        F.when(F.col(present[f.name.lower()]).isNotNull()
               & F.col(present[f.name.lower()]).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
        if f.name.lower() in present
    ]
    reasons = F.concat_ws(",", *failed) if failed else F.lit("")
    return F.when(reasons == "", None).otherwise(reasons)


def add_audit_columns(df: DataFrame, run_ts: str | Column) -> DataFrame:
    """insert/update timestamps from one run timestamp (reruns repeat it)."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
    return df.withColumn("insert_timestamp", ts).withColumn("update_timestamp", ts)


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows, same schema (``SELECT * ... WHERE 1 = 2``); folds to an empty relation."""
    return df.where(F.lit(False))


def add_column(df: DataFrame, name: str, dtype: T.DataType | str) -> DataFrame:
    """``ALTER TABLE ADD COLUMN``: a typed NULL column, no-op if present."""
    if name.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column | object]) -> DataFrame:
    """``UPDATE t SET c = v WHERE predicate`` as a projection of the new state."""
    cond = F.coalesce(predicate, F.lit(False))
    sets = {k.lower(): (v if isinstance(v, Column) else F.lit(v)) for k, v in assignments.items()}
    out = []
    for c in df.columns:
        if c.lower() in sets:
            out.append(F.when(cond, sets[c.lower()]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
