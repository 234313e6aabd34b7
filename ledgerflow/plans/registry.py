"""Control tables: what to load, how, from where, and what happened.

These tables hold a handful of rows, so reading one table's configuration
onto the driver is fine (bank data never is).  Every operator here is a
DataFrame function; ``load_config`` is the single collect.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.conform import parse_column_list

# ---------------------------------------------------------------------------
# The registry seed (tables, their load parameters, initial
# marks, gold marts).  Column lists are the contract's; marks start at
# 1900-01-01 in the three text forms the control table accepts.
SEED_TABLES = [
    # table_id, table_name, source_system, source_schema, schema_list, source_table, source_path, load_order
    (1, "customers", "oracledb", "banking",
     "CUSTOMER_ID, FIRST_NAME, LAST_NAME, DATE_OF_BIRTH, PAN_NUMBER, EMAIL, PHONE_NUMBER, KYC_STATUS, "
     "BRANCH_CODE, CREATED_AT, UPDATED_AT", "customers", None, 1),
    (2, "accounts", "sqlserver", "banking",
     "ACCOUNT_ID, CUSTOMER_ID, ACCOUNT_TYPE, BALANCE, CURRENCY, BRANCH_CODE, STATUS, OPENED_DATE, "
     "CREATED_AT, UPDATED_AT", "accounts", None, 2),
    (3, "transactions", "sqlserver", "banking",
     "TXN_ID, ACCOUNT_ID, TXN_TYPE, AMOUNT, TXN_TIMESTAMP, CHANNEL, STATUS", "transactions", None, 3),
    (4, "branches", "oracledb", "banking",
     " BRANCH_CODE,BRANCH_NAME,CITY,STATE,REGION,CREATED_AT", "branches", None, 4),
    (5, "credit_bureau_reports", "blob", "banking",
     "CUSTOMER_ID,CREDIT_SCORE,RISK_GRADE,EXTERNAL_ACTIVE_LOANS,EXTERNAL_OVERDUE_AMOUNT,BUREAU_PULL_DATE",
     None, "credit_bureau_reports/", 5),
    (6, "payment_gateway_logs", "blob", "banking",
     "TXN_ID,GATEWAY_NAME,GATEWAY_STATUS,RESPONSE_CODE,PROCESSING_TIME_MS,DEVICE_TYPE,GEO_LOCATION,"
     "PROCESSED_TIMESTAMP", None, "payment_gateway_logs/", 6),
]
SEED_PARAMETERS = [
    (1, "load_type", "MERGE"), (1, "primary_key", "customer_id"), (1, "watermark_column", "updated_at"),
    (2, "load_type", "MERGE"), (2, "primary_key", "account_id"), (2, "watermark_column", "updated_at"),
    (3, "load_type", "APPEND"), (3, "primary_key", "txn_id"), (3, "watermark_column", "txn_timestamp"),
    (4, "load_type", "FULL"), (4, "primary_key", "branch_code"),
    (5, "load_type", "MERGE"), (5, "primary_key", "customer_id"), (5, "watermark_column", "bureau_pull_date"),
    (5, "merge_dedupe", "latest"),
    (6, "load_type", "APPEND"), (6, "primary_key", "txn_id"), (6, "watermark_column", "processed_timestamp"),
]
SEED_WATERMARKS = [
    (1, "1900-01-01 00:00:00.000000"),
    (2, "1900-01-01 00:00:00.000000"),
    (3, "1900-01-01 00:00:00"),
    (5, "1900-01-01"),
    (6, "1900-01-01 00:00:00"),
]
SEED_GOLD_KPI = [
    (1, "branch_performance"),
    (2, "customer_360"),
    (3, "daily_bank_kpi"),
    (4, "risk_customer_summary"),
    (5, "transaction_channel_summary"),
]
SEED_FIRST_RUN_ID = "101"
PARAMETER_NAMES = [
    "load_type", "primary_key", "watermark_column", "merge_dedupe", "bad_rows",
]
LOAD_TYPES = ("FULL", "MERGE", "APPEND")
# ---------------------------------------------------------------------------


def seed_control_tables(spark: SparkSession, created_at: str = "2025-01-01 00:00:00") -> dict[str, DataFrame]:
    """The six control tables with their seed rows (``INSERT ... VALUES``)."""
    import datetime as dt

    ts = dt.datetime.fromisoformat(created_at)
    tables = [
        (tid, name, system, sch, cols, stable, spath, "silver", "bronze", "silver", None, True, order, ts)
        for tid, name, system, sch, cols, stable, spath, order in SEED_TABLES
    ]
    params = [(tid, n, v, ts) for tid, n, v in SEED_PARAMETERS]
    marks = [(tid, v, ts, None) for tid, v in SEED_WATERMARKS]
    kpis = [(kid, name, f"ledgerflow.plans.gold.{name}", ts.date(), ts) for kid, name in SEED_GOLD_KPI]
    runs = [(SEED_FIRST_RUN_ID, ts, ts, None)]
    S = schemas
    return {
        "tables": spark.createDataFrame(tables, S.TABLES),
        "table_parameters": spark.createDataFrame(params, S.TABLE_PARAMETERS),
        "table_watermarks": spark.createDataFrame(marks, S.TABLE_WATERMARKS),
        "pipeline_runs": spark.createDataFrame([], S.PIPELINE_RUNS),
        "gold_layer_kpi": spark.createDataFrame(kpis, S.GOLD_LAYER_KPI),
        "run_execution_details": spark.createDataFrame(runs, S.RUN_EXECUTION_DETAILS),
    }


def active_tables(tables: DataFrame) -> DataFrame:
    """Active table ids in load order (then id), one row each."""
    return (
        tables.where(F.col("active_flag"))
        .groupBy("table_id")
        .agg(F.min("load_order").alias("load_order"))
        .orderBy(F.col("load_order").asc_nulls_last(), "table_id")
    )


def next_run_id(run_details: DataFrame) -> DataFrame:
    """One row: numeric max of the stored run ids plus one (1 when empty)."""
    return run_details.agg(
        F.coalesce(F.max(F.col("run_id").cast("bigint")) + 1, F.lit(1).cast("bigint")).alias("run_id")
    )


def parameters_pivot(parameters: DataFrame) -> DataFrame:
    """Key-value parameter rows -> one typed row per table.

    A parameter name given twice with different values is an error (the
    caller would otherwise get whichever row came last).
    """
    per_name = parameters.groupBy("table_id", "parameter_name").agg(
        F.count_distinct("parameter_value").alias("_n"), F.max("parameter_value").alias("_v")
    )
    checked = per_name.select(
        "table_id",
        "parameter_name",
        F.when(
            F.col("_n") > 1,
            F.raise_error(F.concat(F.lit("conflicting values for parameter "), F.col("parameter_name"))),
        )
        .otherwise(F.col("_v"))
        .alias("parameter_value"),
    )
    return checked.groupBy("table_id").pivot("parameter_name", PARAMETER_NAMES).agg(F.first("parameter_value"))


def runtime_config(control: dict[str, DataFrame], table_id: int) -> DataFrame:
    """tables JOIN parameters LEFT JOIN marks for one table (one row)."""
    t = control["tables"].where(F.col("table_id") == table_id)
    p = parameters_pivot(control["table_parameters"].where(F.col("table_id") == table_id))
    m = control["table_watermarks"].select("table_id", "last_watermark_value")
    return t.join(p, "table_id").join(m, "table_id", "left").select(
        "table_id", "table_name", "source_system", "source_schema", "schema_list", "source_table",
        "source_path", "bronze_schema", "silver_schema", "gold_schema", "load_order",
        *PARAMETER_NAMES, "last_watermark_value",
    )


@dataclass
class TableConfig:
    table_id: int
    table_name: str
    source_system: str
    columns: list[str]
    source_table: str | None
    source_path: str | None
    bronze_schema: str
    silver_schema: str
    load_type: str
    primary_key: str | None
    watermark_column: str | None
    last_watermark_value: str | None
    merge_dedupe: str | None = None
    bad_rows: str = "fail"  # fail | quarantine
    extra: dict = field(default_factory=dict)


def load_config(control: dict[str, DataFrame], table_id: int) -> TableConfig:
    rows = runtime_config(control, table_id).collect()
    if not rows:
        raise ValueError(f"table_id {table_id} has no registry entry or no parameters")
    if len(rows) > 1:
        raise ValueError(f"table_id {table_id} has {len(rows)} registry rows")
    r = rows[0].asDict()
    load_type = (r["load_type"] or "").upper()
    if load_type not in LOAD_TYPES:
        raise ValueError(f"table {r['table_name']}: unknown load_type {r['load_type']!r}")
    if load_type == "MERGE" and not r["primary_key"]:
        raise ValueError(f"table {r['table_name']}: MERGE needs a primary_key")
    return TableConfig(
        table_id=r["table_id"],
        table_name=r["table_name"],
        source_system=(r["source_system"] or "").strip().lower(),
        columns=parse_column_list(r["schema_list"] or ""),
        source_table=r["source_table"],
        source_path=r["source_path"],
        bronze_schema=r["bronze_schema"] or "bronze",
        silver_schema=r["silver_schema"] or "silver",
        load_type=load_type,
        primary_key=r["primary_key"],
        watermark_column=r["watermark_column"] or None,  # without one, every run extracts in full
        last_watermark_value=r["last_watermark_value"],
        merge_dedupe=(r["merge_dedupe"] or None),
        bad_rows=(r["bad_rows"] or "fail").lower(),
    )


def audit_row(spark: SparkSession, run_id: int, layer: str, *, table_id=None, kpi_id=None,
              start=None, end=None, status="COMPLETED", records=None, error=None) -> DataFrame:
    duration = int((end - start).total_seconds()) if (start and end) else None
    row = (run_id, table_id, layer, start, end, status, records, error, duration, kpi_id)
    return spark.createDataFrame([row], schemas.PIPELINE_RUNS)


AUDIT_KEYS = ["run_id", "layer", "table_id", "kpi_id"]


def run_audit_upsert(runs: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Insert or replace audit rows keyed on (run_id, layer, table_id, kpi_id).

    Keyed on the layer too, so a table's SILVER entry does not overwrite its
    BRONZE entry of the same run; NULL ids (table rows have no kpi_id, mart
    rows no table_id) match each other.
    """
    from ..operators.merge import merge_upsert

    return merge_upsert(runs, new_rows, AUDIT_KEYS, keep_from_target=(), null_safe=True)
