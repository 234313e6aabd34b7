"""Data contracts.

One ``StructType`` per entity is the silver contract.  Bronze has the same
column names, every column a nullable string (the extract lands text).
Silver adds two audit columns.  Money is ``decimal(18,2)`` so sums are exact
and independent of partitioning; timestamps are ``timestamp_ntz`` (source
systems hand over wall-clock values, and the result must not depend on the
session time zone).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()

AUDIT_COLUMNS = ("insert_timestamp", "update_timestamp")


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# ---------------------------------------------------------------------------
# Entity and control tables, their columns and types (FIXTURES.md).
BRANCHES = _schema(
    ("branch_code", T.StringType(), False),
    ("branch_name", T.StringType(), False),
    ("city", T.StringType(), False),
    ("state", T.StringType(), False),
    ("region", T.StringType(), True),
    ("created_at", TS, True),
)

CUSTOMERS = _schema(
    ("customer_id", T.LongType(), False),
    ("first_name", T.StringType(), False),
    ("last_name", T.StringType(), False),
    ("date_of_birth", T.DateType(), False),
    ("pan_number", T.StringType(), True),
    ("email", T.StringType(), True),
    ("phone_number", T.StringType(), True),
    ("kyc_status", T.StringType(), True),
    ("branch_code", T.StringType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
)

ACCOUNTS = _schema(
    ("account_id", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("account_type", T.StringType(), False),
    ("balance", MONEY, False),
    ("currency", T.StringType(), True),
    ("branch_code", T.StringType(), False),
    ("status", T.StringType(), True),
    ("opened_date", T.DateType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
)

TRANSACTIONS = _schema(
    ("txn_id", T.LongType(), False),
    ("account_id", T.LongType(), False),
    ("txn_type", T.StringType(), False),
    ("amount", MONEY, False),
    ("txn_timestamp", TS, False),
    ("channel", T.StringType(), True),
    ("status", T.StringType(), True),
    ("created_at", TS, True),
)

CREDIT_BUREAU_REPORTS = _schema(
    ("customer_id", T.LongType(), True),
    ("credit_score", T.IntegerType(), True),
    ("risk_grade", T.StringType(), True),
    ("external_active_loans", T.IntegerType(), True),
    ("external_overdue_amount", MONEY, True),
    ("bureau_pull_date", TS, True),
)

PAYMENT_GATEWAY_LOGS = _schema(
    ("txn_id", T.LongType(), True),
    ("gateway_name", T.StringType(), True),
    ("gateway_status", T.StringType(), True),
    ("response_code", T.StringType(), True),
    ("processing_time_ms", T.LongType(), True),
    ("device_type", T.StringType(), True),
    ("geo_location", T.StringType(), True),
    ("processed_timestamp", TS, True),
)

ENTITIES: dict[str, T.StructType] = {
    "branches": BRANCHES,
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "credit_bureau_reports": CREDIT_BUREAU_REPORTS,
    "payment_gateway_logs": PAYMENT_GATEWAY_LOGS,
}


def bronze_schema(entity: str) -> T.StructType:
    """Landing schema: same names as the contract, every column a string."""
    return T.StructType(
        [T.StructField(f.name, T.StringType(), True) for f in ENTITIES[entity].fields]
    )


# ---------------------------------------------------------------- control
TABLES = _schema(
    ("table_id", T.IntegerType(), True),
    ("table_name", T.StringType(), True),
    ("source_system", T.StringType(), True),
    ("source_schema", T.StringType(), True),
    ("schema_list", T.StringType(), True),
    ("source_table", T.StringType(), True),
    ("source_path", T.StringType(), True),
    ("target_layer", T.StringType(), True),
    ("bronze_schema", T.StringType(), True),
    ("silver_schema", T.StringType(), True),
    ("gold_schema", T.StringType(), True),
    ("active_flag", T.BooleanType(), True),
    ("load_order", T.IntegerType(), True),
    ("created_at", T.TimestampType(), True),
)

TABLE_PARAMETERS = _schema(
    ("table_id", T.IntegerType(), True),
    ("parameter_name", T.StringType(), True),
    ("parameter_value", T.StringType(), True),
    ("created_at", T.TimestampType(), True),
)

TABLE_WATERMARKS = _schema(
    ("table_id", T.IntegerType(), True),
    ("last_watermark_value", T.StringType(), True),
    ("last_updated_at", T.TimestampType(), True),
    ("last_run_id", T.LongType(), True),
)

PIPELINE_RUNS = _schema(
    ("run_id", T.LongType(), True),
    ("table_id", T.IntegerType(), True),
    ("layer", T.StringType(), True),
    ("start_time", T.TimestampType(), True),
    ("end_time", T.TimestampType(), True),
    ("status", T.StringType(), True),
    ("number_of_records", T.LongType(), True),
    ("error_message", T.StringType(), True),
    ("duration", T.IntegerType(), True),
    ("kpi_id", T.IntegerType(), True),
)

GOLD_LAYER_KPI = _schema(
    ("kpi_id", T.IntegerType(), True),
    ("kpi_name", T.StringType(), True),
    ("kpi_path", T.StringType(), True),
    ("execution_date", T.DateType(), True),
    ("created_timestamp", T.TimestampType(), True),
)

RUN_EXECUTION_DETAILS = _schema(
    ("run_id", T.StringType(), True),
    ("run_start", T.TimestampType(), True),
    ("run_end", T.TimestampType(), True),
    ("run_duration", T.IntegerType(), True),
)

CONTROL_TABLES: dict[str, T.StructType] = {
    "tables": TABLES,
    "table_parameters": TABLE_PARAMETERS,
    "table_watermarks": TABLE_WATERMARKS,
    "pipeline_runs": PIPELINE_RUNS,
    "gold_layer_kpi": GOLD_LAYER_KPI,
    "run_execution_details": RUN_EXECUTION_DETAILS,
}
