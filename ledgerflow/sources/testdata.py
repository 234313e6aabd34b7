"""Driver test tables -> the six banking entities.

The driver ships TPC-H-like tables.  Each entity is a projection of whole
tables (no row subsets): only the columns an entity needs are read, so the
Parquet scan prunes the rest, and filters written later on the entity reach
the scan through Catalyst.

=====================  mapping (fixed)  =====================
branches      nation x region (one branch per nation), plus one regional
              office per region that has no customers (an empty branch)
customers     customer
accounts      orders
transactions  lineitem (txn_id = l_orderkey*10 + l_linenumber, not unique)
credit_bureau_reports   events
payment_gateway_logs    events
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY, TS

ENTITY_NAMES = (
    "branches",
    "customers",
    "accounts",
    "transactions",
    "credit_bureau_reports",
    "payment_gateway_logs",
)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nation_branch_code(nationkey: Column) -> Column:
    return F.concat(F.lit("BR"), F.lpad((nationkey + 1).cast("string"), 3, "0"))


def _ts(text: str) -> Column:
    return F.lit(text).cast(TS)


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = raw(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = raw(spark, sf_dir, "region").select("r_regionkey", "r_name")
    per_nation = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        nation_branch_code(F.col("n_nationkey")).alias("branch_code"),
        F.col("n_name").alias("branch_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        _ts("2015-01-01 00:00:00").alias("created_at"),
    )
    regional_office = region.select(
        F.concat(F.lit("RO"), F.lpad((F.col("r_regionkey") + 1).cast("string"), 3, "0")).alias(
            "branch_code"
        ),
        F.concat(F.col("r_name"), F.lit(" REGIONAL OFFICE")).alias("branch_name"),
        F.col("r_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("r_name").alias("region"),
        _ts("2015-01-01 00:00:00").alias("created_at"),
    )
    return per_nation.unionByName(regional_office)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    created = _ts("2020-01-01 00:00:00")
    return c.select(
        key.alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 1 << 20).alias("last_name"),
        F.date_add(F.lit("1960-01-01").cast("date"), (key % 15000).cast("int")).alias("date_of_birth"),
        F.concat(F.lit("PAN"), F.lpad(key.cast("string"), 7, "0")).alias("pan_number"),
        F.concat(F.lit("c"), key.cast("string"), F.lit("@mail.test")).alias("email"),
        F.lit(None).cast("string").alias("phone_number"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "PENDING")
        .otherwise("VERIFIED")
        .alias("kyc_status"),
        nation_branch_code(F.col("c_nationkey")).alias("branch_code"),
        created.alias("created_at"),
        (created + F.make_dt_interval(mins=key)).alias("updated_at"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return o.select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("account_type"),
        F.col("o_totalprice").cast(MONEY).alias("balance"),
        F.lit("INR").alias("currency"),
        nation_branch_code(F.col("o_custkey") % 25).alias("branch_code"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVE")
        .when(F.col("o_orderstatus") == "P", "DORMANT")
        .otherwise("CLOSED")
        .alias("status"),
        F.col("o_orderdate").cast("date").alias("opened_date"),
        F.col("o_orderdate").cast(TS).alias("created_at"),
        F.col("o_orderdate").cast(TS).alias("updated_at"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("l_orderkey").alias("account_id"),
        F.when(F.col("l_quantity") >= 25, "DEBIT").otherwise("CREDIT").alias("txn_type"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_shipdate").cast(TS).alias("txn_timestamp"),
        F.when(F.col("l_returnflag") == "A", "UPI")
        .when(F.col("l_returnflag") == "N", "ATM")
        .otherwise("BRANCH")
        .alias("channel"),
        F.when(F.col("l_linestatus") == "O", "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("l_shipdate").cast(TS).alias("created_at"),
    )


def credit_bureau_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = raw(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("user_id").alias("customer_id"),
        (F.lit(300) + F.col("event_id") % 600).cast("int").alias("credit_score"),
        F.when(F.col("event_type") == "error", "HIGH")
        .when(F.col("event_type").isin("click", "view"), "MEDIUM")
        .otherwise("LOW")
        .alias("risk_grade"),
        (F.col("event_id") % 7).cast("int").alias("external_active_loans"),
        F.col("value").cast(MONEY).alias("external_overdue_amount"),
        F.col("ts").cast(TS).alias("bureau_pull_date"),
    )


def payment_gateway_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = raw(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    failed = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").alias("txn_id"),
        F.col("event_type").alias("gateway_name"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("gateway_status"),
        F.when(failed, "500").otherwise("200").alias("response_code"),
        (F.col("event_id") % 1000).alias("processing_time_ms"),
        F.lit("MOBILE").alias("device_type"),
        F.lit("IN").alias("geo_location"),
        F.col("ts").cast(TS).alias("processed_timestamp"),
    )


_BUILDERS = {
    "branches": branches,
    "customers": customers,
    "accounts": accounts,
    "transactions": transactions,
    "credit_bureau_reports": credit_bureau_reports,
    "payment_gateway_logs": payment_gateway_logs,
}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _BUILDERS[name](spark, sf_dir)


def silver_tables(spark: SparkSession, sf_dir: str, names=ENTITY_NAMES) -> dict[str, DataFrame]:
    """Lazy DataFrames for the entities; nothing is read until an action."""
    return {n: entity(spark, sf_dir, n) for n in names}
