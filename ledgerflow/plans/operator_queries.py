"""Operator-level registered queries (load operators, joins, aggregates, scalars).

Each runs over whole mapped tables.  Incremental scenarios split one table
by its own mark column into an earlier "target" state and a later "source"
batch, which is how the operator meets its input in the pipeline.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import conform as C
from ..operators.aggregate import account_totals, latest_per_key, transaction_totals
from ..operators.merge import merge_conflicts, merge_upsert
from ..operators.watermark import watermark_filter, watermark_max, watermark_upsert
from ..session import checkpoint_dir
from ..sources.store import TableStore
from . import gold, registry
from .catalog import register

# ---------------------------------------------------------------------------
# Fixed values for the scenarios below (marks and split points).
ACCOUNTS_TARGET_BEFORE = "1998-01-01 00:00:00"
ACCOUNTS_SOURCE_AFTER = "1997-01-01 00:00:00"
TXN_PRIOR_LOAD_BEFORE = "1999-01-01 00:00:00"
TXN_MARK = "1999-12-31 00:00:00"
REPORTS_SPLIT = "2024-01-15 00:00:00"
RUN_TS = "2025-01-01 00:00:00"
INCREMENTAL = [  # table_id, entity, mark column
    (1, "customers", "updated_at"),
    (2, "accounts", "updated_at"),
    (3, "transactions", "txn_timestamp"),
    (5, "credit_bureau_reports", "bureau_pull_date"),
    (6, "payment_gateway_logs", "processed_timestamp"),
]
# ---------------------------------------------------------------------------

SQL_INCREMENTAL_MAX = " UNION ALL ".join(
    f"SELECT {tid} AS table_id, CAST(MAX({col}) AS VARCHAR) AS mark FROM {ent}" for tid, ent, col in INCREMENTAL
)


def _ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


def _accounts_split(s) -> tuple[DataFrame, DataFrame]:
    a = s["accounts"]
    target = a.where(F.col("updated_at") < _ts(ACCOUNTS_TARGET_BEFORE)).withColumn("status", F.lit("STALE"))
    source = a.where(F.col("updated_at") > _ts(ACCOUNTS_SOURCE_AFTER))
    return target, source


SQL_ACCOUNTS_SPLIT = f"""
tgt AS (SELECT * REPLACE ('STALE' AS status) FROM accounts WHERE updated_at < TIMESTAMP '{ACCOUNTS_TARGET_BEFORE}'),
src AS (SELECT * FROM accounts WHERE updated_at > TIMESTAMP '{ACCOUNTS_SOURCE_AFTER}')"""


def _with(extra_ctes: str, body: str) -> str:
    from .oracle import ENTITY_CTES, MART_CTES

    return f"WITH {ENTITY_CTES},{MART_CTES},{extra_ctes}\n{body}"


def _sql(body: str) -> str:
    from .oracle import with_tables

    return with_tables(body)


# ------------------------------------------------------------ scans/sources
@register("scan_table", _sql("SELECT * FROM transactions"))
def scan_table(s):
    return s["transactions"]


BRANCH_COLUMNS = registry.SEED_TABLES[3][4]
ACCOUNT_COLUMNS = registry.SEED_TABLES[1][4]
TXN_COLUMNS = registry.SEED_TABLES[2][4]


@register("extract_full", _sql(
    "SELECT branch_code, branch_name, city, state, region, created_at FROM branches"))
def extract_full(s):
    from ..sources.jdbc import extract_full as ext

    return ext(s["branches"], C.parse_column_list(BRANCH_COLUMNS))


@register("extract_incremental", _sql(
    "SELECT account_id, customer_id, account_type, balance, currency, branch_code, status, opened_date, "
    f"created_at, updated_at FROM accounts WHERE updated_at > TIMESTAMP '{ACCOUNTS_TARGET_BEFORE}'"))
def extract_incremental(s):
    from ..sources.jdbc import extract_incremental as ext

    return ext(s["accounts"], C.parse_column_list(ACCOUNT_COLUMNS), "UPDATED_AT", ACCOUNTS_TARGET_BEFORE)


@register("land_as_string", _sql(
    "SELECT CAST(txn_id AS VARCHAR) AS txn_id, CAST(account_id AS VARCHAR) AS account_id, "
    "CAST(txn_type AS VARCHAR) AS txn_type, CAST(amount AS VARCHAR) AS amount, "
    "CAST(txn_timestamp AS VARCHAR) AS txn_timestamp, CAST(channel AS VARCHAR) AS channel, "
    "CAST(status AS VARCHAR) AS status FROM transactions"))
def land_as_string(s):
    return C.land_as_string(s["transactions"], C.parse_column_list(TXN_COLUMNS))


@register("silver_conform", _sql("SELECT * FROM transactions"))
def silver_conform(s):
    from ..schemas import TRANSACTIONS

    landed = C.land_as_string(s["transactions"])
    return C.conform(landed, TRANSACTIONS)


# ------------------------------------------------------------------ loads
def _new_store(s) -> TableStore:
    """A table store of its own in the folder that the cluster shares."""
    spark = s["accounts"].sparkSession
    return TableStore(spark, f"{checkpoint_dir(spark)}/store-{uuid.uuid4().hex}")


@register("load_full", _sql(
    f"SELECT *, TIMESTAMP '{RUN_TS}' AS insert_timestamp, TIMESTAMP '{RUN_TS}' AS update_timestamp "
    "FROM branches"))
def load_full(s):
    """Written as a snapshot, over an earlier one, and read again."""
    store = _new_store(s)
    store.write_snapshot("silver", "branches", s["branches"])
    store.write_snapshot("silver", "branches", C.add_audit_columns(s["branches"], _ts(RUN_TS)), run_id=1)
    return store.read("silver", "branches")


@register("load_append", _with(
    f"""prior AS (SELECT *, 1 AS run_id FROM transactions WHERE txn_timestamp < TIMESTAMP '{TXN_PRIOR_LOAD_BEFORE}')""",
    """SELECT * FROM prior
       UNION ALL
       SELECT *, 2 AS run_id FROM transactions WHERE txn_timestamp > (SELECT MAX(txn_timestamp) FROM prior)"""))
def load_append(s):
    """Two loads, the second past the mark that the first has reached; the second run twice."""
    store, t = _new_store(s), s["transactions"]
    prior = t.where(F.col("txn_timestamp") < _ts(TXN_PRIOR_LOAD_BEFORE)).withColumn("run_id", F.lit(1))
    store.append("silver", "transactions", prior, 1, mark=F.max("txn_timestamp"))
    batch = watermark_filter(t, "txn_timestamp", store.state("silver", "transactions").mark).withColumn("run_id", F.lit(2))
    for _ in range(2):
        store.append("silver", "transactions", batch, 2, mark=F.max("txn_timestamp"))
    return store.read("silver", "transactions")


@register("upsert_touched_parts", _with(SQL_ACCOUNTS_SPLIT, """
    SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.account_id = t.account_id)
    UNION ALL
    SELECT s.* FROM src s LEFT JOIN tgt t ON s.account_id = t.account_id"""))
def upsert_touched_parts(s):
    """The MERGE as the pipeline runs it: a keyed table, of which the batch's partitions are rewritten."""
    store = _new_store(s)
    target, source = _accounts_split(s)
    store.upsert("silver", "accounts", target, ["account_id"], 1)
    store.upsert("silver", "accounts", source, ["account_id"], 2)
    return store.read("silver", "accounts")


@register("merge_upsert", _with(SQL_ACCOUNTS_SPLIT, """
    SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.account_id = t.account_id)
    UNION ALL
    SELECT s.* FROM src s LEFT JOIN tgt t ON s.account_id = t.account_id"""))
def merge_upsert_q(s):
    target, source = _accounts_split(s)
    return merge_upsert(target, source, ["account_id"])


@register("merge_upsert_insert_only", _with(SQL_ACCOUNTS_SPLIT, """
    SELECT * FROM tgt
    UNION ALL
    SELECT s.* FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.account_id = s.account_id)"""))
def merge_insert_only(s):
    target, source = _accounts_split(s)
    return merge_upsert(target, source, ["account_id"], update=False)


@register("merge_upsert_update_only", _with(SQL_ACCOUNTS_SPLIT, """
    SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.account_id = t.account_id)
    UNION ALL
    SELECT s.* FROM src s JOIN tgt t ON s.account_id = t.account_id"""))
def merge_update_only(s):
    target, source = _accounts_split(s)
    return merge_upsert(target, source, ["account_id"], insert=False)


@register("merge_conflicts", _with(f"""
    rtgt AS (SELECT * FROM credit_bureau_reports WHERE bureau_pull_date <= TIMESTAMP '{REPORTS_SPLIT}'),
    rsrc AS (SELECT * FROM credit_bureau_reports WHERE bureau_pull_date > TIMESTAMP '{REPORTS_SPLIT}')""", """
    SELECT customer_id, COUNT(*) AS source_rows FROM rsrc
    WHERE customer_id IN (SELECT customer_id FROM rtgt)
    GROUP BY customer_id HAVING COUNT(*) > 1"""))
def merge_conflicts_q(s):
    r = s["credit_bureau_reports"]
    split = _ts(REPORTS_SPLIT)
    return merge_conflicts(r.where(F.col("bureau_pull_date") <= split),
                           r.where(F.col("bureau_pull_date") > split), ["customer_id"])


@register("merge_upsert_latest", _with(f"""
    rtgt AS (SELECT * FROM credit_bureau_reports WHERE bureau_pull_date <= TIMESTAMP '{REPORTS_SPLIT}'),
    rsrc AS (
        SELECT customer_id, credit_score, risk_grade, external_active_loans, external_overdue_amount,
               bureau_pull_date
        FROM (SELECT *, ROW_NUMBER() OVER (
                  PARTITION BY customer_id
                  ORDER BY bureau_pull_date DESC NULLS LAST, credit_score DESC NULLS LAST,
                           risk_grade DESC NULLS LAST, external_active_loans DESC NULLS LAST,
                           external_overdue_amount DESC NULLS LAST) AS rn
              FROM credit_bureau_reports WHERE bureau_pull_date > TIMESTAMP '{REPORTS_SPLIT}')
        WHERE rn = 1)""", """
    SELECT t.* FROM rtgt t WHERE NOT EXISTS (SELECT 1 FROM rsrc s WHERE s.customer_id = t.customer_id)
    UNION ALL
    SELECT s.* FROM rsrc s LEFT JOIN rtgt t ON s.customer_id = t.customer_id"""))
def merge_upsert_latest(s):
    """The credit feed's merge: latest source row per key, then MERGE."""
    from ..operators.merge import latest_then_merge

    r = s["credit_bureau_reports"]
    split = _ts(REPORTS_SPLIT)
    return latest_then_merge(r.where(F.col("bureau_pull_date") <= split),
                             r.where(F.col("bureau_pull_date") > split),
                             ["customer_id"], ["bureau_pull_date"], keep_from_target=())


@register("add_column", _sql("SELECT *, CAST(NULL AS VARCHAR) AS risk_flag FROM accounts"))
def add_column(s):
    return C.add_column(s["accounts"], "risk_flag", "string")


@register("update_where", _sql(
    "SELECT * REPLACE (CASE WHEN status = 'DORMANT' AND opened_date < DATE '1997-01-01' "
    "THEN 'ACTIVE' ELSE status END AS status) FROM accounts"))
def update_where(s):
    a = s["accounts"]
    pred = (F.col("status") == "DORMANT") & (F.col("opened_date") < F.lit("1997-01-01").cast("date"))
    return C.update_where(a, pred, {"status": "ACTIVE"})


# ------------------------------------------------------------ watermarks
@register("watermark_filter", _sql(
    f"SELECT * FROM transactions WHERE txn_timestamp > TIMESTAMP '{TXN_MARK}'"))
def watermark_filter_q(s):
    return watermark_filter(s["transactions"], "txn_timestamp", TXN_MARK)


def _incremental_marks(s) -> DataFrame:
    parts = [
        watermark_max(s[ent], col).select(F.lit(tid).alias("table_id"), "mark")
        for tid, ent, col in INCREMENTAL
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("watermark_max", _sql(SQL_INCREMENTAL_MAX))
def watermark_max_q(s):
    return _incremental_marks(s)


@register("watermark_upsert", _with(
    "seed(table_id, last_watermark_value) AS (VALUES "
    + ", ".join(f"({tid}, '{v}')" for tid, v in registry.SEED_WATERMARKS)
    + f"), newm AS ({SQL_INCREMENTAL_MAX})",
    """SELECT s.table_id, s.last_watermark_value, CAST(NULL AS BIGINT) AS last_run_id FROM seed s
       WHERE s.table_id NOT IN (SELECT table_id FROM newm WHERE mark IS NOT NULL)
       UNION ALL
       SELECT table_id, mark, 7 FROM newm WHERE mark IS NOT NULL"""))
def watermark_upsert_q(s):
    spark = s["accounts"].sparkSession
    marks = registry.seed_control_tables(spark)["table_watermarks"]
    out = watermark_upsert(marks, _incremental_marks(s), run_id=7, updated_at=_ts(RUN_TS))
    return out.select("table_id", "last_watermark_value", "last_run_id")


# ------------------------------------------------------------- run audit
ENTITY_IDS = [(1, "customers"), (2, "accounts"), (3, "transactions"), (4, "branches"),
              (5, "credit_bureau_reports"), (6, "payment_gateway_logs")]
SQL_COUNTS = " UNION ALL ".join(
    f"SELECT {tid} AS table_id, '{ent}' AS table_name, COUNT(*) AS number_of_records FROM {ent}"
    for tid, ent in ENTITY_IDS
)


def _counts(s) -> DataFrame:
    """Rows per entity: one aggregation over the union of the (column-less)
    entity scans, grouped by table id."""
    tagged = None
    for tid, ent in ENTITY_IDS:
        part = s[ent].select(F.lit(tid).alias("table_id"), F.lit(ent).alias("table_name"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("table_id", "table_name").agg(F.count(F.lit(1)).alias("number_of_records"))


@register("load_row_counts", _sql(SQL_COUNTS))
def load_row_counts(s):
    return _counts(s)


@register("run_audit_upsert", _with(f"cnt AS ({SQL_COUNTS})", """
    SELECT 102 AS run_id, 'BRONZE' AS layer, table_id, 'FAILED' AS status,
           CAST(NULL AS BIGINT) AS number_of_records FROM cnt
    UNION ALL
    SELECT 102, 'SILVER', table_id, 'COMPLETED', number_of_records FROM cnt"""))
def run_audit_upsert_q(s):
    counts = _counts(s)
    first = counts.select(F.lit(102).cast("bigint").alias("run_id"), F.col("table_id").cast("int"),
                          F.lit(None).cast("bigint").alias("number_of_records"))
    bronze = first.withColumn("layer", F.lit("BRONZE")).withColumn("status", F.lit("FAILED"))
    silver_failed = first.withColumn("layer", F.lit("SILVER")).withColumn("status", F.lit("FAILED"))
    runs = _audit_frame(bronze.unionByName(silver_failed))
    retry = _audit_frame(
        counts.select(F.lit(102).cast("bigint").alias("run_id"), F.col("table_id").cast("int"),
                      F.col("number_of_records").cast("bigint"))
        .withColumn("layer", F.lit("SILVER")).withColumn("status", F.lit("COMPLETED"))
    )
    out = registry.run_audit_upsert(runs, retry)
    return out.select("run_id", "layer", "table_id", "status", "number_of_records")


def _audit_frame(df: DataFrame) -> DataFrame:
    from ..schemas import PIPELINE_RUNS

    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in PIPELINE_RUNS.fields
    ])


@register("gold_row_counts", _sql(" UNION ALL ".join(
    f"SELECT {kid} AS kpi_id, '{name}' AS kpi_name, COUNT(*) AS number_of_records FROM {name}"
    for kid, name in registry.SEED_GOLD_KPI)))
def gold_row_counts(s):
    parts = [gold.MARTS[name](s).agg(F.lit(kid).alias("kpi_id"), F.lit(name).alias("kpi_name"),
                                     F.count(F.lit(1)).alias("number_of_records"))
             for kid, name in registry.SEED_GOLD_KPI]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------- projections / filters
@register("projection", _sql(
    "SELECT customer_id, first_name || ' ' || last_name AS customer_name, branch_code FROM customers"))
def projection(s):
    return s["customers"].select("customer_id", S.full_name("first_name", "last_name").alias("customer_name"),
                                 "branch_code")


@register("filter_equal", _sql(
    "SELECT account_id, customer_id, balance FROM accounts WHERE status = 'ACTIVE'"))
def filter_equal(s):
    return s["accounts"].where(F.col("status") == S.ACCOUNT_ACTIVE).select("account_id", "customer_id", "balance")


@register("customer_segment", _sql(
    "SELECT customer_id, wealth.held AS total_balance, CASE WHEN wealth.held < 100000 OR wealth.held IS NULL "
    "THEN 'LOW_VALUE' WHEN wealth.held < 500000 THEN 'MEDIUM_VALUE' ELSE 'HIGH_VALUE' END AS customer_segment "
    "FROM customers LEFT JOIN (SELECT customer_id AS owner, SUM(balance) AS held FROM accounts GROUP BY owner) "
    "AS wealth ON owner = customer_id"))
def customer_segment(s):
    acct = account_totals(s["accounts"])
    return s["customers"].select("customer_id").join(acct, "customer_id", "left").select(
        "customer_id", "total_balance", S.customer_segment("total_balance").alias("customer_segment"))


@register("conditional_count", _sql(
    "SELECT customer_id, SUM(CASE WHEN risk_grade = 'HIGH' THEN 1 ELSE 0 END) AS high_risk_reports, "
    "COUNT(*) AS reports FROM credit_bureau_reports GROUP BY customer_id"))
def conditional_count(s):
    return s["credit_bureau_reports"].groupBy("customer_id").agg(
        S.count_if(F.col("risk_grade") == S.RISK_HIGH).alias("high_risk_reports"),
        F.count(F.lit(1)).alias("reports"))


@register("distinct_rows", _sql("SELECT DISTINCT customer_id, risk_grade FROM credit_bureau_reports"))
def distinct_rows(s):
    return s["credit_bureau_reports"].select("customer_id", "risk_grade").distinct()


# ------------------------------------------------ windows / sorts / limits
@register("latest_per_key", _sql("SELECT * FROM newest_report"))
def latest_per_key_q(s):
    return latest_per_key(s["credit_bureau_reports"], ["customer_id"], ["bureau_pull_date"])


@register("topk", _sql(
    "SELECT account_id, customer_id, balance FROM accounts "
    "ORDER BY balance DESC NULLS LAST, account_id ASC LIMIT 10"))
def topk(s):
    return s["accounts"].select("account_id", "customer_id", "balance").orderBy(
        F.col("balance").desc_nulls_last(), F.col("account_id").asc()).limit(10)


# ------------------------------------------------------------------ joins
@register("join_inner", _sql(
    "SELECT t.txn_id, t.account_id, a.customer_id, t.amount "
    "FROM transactions t JOIN accounts a ON t.account_id = a.account_id"))
def join_inner(s):
    a = s["accounts"].select("account_id", "customer_id")
    return s["transactions"].select("txn_id", "account_id", "amount").join(a, "account_id").select(
        "txn_id", "account_id", "customer_id", "amount")


@register("join_left_chain", _sql(
    "SELECT customer_id, branch_name, NULLIF((SELECT COUNT(account_id) FROM accounts "
    "WHERE accounts.customer_id = customers.customer_id), 0) AS total_accounts, newest_report.credit_score "
    "FROM customers LEFT JOIN branches USING (branch_code) LEFT JOIN newest_report USING (customer_id)"))
def join_left_chain(s):
    acct = account_totals(s["accounts"]).select("customer_id", "total_accounts")
    latest = gold.credit_latest(s).select("customer_id", "credit_score")
    b = s["branches"].select("branch_code", "branch_name")
    return (s["customers"].select("customer_id", "branch_code")
            .join(acct, "customer_id", "left").join(b, "branch_code", "left")
            .join(latest, "customer_id", "left")
            .select("customer_id", "branch_name", "total_accounts", "credit_score"))


@register("cross_join_scalar", _sql(
    "SELECT txn_date, total_transactions, "
    "(SELECT COUNT(DISTINCT customer_id) FROM customers) AS total_customers FROM txn_days"))
def cross_join_scalar(s):
    total = s["customers"].agg(F.count_distinct("customer_id")).scalar()
    return gold.daily_transactions(s).select("txn_date", "total_transactions", total.alias("total_customers"))


@register("preaggregate_join", _sql(
    "SELECT customer_id, CASE WHEN owned > 0 THEN total_accounts END AS total_accounts, total_balance, "
    "CASE WHEN moved > 0 THEN total_txn END AS total_txn, total_txn_amount "
    "FROM customers LEFT JOIN per_customer USING (customer_id)"))
def preaggregate_join(s):
    acct = account_totals(s["accounts"])
    txn = transaction_totals(s["transactions"], s["accounts"])
    return s["customers"].select("customer_id").join(acct, "customer_id", "left").join(txn, "customer_id", "left")


@register("account_totals", _sql(
    "SELECT customer_id, total_accounts, total_balance FROM per_customer WHERE owned > 0"))
def account_totals_q(s):
    return account_totals(s["accounts"])


@register("transaction_totals", _sql(
    "SELECT customer_id, total_txn, total_txn_amount FROM per_customer WHERE moved > 0"))
def transaction_totals_q(s):
    return transaction_totals(s["transactions"], s["accounts"])


# ----------------------------------------------------------- aggregates
@register("group_sum_count", _sql(
    "SELECT channel, status, COUNT(*) AS n_rows, COUNT(txn_id) AS n_txn, SUM(amount) AS amount "
    "FROM transactions GROUP BY channel, status"))
def group_sum_count(s):
    return s["transactions"].groupBy("channel", "status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("txn_id").alias("n_txn"), F.sum("amount").alias("amount"))


@register("daily_transactions", _sql("SELECT * FROM txn_days"))
def daily_transactions(s):
    return gold.daily_transactions(s)


@register("global_aggregates", _sql(
    "SELECT COUNT(*) AS reports, AVG(credit_score) AS avg_credit_score, MAX(credit_score) AS max_credit_score, "
    "SUM(CASE WHEN risk_grade = 'HIGH' THEN 1 ELSE 0 END) AS high_risk_reports FROM credit_bureau_reports"))
def global_aggregates(s):
    return s["credit_bureau_reports"].agg(
        F.count(F.lit(1)).alias("reports"), F.avg("credit_score").alias("avg_credit_score"),
        F.max("credit_score").alias("max_credit_score"),
        S.count_if(F.col("risk_grade") == S.RISK_HIGH).alias("high_risk_reports"))


@register("count_distinct", _sql(
    "SELECT branch_code, COUNT(DISTINCT customer_id) AS customers FROM accounts GROUP BY branch_code"))
def count_distinct(s):
    return s["accounts"].groupBy("branch_code").agg(F.count_distinct("customer_id").alias("customers"))


# --------------------------------------------------------------- scalars
@register("scalar_concat_null", _sql(
    "SELECT customer_id, first_name || ' ' || last_name AS customer_name, "
    "first_name || ' ' || phone_number AS name_and_phone FROM customers"))
def scalar_concat_null(s):
    c = s["customers"]
    return c.select("customer_id", S.full_name("first_name", "last_name").alias("customer_name"),
                    S.full_name("first_name", "phone_number").alias("name_and_phone"))


@register("scalar_coalesce", _sql(
    "SELECT customer_id, COALESCE(total_accounts, 0) AS total_accounts, COALESCE(total_balance, 0) AS total_balance "
    "FROM customers LEFT JOIN per_customer USING (customer_id)"))
def scalar_coalesce(s):
    acct = account_totals(s["accounts"])
    return s["customers"].select("customer_id").join(acct, "customer_id", "left").select(
        "customer_id", S.zero_if_null("total_accounts").alias("total_accounts"),
        S.zero_if_null("total_balance").alias("total_balance"))


@register("scalar_date_trunc", _sql(
    "SELECT CAST(date_trunc('month', CAST(txn_timestamp AS DATE)) AS DATE) AS txn_month, COUNT(*) AS n_txn "
    "FROM transactions GROUP BY 1"))
def scalar_date_trunc(s):
    return s["transactions"].groupBy(S.month_of(S.day_of("txn_timestamp")).alias("txn_month")).agg(
        F.count(F.lit(1)).alias("n_txn"))


@register("scalar_round", _sql(
    "SELECT channel, ROUND(SUM(amount), 2) AS amount_2dp, ROUND(SUM(amount)) AS amount_0dp "
    "FROM transactions GROUP BY channel"))
def scalar_round(s):
    return s["transactions"].groupBy("channel").agg(
        S.round_half_up(F.sum("amount"), 2).alias("amount_2dp"), S.round_half_up(F.sum("amount")).alias("amount_0dp"))
