"""DuckDB SQL for the correctness oracle.

The driver registers the raw tables as views; these strings rebuild the six
entities with the same mapping as ``sources.testdata`` and then state each
mart and report over the rows themselves, so the checks compare the Spark
plans in ``plans.gold`` and ``plans.reports`` against the literal semantics.

Output rules shared with ``functions.scalars.for_comparison``: money is cast
to DOUBLE, integral numbers to BIGINT, at the very end only.
"""

from __future__ import annotations

ENTITY_CTES = """
branches AS (
    SELECT concat('BR', lpad(CAST(n.n_nationkey + 1 AS VARCHAR), 3, '0')) AS branch_code,
           n.n_name AS branch_name, n.n_name AS city, n.n_name AS state, r.r_name AS region,
           TIMESTAMP '2015-01-01 00:00:00' AS created_at
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT concat('RO', lpad(CAST(r_regionkey + 1 AS VARCHAR), 3, '0')),
           concat(r_name, ' REGIONAL OFFICE'), r_name, r_name, r_name,
           TIMESTAMP '2015-01-01 00:00:00'
    FROM region
),
customers AS (
    SELECT c_custkey AS customer_id, 'Customer' AS first_name, substr(c_name, 10) AS last_name,
           DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS date_of_birth,
           concat('PAN', lpad(CAST(c_custkey AS VARCHAR), 7, '0')) AS pan_number,
           concat('c', CAST(c_custkey AS VARCHAR), '@mail.test') AS email,
           CAST(NULL AS VARCHAR) AS phone_number,
           CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status,
           concat('BR', lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0')) AS branch_code,
           TIMESTAMP '2020-01-01 00:00:00' AS created_at,
           TIMESTAMP '2020-01-01 00:00:00' + to_minutes(c_custkey) AS updated_at
    FROM customer
),
accounts AS (
    SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_orderpriority AS account_type,
           CAST(o_totalprice AS DECIMAL(18,2)) AS balance, 'INR' AS currency,
           concat('BR', lpad(CAST(o_custkey % 25 + 1 AS VARCHAR), 3, '0')) AS branch_code,
           CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'DORMANT' ELSE 'CLOSED' END AS status,
           CAST(o_orderdate AS DATE) AS opened_date,
           CAST(o_orderdate AS TIMESTAMP) AS created_at,
           CAST(o_orderdate AS TIMESTAMP) AS updated_at
    FROM orders
),
transactions AS (
    SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS account_id,
           CASE WHEN l_quantity >= 25 THEN 'DEBIT' ELSE 'CREDIT' END AS txn_type,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
           CAST(l_shipdate AS TIMESTAMP) AS txn_timestamp,
           CASE l_returnflag WHEN 'A' THEN 'UPI' WHEN 'N' THEN 'ATM' ELSE 'BRANCH' END AS channel,
           CASE l_linestatus WHEN 'O' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
           CAST(l_shipdate AS TIMESTAMP) AS created_at
    FROM lineitem
),
credit_bureau_reports AS (
    SELECT user_id AS customer_id, CAST(300 + event_id % 600 AS INTEGER) AS credit_score,
           CASE WHEN event_type = 'error' THEN 'HIGH'
                WHEN event_type IN ('click', 'view') THEN 'MEDIUM' ELSE 'LOW' END AS risk_grade,
           CAST(event_id % 7 AS INTEGER) AS external_active_loans,
           CAST(value AS DECIMAL(18,2)) AS external_overdue_amount,
           CAST(ts AS TIMESTAMP) AS bureau_pull_date
    FROM events
),
payment_gateway_logs AS (
    SELECT event_id AS txn_id, event_type AS gateway_name,
           CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS gateway_status,
           CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS response_code,
           event_id % 1000 AS processing_time_ms, 'MOBILE' AS device_type, 'IN' AS geo_location,
           CAST(ts AS TIMESTAMP) AS processed_timestamp
    FROM events
)"""

# Marts stated over rows (the oracle side of plans.gold): one ledger of accounts
# and account movements, summed per customer; bank-wide figures as scalar
# subqueries; the risk and channel figures straight from the joined rows.
MART_CTES = """
ledger AS (
    SELECT customer_id, account_id, balance, CAST(NULL AS BIGINT) AS txn_id, CAST(NULL AS DECIMAL(18,2)) AS amount,
           1 AS owned, 0 AS moved
    FROM accounts
    UNION ALL
    SELECT owner.customer_id, NULL, NULL, movement.txn_id, movement.amount, 0, 1
    FROM transactions AS movement, accounts AS owner
    WHERE owner.account_id = movement.account_id
),
per_customer AS (
    SELECT customer_id, COUNT(account_id) AS total_accounts, SUM(balance) AS total_balance,
           COUNT(txn_id) AS total_txn, SUM(amount) AS total_txn_amount, SUM(owned) AS owned, SUM(moved) AS moved
    FROM ledger GROUP BY customer_id
),
newest_report AS (
    SELECT DISTINCT customer_id,
           FIRST_VALUE(credit_score) OVER newest_first AS credit_score,
           FIRST_VALUE(risk_grade) OVER newest_first AS risk_grade,
           FIRST_VALUE(external_active_loans) OVER newest_first AS external_active_loans,
           FIRST_VALUE(external_overdue_amount) OVER newest_first AS external_overdue_amount,
           FIRST_VALUE(bureau_pull_date) OVER newest_first AS bureau_pull_date
    FROM credit_bureau_reports
    WINDOW newest_first AS (
        PARTITION BY customer_id
        ORDER BY bureau_pull_date DESC NULLS LAST, credit_score DESC NULLS LAST, risk_grade DESC NULLS LAST,
                 external_active_loans DESC NULLS LAST, external_overdue_amount DESC NULLS LAST)
),
customer_360 AS (
    SELECT customer_id, first_name || ' ' || last_name AS customer_name, branch_name,
           COALESCE(total_accounts, 0) AS total_accounts, COALESCE(total_balance, 0) AS total_balance,
           COALESCE(total_txn, 0) AS total_transactions, COALESCE(total_txn_amount, 0) AS total_transaction_amount,
           credit_score, risk_grade, external_active_loans, external_overdue_amount,
           CASE WHEN COALESCE(total_balance, 0) < 100000 THEN 'LOW_VALUE'
                WHEN total_balance < 500000 THEN 'MEDIUM_VALUE' ELSE 'HIGH_VALUE' END AS customer_segment
    FROM customers
    LEFT JOIN newest_report USING (customer_id)
    LEFT JOIN per_customer USING (customer_id)
    LEFT JOIN branches USING (branch_code)
),
branch_performance AS (
    SELECT branch_code, branch_name, COUNT(DISTINCT resident) AS total_customers,
           COALESCE(SUM(total_accounts), 0) AS total_accounts, COALESCE(SUM(total_balance), 0) AS total_deposits,
           COALESCE(SUM(total_txn), 0) AS total_transactions,
           COALESCE(SUM(total_txn_amount), 0) AS total_transaction_amount
    FROM branches
    LEFT JOIN (SELECT branch_code AS home, customer_id AS resident FROM customers) AS residents ON home = branch_code
    LEFT JOIN per_customer ON per_customer.customer_id = resident
    GROUP BY branch_code, branch_name
),
txn_days AS (
    SELECT CAST(txn_timestamp AS DATE) AS txn_date, COUNT(txn_id) AS total_transactions,
           SUM(amount) AS total_transaction_amount
    FROM transactions GROUP BY CAST(txn_timestamp AS DATE)
),
daily_bank_kpi AS (
    SELECT txn_date,
           (SELECT COUNT(DISTINCT customer_id) FROM customers) AS total_customers,
           (SELECT COUNT(account_id) FROM accounts) AS total_accounts,
           (SELECT SUM(balance) FROM accounts) AS total_balance,
           total_transactions, total_transaction_amount,
           (SELECT AVG(credit_score) FROM credit_bureau_reports) AS avg_credit_score,
           (SELECT COUNT(CASE WHEN risk_grade = 'HIGH' THEN 1 END) FROM credit_bureau_reports) AS high_risk_customers
    FROM txn_days
),
risk_customer_summary AS (
    SELECT customer_id, risk_grade, MAX(credit_score) AS credit_score,
           SUM(external_active_loans) AS external_active_loans,
           SUM(external_overdue_amount) AS external_overdue_amount, SUM(balance) AS total_balance
    FROM credit_bureau_reports JOIN accounts USING (customer_id) JOIN customers USING (customer_id)
    WHERE risk_grade = 'HIGH' AND status = 'ACTIVE' AND kyc_status = 'VERIFIED'
    GROUP BY customer_id, risk_grade
),
risk_customer_summary_dedup AS (
    SELECT customer_id, 'HIGH' AS risk_grade, worst AS credit_score, loans AS external_active_loans,
           overdue AS external_overdue_amount, held AS total_balance
    FROM (SELECT customer_id, MAX(credit_score) AS worst, SUM(external_active_loans) AS loans,
                 SUM(external_overdue_amount) AS overdue
          FROM credit_bureau_reports WHERE risk_grade = 'HIGH' GROUP BY customer_id) AS flagged
    JOIN (SELECT customer_id, SUM(balance) AS held FROM accounts WHERE status = 'ACTIVE'
          GROUP BY customer_id) AS active USING (customer_id)
    WHERE EXISTS (SELECT 1 FROM customers
                  WHERE customers.customer_id = flagged.customer_id AND kyc_status = 'VERIFIED')
),
transaction_channel_summary AS (
    SELECT channel, COUNT(*) AS total_transaction, ROUND(SUM(amount), 2) AS total_transaction_amount
    FROM transactions JOIN accounts USING (account_id)
    WHERE transactions.status = 'SUCCESS'
    GROUP BY channel
)"""


def with_tables(body: str, marts: bool = True) -> str:
    ctes = ENTITY_CTES + ("," + MART_CTES if marts else "")
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------------------
# Output normalisation on the DuckDB side, mirroring for_comparison():
# DECIMAL -> DOUBLE, every integral type (INTEGER, HUGEINT, ...) -> BIGINT.
# Types are found by planning each query against empty tables with the raw
# schemas (no data is read), then the query is wrapped in an outer SELECT.
RAW_SCHEMAS = {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
}
_INTEGRAL = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER",
             "UBIGINT", "UHUGEINT"}
_planner = None


def _planning_connection():
    global _planner
    if _planner is None:
        import duckdb

        con = duckdb.connect()
        for name, cols in RAW_SCHEMAS.items():
            con.sql(f"CREATE TABLE {name} ({cols})")
        _planner = con
    return _planner


def normalised(sql: str) -> str:
    """``sql`` with its output columns cast like the Spark side's output."""
    rel = _planning_connection().sql(sql)
    cols = []
    for name, dtype in zip(rel.columns, rel.types):
        t = str(dtype).upper()
        q = '"' + name.replace('"', '""') + '"'
        if t.startswith("DECIMAL"):
            cols.append(f"CAST({q} AS DOUBLE) AS {q}")
        elif t in _INTEGRAL and t != "BIGINT":
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        else:
            cols.append(q)
    return f"SELECT {', '.join(cols)} FROM (\n{sql}\n) AS oracle_q"
