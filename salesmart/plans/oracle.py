"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

Each text reads the driver's tables directly and spells the same mapping as
``sources.testdata``; column names equal the Spark outputs.
"""

from __future__ import annotations

FACT = """
fact AS (
  SELECT o_custkey AS customer_id, s_nationkey AS store_id, p_name AS product_name,
         CAST(o_orderdate AS DATE) AS sales_date, l_suppkey AS sales_person_id,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS total_cost, CAST(NULL AS VARCHAR) AS additional_column,
         l_linenumber AS _line
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

DIMS = """
cust AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, c_mktsegment AS address,
         lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS pincode,
         '91' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_number,
         DATE '2020-01-01' + CAST(c_custkey % 1328 AS INTEGER) AS customer_joining_date
  FROM customer
),
store AS (
  SELECT n_nationkey AS store_id, 'region ' || CAST(n_regionkey AS VARCHAR) AS store_address,
         lpad(CAST(n_regionkey AS VARCHAR), 6, '0') AS store_pincode, n_name AS store_manager_name,
         CAST(NULL AS DATE) AS store_opening_date, CAST(NULL AS VARCHAR) AS store_reviews
  FROM nation
),
team AS (
  SELECT s_suppkey AS sales_person_id, split_part(s_name, '#', 1) AS sales_person_first_name,
         split_part(s_name, '#', 2) AS sales_person_last_name, CAST(NULL AS BIGINT) AS manager_id,
         'N' AS is_manager, 'nation ' || CAST(s_nationkey AS VARCHAR) AS sales_person_address,
         lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS sales_person_pincode,
         CAST(NULL AS DATE) AS sales_person_joining_date
  FROM supplier
),
enr AS (
  SELECT f.customer_id, f.store_id, f.product_name, f.sales_date, f.sales_person_id, f.price,
         f.quantity, f.total_cost, f.additional_column, f._line,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number, c.customer_joining_date,
         s.store_address, s.store_pincode, s.store_manager_name, s.store_opening_date, s.store_reviews,
         t.sales_person_first_name, t.sales_person_last_name, t.manager_id, t.is_manager,
         t.sales_person_address, t.sales_person_pincode, t.sales_person_joining_date
  FROM fact f
  JOIN team t ON f.sales_person_id = t.sales_person_id
  JOIN store s ON f.store_id = s.store_id
  JOIN cust c ON f.customer_id = c.customer_id
),
cdet AS (
  SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost FROM enr
),
sdet AS (
  SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
         manager_id, is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost,
         strftime(sales_date, '%Y-%m') AS sales_month
  FROM enr
),
stm AS (
  SELECT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         sales_month, SUM(total_cost) AS ts
  FROM sdet GROUP BY 1, 2, 3, 4
)"""

WITH = "WITH " + FACT.strip() + "," + DIMS


def _q(body: str) -> str:
    return WITH + "\n" + body.strip()


FACT_COLS = (
    "customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost, "
    "additional_column"
)
ENRICHED_COLS = (
    FACT_COLS + ", first_name, last_name, address, pincode, phone_number, customer_joining_date, "
    "store_address, store_pincode, store_manager_name, store_opening_date, store_reviews, "
    "sales_person_first_name, sales_person_last_name, manager_id, is_manager, sales_person_address, "
    "sales_person_pincode, sales_person_joining_date"
)
SDET_COLS = (
    "store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name, "
    "manager_id, is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost, sales_month"
)


def sales_team_month_sql(partition: str) -> str:
    return _q(
        f"""
SELECT store_id, sales_person_id, full_name, sales_month, CAST(ts AS DECIMAL(10,2)) AS total_sales,
       CAST(CASE WHEN rank() OVER (PARTITION BY {partition} ORDER BY ts DESC) = 1
                 THEN ts * 0.01 ELSE 0 END AS DECIMAL(10,2)) AS incentive
FROM stm"""
    )


ORACLE: dict[str, str] = {
    "sales_fact": _q(f"SELECT {FACT_COLS} FROM fact"),
    "enriched_sales": _q(f"SELECT {ENRICHED_COLS} FROM enr"),
    "customer_mart_detail": _q("SELECT * FROM cdet"),
    "sales_team_mart_detail": _q(f"SELECT {SDET_COLS} FROM sdet"),
    "customer_month_mart": _q(
        """
SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       CAST(date_trunc('month', sales_date) AS DATE) AS sales_date_month,
       CAST(SUM(total_cost) AS DECIMAL(10,2)) AS total_sales
FROM cdet GROUP BY 1, 2, 3, 4, 5"""
    ),
    "customer_day_mart": _q(
        """
SELECT customer_id, sales_date, CAST(SUM(total_cost) AS DECIMAL(10,2)) AS total_sales
FROM cdet GROUP BY 1, 2"""
    ),
    "sales_team_month_mart": sales_team_month_sql("store_id, sales_month"),
    "sales_team_month_mart_by_month": sales_team_month_sql("sales_month"),
    "sales_team_month_mart_one_winner": _q(
        """
SELECT store_id, sales_person_id, full_name, sales_month, CAST(ts AS DECIMAL(10,2)) AS total_sales,
       CAST(CASE WHEN row_number() OVER (PARTITION BY store_id, sales_month
                                         ORDER BY ts DESC NULLS LAST, sales_person_id) = 1
                 THEN ts * 0.01 ELSE 0 END AS DECIMAL(10,2)) AS incentive
FROM stm"""
    ),
    "product_enriched_sales": _q(
        f"""
, prod AS (
  SELECT p_name AS name, CAST(MIN(p_retailprice) AS DECIMAL(10,2)) AS current_price,
         CAST(NULL AS DATE) AS expiry_date
  FROM part GROUP BY p_name
)
SELECT {", ".join("f." + c.strip() for c in FACT_COLS.split(","))}, p.current_price, p.expiry_date
FROM fact f JOIN prod p ON f.product_name = p.name"""
    ),
}


# ---------------------------------------------------------------- CSV ingest
LAYOUT = (
    "CASE WHEN _line BETWEEN 1 AND 3 THEN 'base' WHEN _line BETWEEN 4 AND 5 THEN 'extra' "
    "WHEN _line = 6 THEN 'missing' ELSE 'json' END"
)
MANDATORY = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
MISSING_HEADER = "customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode"

ORACLE.update(
    {
        "discovered_files": _q(
            f"""
SELECT DISTINCT {LAYOUT} AS landing_dir, CASE WHEN _line = 7 THEN 'json' ELSE 'csv' END AS file_ext
FROM fact"""
        ),
        "header_audit": _q(
            f"""
, lay AS (SELECT DISTINCT {LAYOUT} AS landing_dir FROM fact)
SELECT l.landing_dir, v.header_columns, v.missing, v.extra, v.accepted, v.reason
FROM lay l JOIN (VALUES
  ('base', '{MANDATORY}', '', '', true, CAST(NULL AS VARCHAR)),
  ('extra', '{MANDATORY},payment_mode', '', 'payment_mode', true, CAST(NULL AS VARCHAR)),
  ('missing', '{MISSING_HEADER}', 'store_id', 'payment_mode', false, 'missing_columns'),
  ('json', '', '', '', false, 'not_csv')
) v(landing_dir, header_columns, missing, extra, accepted, reason) ON l.landing_dir = v.landing_dir"""
        ),
        "ingested_sales": _q(
            """
SELECT CAST(customer_id AS BIGINT) AS customer_id, CAST(store_id AS BIGINT) AS store_id, product_name, sales_date,
       CAST(sales_person_id AS BIGINT) AS sales_person_id, price, quantity, total_cost,
       CASE WHEN _line BETWEEN 4 AND 5 THEN CASE WHEN quantity % 2 = 0 THEN 'cash' ELSE 'UPI' END END
         AS additional_column
FROM fact WHERE _line BETWEEN 1 AND 5"""
        ),
        "quarantined_lines": _q(
            f"""
SELECT {LAYOUT} AS landing_dir,
       CASE WHEN _line = 6 THEN 'missing_columns' ELSE 'not_csv' END AS reason,
       CASE WHEN _line = 6 THEN 'store_id' ELSE '' END AS missing,
       COUNT(*) AS n_lines
FROM fact WHERE _line >= 6 GROUP BY 1, 2, 3"""
        ),
    }
)

# ---------------------------------------------------------------- sinks
ORACLE.update(
    {
        "flat_mart_roundtrip": ORACLE["customer_mart_detail"],
        "partitioned_mart_pruned": _q(
            f"SELECT {SDET_COLS} FROM sdet WHERE sales_month BETWEEN '1996-01' AND '1996-12'"
        ),
        "latest_snapshot": ORACLE["sales_team_mart_detail"],
        "monthly_billing_report": _q(
            """
SELECT full_name AS sales_person_name, store_id AS sales_person_store_id, sales_month,
       CAST(ts AS DECIMAL(10,2)) AS sales_person_total_billing_done_for_each_month,
       CAST(CASE WHEN rank() OVER (PARTITION BY store_id, sales_month ORDER BY ts DESC) = 1
                 THEN ts * 0.01 ELSE 0 END AS DECIMAL(10,2)) AS total_incentive
FROM stm"""
        ),
        "sales_team_mart_table": ORACLE["sales_team_month_mart"],
    }
)

# ---------------------------------------------------------------- ledger
LEDGER_FILES = """
, files AS (
  SELECT DISTINCT 'sales_data_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS file_name,
         'sales_data/sales_data_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS path,
         strftime(o_orderdate, '%Y-%m') AS m
  FROM orders
),
events AS (
  SELECT file_name, path AS file_location, TIMESTAMP '2024-01-01 00:00:00' AS created_date,
         CAST(NULL AS TIMESTAMP) AS updated_date, 'A' AS status FROM files WHERE m <= '1996-12'
  UNION ALL
  SELECT file_name, path, CAST(NULL AS TIMESTAMP), TIMESTAMP '2024-01-01 01:30:00', 'I'
  FROM files WHERE m <= '1996-12'
  UNION ALL
  SELECT file_name, path, TIMESTAMP '2024-02-01 00:00:00', CAST(NULL AS TIMESTAMP), 'A'
  FROM files WHERE m BETWEEN '1996-07' AND '1998-12'
),
cur AS (
  SELECT file_name, CAST(NULL AS BIGINT) AS file_modified_ms,
         MIN(created_date) AS created_date, MAX(updated_date) AS updated_date,
         arg_max(status, COALESCE(updated_date, created_date)) AS status,
         arg_max(file_location, COALESCE(updated_date, created_date)) AS file_location
  FROM events GROUP BY file_name
)"""


def _lq(body: str) -> str:
    return WITH + LEDGER_FILES + "\n" + body.strip()


ORACLE.update(
    {
        "ledger_started": _lq(
            """
SELECT file_name, path AS file_location, TIMESTAMP '2024-02-01 00:00:00' AS created_date,
       CAST(NULL AS TIMESTAMP) AS updated_date, 'A' AS status, CAST(NULL AS BIGINT) AS file_modified_ms
FROM files"""
        ),
        "ledger_current": _lq(
            "SELECT file_name, file_modified_ms, file_location, created_date, updated_date, status FROM cur"
        ),
        "ledger_pending": _lq(
            "SELECT DISTINCT c.file_name FROM cur c JOIN files f ON c.file_name = f.file_name WHERE c.status = 'A'"
        ),
        "unprocessed_files": _lq(
            """
SELECT f.file_name, f.path FROM files f
WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.file_name = f.file_name AND c.status = 'I')"""
        ),
    }
)

# ---------------------------------------------------------------- whole job (accepted layouts only)
ACCEPTED_STM = """
, acc AS (
  SELECT CAST(e.store_id AS BIGINT) AS store_id, CAST(e.sales_person_id AS BIGINT) AS sales_person_id,
         e.sales_person_first_name || ' ' || e.sales_person_last_name AS full_name,
         strftime(e.sales_date, '%Y-%m') AS sales_month, e.total_cost,
         CAST(e.customer_id AS BIGINT) AS customer_id, e.first_name, e.last_name, e.address,
         e.phone_number, e.sales_date
  FROM enr e WHERE e._line BETWEEN 1 AND 5
),
astm AS (
  SELECT store_id, sales_person_id, full_name, sales_month, SUM(total_cost) AS ts FROM acc GROUP BY 1, 2, 3, 4
)"""

ORACLE.update(
    {
        "pipeline_sales_team_mart": _q(
            ACCEPTED_STM
            + """
SELECT store_id, sales_person_id, full_name, sales_month, CAST(ts AS DECIMAL(10,2)) AS total_sales,
       CAST(CASE WHEN rank() OVER (PARTITION BY store_id, sales_month ORDER BY ts DESC) = 1
                 THEN ts * 0.01 ELSE 0 END AS DECIMAL(10,2)) AS incentive
FROM astm"""
        ),
        "pipeline_customer_month_mart": _q(
            ACCEPTED_STM
            + """
SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       CAST(date_trunc('month', sales_date) AS DATE) AS sales_date_month,
       CAST(SUM(total_cost) AS DECIMAL(10,2)) AS total_sales
FROM acc GROUP BY 1, 2, 3, 4, 5"""
        ),
    }
)

ORACLE["streaming_sales_team_mart"] = ORACLE["pipeline_sales_team_mart"]

# ---------------------------------------------------------------- corrected files, rejected lines
CORRECTED = """
, fixed AS (
  SELECT sales_person_id, store_id, full_name, store_id AS _s,
         CASE WHEN old AND customer_id % 7 = 0 THEN sales_date + 31 ELSE sales_date END AS sales_date,
         CASE WHEN old AND customer_id % 2 = 0 THEN CAST(total_cost * 2 AS DECIMAL(10,2)) ELSE total_cost END AS total_cost
  FROM (SELECT customer_id, CAST(store_id AS BIGINT) AS store_id, CAST(sales_person_id AS BIGINT) AS sales_person_id,
               sales_person_first_name || ' ' || sales_person_last_name AS full_name, sales_date, total_cost,
               year(sales_date) = 1996 AS old
        FROM enr) e
  WHERE NOT (old AND sales_person_id % 3 = 0)
),
ftm AS (
  SELECT store_id, sales_person_id, full_name, strftime(sales_date, '%Y-%m') AS sales_month, SUM(total_cost) AS ts
  FROM fixed GROUP BY 1, 2, 3, 4
)"""

ORACLE.update(
    {
        "pipeline_corrected_file_sales_team_mart": _q(
            CORRECTED
            + """
SELECT store_id, sales_person_id, full_name, sales_month, CAST(ts AS DECIMAL(10,2)) AS total_sales,
       CAST(CASE WHEN rank() OVER (PARTITION BY store_id, sales_month ORDER BY ts DESC) = 1
                 THEN ts * 0.01 ELSE 0 END AS DECIMAL(10,2)) AS incentive
FROM ftm"""
        ),
        "corrected_file_snapshots": _q(
            CORRECTED
            + """
SELECT 'first' AS publication, strftime(sales_date, '%Y-%m') AS sales_month, COUNT(*) AS n_sales,
       CAST(SUM(total_cost) AS DECIMAL(20,2)) AS total_cost FROM enr GROUP BY 2
UNION ALL
SELECT 'newest', strftime(sales_date, '%Y-%m'), COUNT(*), CAST(SUM(total_cost) AS DECIMAL(20,2)) FROM fixed GROUP BY 2"""
        ),
        "rejected_rows": _q(
            """
SELECT CASE WHEN customer_id % 13 = 0 THEN 'malformed_line'
            WHEN customer_id % 11 = 0 THEN 'bad_cell:quantity'
            WHEN sales_person_id % 17 = 0 THEN 'no_sales_team'
            WHEN store_id % 19 = 0 THEN 'no_store'
            WHEN customer_id % 7 = 0 THEN 'no_customer'
            ELSE 'accepted' END AS reason,
       COUNT(*) AS n_lines, COUNT(DISTINCT sales_person_id) AS n_sellers
FROM fact GROUP BY 1"""
        ),
        "seeded_sales_fact": ORACLE["sales_fact"],
        "line_totals": _q(
            """
SELECT customer_id, store_id, product_name, sales_date, price, quantity,
       CAST(price * quantity AS DECIMAL(10,2)) AS line_total FROM fact"""
        ),
        "sales_preview": _q(
            f"""
SELECT {FACT_COLS} FROM fact
ORDER BY total_cost DESC, customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity LIMIT 20"""
        ),
    }
)
