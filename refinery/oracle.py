"""DuckDB SQL equivalent of each registered query (tables are views named
after the test tables).  Written independently of the Spark code: plain
joins, GROUP BY and CASE over the source tables."""

from __future__ import annotations

from refinery.queries import DAY, FILTER_SQL, KIND, RUN_DATES, STATE, TEXT_TABLES, WIDE_DATES

_SALES = """
    SELECT o.o_custkey AS CustomerID,
           CAST(p.p_retailprice AS DECIMAL(18,6)) * CAST(l.l_quantity AS DECIMAL(18,6)) AS amount
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey"""

SEGMENTATION = f"""
WITH sales AS ({_SALES}),
     cust AS (SELECT c_custkey AS CustomerID, c_name AS Name, c_nationkey AS Age,
                     c_mktsegment AS Gender FROM customer)
SELECT c.CustomerID, c.Name, c.Age, c.Gender,
       CAST(SUM(s.amount) AS DOUBLE) AS Total_sales,
       CASE WHEN SUM(s.amount) >= 1500000 THEN 'High Value'
            WHEN SUM(s.amount) >= 900000 THEN 'Medium Value'
            ELSE 'Low Value' END AS Segmentation_column
FROM sales s JOIN cust c ON s.CustomerID = c.CustomerID
GROUP BY c.CustomerID, c.Name, c.Age, c.Gender
"""

EXACT = f"""
WITH sales AS (
    SELECT o.o_custkey AS CustomerID,
           CAST((CAST(p.p_retailprice AS DECIMAL(18,3)) + CAST(o.o_custkey % 10 + 1 AS DECIMAL(18,3)) / 1000)
                AS DECIMAL(18,3)) * CAST(l.l_quantity AS DECIMAL(18,0)) AS amount
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)
SELECT c.c_custkey AS CustomerID, c.c_name AS Name, c.c_nationkey AS Age, c.c_mktsegment AS Gender,
       CAST(SUM(s.amount) AS DOUBLE) AS Total_sales,
       CASE WHEN SUM(s.amount) >= 1500000 THEN 'High Value'
            WHEN SUM(s.amount) >= 900000 THEN 'Medium Value'
            ELSE 'Low Value' END AS Segmentation_column
FROM sales s JOIN customer c ON s.CustomerID = c.c_custkey
GROUP BY ALL
"""

_EVENTS = "SELECT *, CAST(ts AS DATE) AS date_partition FROM events"

_RAW = """SELECT p_partkey AS customer_id, p_brand AS customer_unique_id,
                 p_size AS customer_zip_code_prefix, p_name AS customer_city,
                 p_type AS customer_state FROM part"""

_REFINED = f"""SELECT p_partkey AS customer_id, p_size AS customer_zip_code_prefix,
                      UPPER(p_name) AS customer_city, p_type AS customer_state
               FROM part WHERE p_type = '{STATE}'"""

_UPPER_CASE = """CASE WHEN customer_city = UPPER(customer_city) THEN 'PASS - All Uppercase'
                      ELSE 'FAIL - Not Uppercase' END"""


def _daily_refined() -> str:
    return " UNION ALL ".join(
        f"SELECT *, DATE '{ds}' AS dt FROM ({_REFINED})" for ds in RUN_DATES)


ORACLE: dict[str, str] = {
    "customer_segmentation": SEGMENTATION,
    "segmentation_exact_money": EXACT,
    "segmentation_csv_job": SEGMENTATION,
    "segmentation_catalog": SEGMENTATION,
    "csv_scan": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "csv_headerless_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "parquet_scan": "SELECT * FROM supplier",
    "partitioned_scan": _EVENTS,
    "leaf_partition_scan": f"""
        SELECT event_id, ts, user_id, event_type, value, props FROM events
        WHERE CAST(ts AS DATE) = DATE '{DAY}'""",
    "date_parse": """
        SELECT o_orderkey,
               CAST(strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS order_date
        FROM orders""",
    "date_parse_counts": """SELECT o_orderdate AS order_date, COUNT(*) AS "count" FROM (
        SELECT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders) GROUP BY 1""",
    "partition_csv_job": f"""
        WITH t AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'soon'
                             WHEN event_id % 77 <> 0 THEN strftime(ts, '%d-%m-%Y') END AS "Date",
                          event_id % 50 = 0 OR event_id % 77 = 0 AS bad, CAST(ts AS DATE) AS d FROM events)
        SELECT event_id, "Date", CASE WHEN NOT bad THEN d END AS date_partition,
               CASE WHEN bad THEN CASE WHEN d < DATE '{DAY}' THEN 'early' ELSE 'late' END END AS batch,
               (SELECT COUNT(*) FROM t WHERE bad) AS rejected_in_all
        FROM t""",
    "csv_split_scan": "SELECT * FROM documents",
    "partitioned_csv": _EVENTS,
    "filter_data_clustered": f"SELECT * FROM ({_EVENTS}) WHERE event_type = '{KIND}'",
    "top_words": r"""
        SELECT word, COUNT(*) AS word_count
        FROM (SELECT unnest(string_split_regex(text, '[ \n]+')) AS word FROM documents) WHERE word <> ''
        GROUP BY word ORDER BY word_count DESC, word LIMIT 10""",
    "content_report": f"""
        WITH any_kept AS (SELECT COUNT(*) > 0 AS kept FROM ({_REFINED}))
        SELECT t.table_name, c."check", NOT (t.table_name = 'altered' AND c."check" = 'content' AND kept) AS passed
        FROM (VALUES ('true'), ('altered')) t(table_name),
             (VALUES ('uppercase:customer_city'), ('allowed:customer_state'), ('row_counts'), ('content')) c("check"), any_kept""",
    "ledger_refresh": f"""
        WITH e AS ({_EVENTS}), d AS (SELECT date_partition, COUNT(*) AS n,
            COUNT(*) FILTER (WHERE event_type = '{KIND}') AS clicks FROM e GROUP BY 1)
        SELECT date_partition, CASE WHEN date_partition > DATE '{DAY}' THEN 'added'
                 WHEN date_partition = DATE '{DAY}' THEN 'changed' ELSE 'vanished' END AS change,
               CASE WHEN date_partition > DATE '{DAY}' THEN n WHEN date_partition = DATE '{DAY}' THEN clicks END AS row_count
        FROM d WHERE date_partition >= DATE '{DAY}' OR date_partition = DATE '2024-01-02'""",
    "crawl_union": f"""
        SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN CAST(ts AS DATE) > DATE '{DAY}' THEN props END AS props,
               CAST(ts AS DATE) AS date_partition
        FROM events""",
    "extract_many": """
        SELECT 'supplier' AS table_name, true AS landed, false AS failed, 1 AS attempts, COUNT(*) AS extracted_rows FROM supplier
        UNION ALL SELECT 'nation', true, false, 1, COUNT(*) FROM nation
        UNION ALL SELECT 'none', false, false, 1, 0
        UNION ALL SELECT 'down', false, true, 2, NULL""",
    "extract_resumed": "SELECT * FROM orders",
    "daily_refine_widening": " UNION ALL ".join(
        f"SELECT * REPLACE (CAST(customer_zip_code_prefix AS DECIMAL(22,2)) + {more} AS customer_zip_code_prefix), "
        f"DATE '{ds}' AS dt FROM ({_REFINED})" for ds, more in zip(WIDE_DATES, ("0", "0", "0.25"))),
    "filter_partition": f"SELECT * FROM ({_EVENTS}) WHERE date_partition = DATE '{DAY}'",
    "filter_data": f"SELECT * FROM ({_EVENTS}) WHERE event_type = '{KIND}'",
    "filter_combined": f"""SELECT * FROM ({_EVENTS})
        WHERE date_partition = DATE '{DAY}' AND event_type = '{KIND}'""",
    "filter_expression": f"SELECT * FROM orders WHERE {FILTER_SQL}",
    "data_reduction": f"""
        WITH e AS ({_EVENTS}),
        c AS (
            SELECT 'no_filter' AS scenario, COUNT(*) AS row_count FROM e
            UNION ALL SELECT 'partition_filter', COUNT(*) FROM e WHERE date_partition = DATE '{DAY}'
            UNION ALL SELECT 'data_filter', COUNT(*) FROM e WHERE event_type = '{KIND}'
            UNION ALL SELECT 'both_filters', COUNT(*) FROM e
                      WHERE date_partition = DATE '{DAY}' AND event_type = '{KIND}')
        SELECT scenario, row_count,
               ROUND(CAST(100 * ((SELECT COUNT(*) FROM e) - row_count) AS DOUBLE)
                     / (SELECT COUNT(*) FROM e), 1) AS reduction_pct
        FROM c""",
    "partition_counts": f"""SELECT date_partition, COUNT(*) AS "count" FROM ({_EVENTS})
        GROUP BY date_partition ORDER BY date_partition""",
    "dynamic_overwrite": f"""SELECT * FROM ({_EVENTS})
        WHERE date_partition <> DATE '{DAY}' OR event_type = '{KIND}'""",
    "customer_refine": _REFINED,
    "validate_uppercase": f"""
        SELECT 'raw' AS table_name, {_UPPER_CASE} AS uppercase_validation, COUNT(*) AS "count"
        FROM ({_RAW}) GROUP BY 1, 2
        UNION ALL
        SELECT 'refined', {_UPPER_CASE}, COUNT(*) FROM ({_REFINED}) GROUP BY 1, 2""",
    "validate_state": f"""
        SELECT customer_state, COUNT(*) AS "count",
               COALESCE(customer_state IN ('{STATE}'), false) AS allowed
        FROM ({_REFINED}) GROUP BY customer_state""",
    "validate_row_counts": f"""
        SELECT 'Raw Table' AS source, COUNT(*) AS row_count FROM ({_RAW})
        UNION ALL SELECT 'Refined Table', COUNT(*) FROM ({_REFINED})""",
    "sample_rows": f"""
        SELECT customer_id, customer_zip_code_prefix, customer_city, customer_state
        FROM ({_REFINED}) ORDER BY customer_id NULLS LAST LIMIT 10""",
    "top_cities": f"""
        SELECT customer_city, customer_state, COUNT(*) AS customer_count
        FROM ({_REFINED}) GROUP BY customer_city, customer_state
        ORDER BY customer_count DESC, customer_city NULLS LAST, customer_state NULLS LAST LIMIT 10""",
    "validation_report": f"""
        WITH r AS (SELECT COUNT(*) AS raw_rows,
                          COUNT(*) FILTER (WHERE COALESCE(customer_state IN ('{STATE}'), false)) AS raw_kept
                   FROM ({_RAW})),
             f AS (SELECT COUNT(*) AS refined_rows,
                          COUNT(*) FILTER (WHERE NOT COALESCE(customer_city = UPPER(customer_city), false)) AS bad_upper,
                          COUNT(*) FILTER (WHERE NOT COALESCE(customer_state IN ('{STATE}'), false)) AS bad_allowed
                   FROM ({_REFINED}))
        SELECT 'uppercase:customer_city' AS "check", bad_upper = 0 AS passed,
               CAST(bad_upper AS VARCHAR) || ' of ' || CAST(refined_rows AS VARCHAR)
               || ' rows not upper case' AS detail FROM f
        UNION ALL
        SELECT 'allowed:customer_state', bad_allowed = 0,
               CAST(bad_allowed AS VARCHAR) || ' of ' || CAST(refined_rows AS VARCHAR)
               || ' rows outside the allowed values' FROM f
        UNION ALL
        SELECT 'absent:customer_unique_id', true, 'column absent'
        UNION ALL
        SELECT 'row_counts', refined_rows = raw_kept,
               'raw ' || CAST(raw_rows AS VARCHAR) || ', expected refined '
               || CAST(raw_kept AS VARCHAR) || ', refined ' || CAST(refined_rows AS VARCHAR)
        FROM r, f""",
    "validate_columns": f"""
        SELECT 'Raw Table' AS table_name, 'customer_unique_id' AS column_name, COUNT(*) AS row_count,
               false AS passed, 'column present' AS detail FROM ({_RAW})
        UNION ALL
        SELECT 'Refined Table', 'customer_unique_id', COUNT(*), true, 'column absent' FROM ({_REFINED})""",
    "file_inventory": f"SELECT DISTINCT date_partition, true AS all_filled FROM ({_EVENTS})",
    "sql_validate_state": f"""
        SELECT customer_state, COUNT(*) AS "count" FROM ({_REFINED}) GROUP BY customer_state""",
    "register_table": f"SELECT *, DATE '{RUN_DATES[0]}' AS dt FROM ({_RAW})",
    "refresh_partitions": _EVENTS,
    "schema_drift": f"""
        SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN CAST(ts AS DATE) > DATE '{DAY}' THEN props END AS props,
               CAST(ts AS DATE) AS date_partition
        FROM events""",
    "table_stats": """
        SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer
        UNION ALL SELECT 'orders', COUNT(*) FROM orders
        UNION ALL SELECT 'part', COUNT(*) FROM part""",
    "raw_landing": f"SELECT *, DATE '{RUN_DATES[0]}' AS dt FROM customer",
    "extract_audit": f"""
        SELECT 'parquet' AS source, 'customer' AS table_name, DATE '{RUN_DATES[0]}' AS run_date,
               COUNT(*) AS extracted_rows FROM customer
        UNION ALL
        SELECT 'parquet', 'supplier', DATE '{RUN_DATES[0]}', COUNT(*) FROM supplier""",
    "daily_refine": _daily_refined(),
    "daily_refine_text": f"""
        SELECT doc_id, text, lang, UPPER(source) AS source, DATE '{RUN_DATES[0]}' AS dt
        FROM documents WHERE lang IN ('en', 'fr')""",
    "daily_refine_drift": f"""
        SELECT customer_id, customer_zip_code_prefix, customer_city, customer_state,
               CAST(NULL AS VARCHAR) AS store_note, DATE '{RUN_DATES[0]}' AS dt FROM ({_REFINED})
        UNION ALL
        SELECT customer_id, NULL, customer_city, customer_state,
               'store ' || CAST(customer_id AS VARCHAR), DATE '{RUN_DATES[1]}' FROM ({_REFINED})""",
    "incremental_refine": _daily_refined(),
}

for _name in TEXT_TABLES:
    ORACLE[f"csv_headerless_roundtrip_{_name}"] = f"SELECT * FROM {_name}"
    ORACLE[f"raw_landing_{_name}"] = f"SELECT *, DATE '{RUN_DATES[0]}' AS dt FROM {_name}"

# The SQL-text checks compute the same results as their DataFrame forms.
for _name in ("validate_uppercase", "validate_row_counts", "sample_rows", "top_cities"):
    ORACLE[f"sql_{_name}"] = ORACLE[_name]
