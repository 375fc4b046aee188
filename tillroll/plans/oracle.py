"""DuckDB SQL oracles for :data:`tillroll.plans.queries.QUERIES`.

Written independently of the Spark plans: positional pair counts by
numbering the items of each receipt and self-joining on ``i <> j``, lists
by ``string_agg ... ORDER BY``, dense numbers by a global ``row_number``.
Tables are the pre-registered views ``orders lineitem part events``.
"""

from __future__ import annotations

ITEMS_BY_NAME = """items AS (
    SELECT o.o_orderkey AS rid, strftime(o.o_orderdate, '%Y-%m') AS month, p.p_name AS product
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey)"""

ITEMS_BY_PARTKEY = """items AS (
    SELECT o.o_orderkey AS rid, strftime(o.o_orderdate, '%Y-%m') AS month,
           CAST(l.l_partkey AS VARCHAR) AS product
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

PRICES_BY_PARTKEY = """prices AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product, CAST(p_retailprice AS DECIMAL(12,2)) AS price
    FROM part)"""

COUNTS = """counts AS (
    SELECT month, product, count(*) AS units FROM items GROUP BY month, product)"""

TOP5 = COUNTS + """,
top AS (
    SELECT month, product, units, rk FROM (
        SELECT month, product, units,
               row_number() OVER (PARTITION BY month ORDER BY units DESC, product) AS rk
        FROM counts) WHERE rk <= 5)"""

REVENUE = """rev AS (
    SELECT c.product, c.month, c.units, p.price,
           CAST(c.units * p.price AS DECIMAL(22,2)) AS total
    FROM (SELECT product, month, count(*) AS units FROM items GROUP BY product, month) c
    JOIN prices p ON c.product = p.product)"""

# a total as text: whole numbers without decimals, others without trailing zeros
TOTAL_TEXT = """CASE WHEN total = floor(total) THEN CAST(CAST(total AS BIGINT) AS VARCHAR)
            ELSE rtrim(CAST(total AS VARCHAR), '0') END"""

# every product that sold or is listed; without a price other than 0 its list is empty
FULL_LINES = f"""every AS (SELECT product FROM items UNION SELECT product FROM prices),
sold AS (
    SELECT i.product, i.month, CAST(count(*) * p.price AS DECIMAL(22,2)) AS total
    FROM items i JOIN prices p ON i.product = p.product AND p.price <> 0 GROUP BY i.product, i.month, p.price)
SELECT e.product, e.product || chr(9) || coalesce(string_agg(
           substr(month, 6, 2) || '/' || substr(month, 1, 4) || ':' || {TOTAL_TEXT} || ' ', '' ORDER BY month), '') AS line
FROM every e LEFT JOIN sold s ON e.product = s.product GROUP BY e.product"""

NUMBERED = """num AS (
    SELECT rid, product, row_number() OVER (PARTITION BY rid ORDER BY product) AS ix FROM items)"""

PAIRS_POSITIONAL = NUMBERED + """,
pc AS (
    SELECT a.product AS p1, b.product AS p2, count(*) AS pair_count
    FROM num a JOIN num b ON a.rid = b.rid AND a.ix <> b.ix
    GROUP BY a.product, b.product)"""

PAIRS_BY_NAME = """pc AS (
    SELECT a.product AS p1, b.product AS p2, count(*) AS pair_count
    FROM items a JOIN items b ON a.rid = b.rid AND a.product <> b.product
    GROUP BY a.product, b.product)"""

PAIRS_DISTINCT = """dist AS (SELECT DISTINCT rid, product FROM items),
pc AS (
    SELECT a.product AS p1, b.product AS p2, count(*) AS pair_count
    FROM dist a JOIN dist b ON a.rid = b.rid AND a.product <> b.product
    GROUP BY a.product, b.product)"""


def _rules(pairs: str, occ_from: str = "items") -> str:
    return f"""{pairs},
occ AS (SELECT product, count(*) AS occurrences FROM {occ_from} GROUP BY product),
tot AS (SELECT count(*) AS receipts FROM orders),
rules AS (
    SELECT pc.p1, pc.p2, pc.pair_count,
           CAST(pc.pair_count AS DOUBLE) / CAST(tot.receipts AS DOUBLE) AS support,
           CAST(pc.pair_count AS DOUBLE) / CAST(occ.occurrences AS DOUBLE) AS confidence
    FROM pc JOIN occ ON pc.p1 = occ.product CROSS JOIN tot)"""


RECEIPT_LISTS = """lists AS (
    SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS data,
           coalesce(string_agg(p.p_name, ',' ORDER BY p.p_name), '') AS items
    FROM orders o
    LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY o.o_orderkey, o.o_orderdate)"""

MONTHLY_COUNTS_SQL = f"WITH {ITEMS_BY_NAME}, {COUNTS} SELECT month, product, units FROM counts"

TOP5_SQL = f"""WITH {ITEMS_BY_NAME}, {TOP5}
SELECT month, CAST(rk AS INTEGER) AS "rank", product, units FROM top"""

OCCURRENCES_SQL = f"""WITH {ITEMS_BY_NAME}
SELECT product, count(*) AS occurrences FROM items GROUP BY product"""

PAIR_COUNTS_SQL = f"WITH {ITEMS_BY_NAME}, {PAIRS_POSITIONAL} SELECT p1, p2, pair_count FROM pc"

RULES_SQL = f"WITH {ITEMS_BY_NAME}, {_rules(PAIRS_POSITIONAL)} SELECT p1, p2, pair_count, support, confidence FROM rules"

PRICE_DEDUP_SQL = """SELECT p_name AS product,
       CAST(max(CAST(p_retailprice AS DECIMAL(12,2))) * 100 AS BIGINT) AS price_cents
FROM part GROUP BY p_name"""

ORACLES: dict[str, str] = {
    "monthly_product_counts": MONTHLY_COUNTS_SQL,
    "units_sum_of_ones": MONTHLY_COUNTS_SQL,
    "monthly_top5": TOP5_SQL,
    "monthly_top5_line": f"""WITH {ITEMS_BY_NAME}, {TOP5}
SELECT month, month || ':' || chr(9) || string_agg(product || ' ' || CAST(units AS VARCHAR), ', ' ORDER BY rk) AS line
FROM top GROUP BY month""",
    "monthly_top5_tuple": f"""WITH {ITEMS_BY_NAME}, {TOP5}
SELECT month, '(' || month || ',[' || string_agg('(' || product || ',' || CAST(units AS VARCHAR) || ')', ', ' ORDER BY rk) || '])' AS line
FROM top GROUP BY month""",
    "monthly_top5_columns": f"""WITH {ITEMS_BY_NAME}, {TOP5}
SELECT month,
       max(CASE WHEN rk = 1 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top1,
       max(CASE WHEN rk = 2 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top2,
       max(CASE WHEN rk = 3 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top3,
       max(CASE WHEN rk = 4 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top4,
       max(CASE WHEN rk = 5 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top5
FROM top GROUP BY month""",
    "packed_list_parse": TOP5_SQL,
    "ranked_list_sorted": f"""WITH {ITEMS_BY_NAME}, {TOP5}
SELECT month,
       string_agg(product || ' ' || CAST(units AS VARCHAR), ', ' ORDER BY units DESC, product) AS ranked,
       max(CASE WHEN rk = 1 THEN product END) AS first,
       max(CASE WHEN rk = 2 THEN product END) AS second
FROM top GROUP BY month""",
    "global_sort": f"""WITH {ITEMS_BY_NAME}, {COUNTS}
SELECT CAST(row_number() OVER (ORDER BY month, product) AS BIGINT) AS position, month, product, units
FROM counts""",
    "preview": f"""WITH {ITEMS_BY_NAME}, {COUNTS}
SELECT month, product, units FROM counts ORDER BY units DESC, month, product LIMIT 10""",
    "month_prefix": """SELECT strftime(o_orderdate, '%Y-%m') AS month,
       strftime(o_orderdate, '%Y-%m') AS month_unix,
       strftime(o_orderdate, '%m/%Y') AS month_slash,
       count(*) AS receipts
FROM orders GROUP BY 1, 2, 3""",
    "month_labels": f"""WITH {ITEMS_BY_PARTKEY}
SELECT DISTINCT month, substr(month, 6, 2) || '/' || substr(month, 1, 4) AS month_slash,
       substr(month, 6, 2) || '-' || substr(month, 1, 4) AS month_dash
FROM items""",
    "monthly_revenue": f"""WITH {ITEMS_BY_PARTKEY}, {PRICES_BY_PARTKEY}, {REVENUE}
SELECT product, month, units, CAST(total * 100 AS BIGINT) AS total_cents FROM rev""",
    "monthly_revenue_full": f"""WITH {ITEMS_BY_PARTKEY}, {PRICES_BY_PARTKEY}, {FULL_LINES}""",
    "monthly_revenue_full_zero": f"""WITH {ITEMS_BY_PARTKEY},
zeroed AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product,
           CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS price FROM part),
prices AS (SELECT product, price FROM zeroed UNION ALL SELECT '-' || product, price FROM zeroed), {FULL_LINES}""",
    "monthly_revenue_tuple": f"""WITH {ITEMS_BY_PARTKEY}, {PRICES_BY_PARTKEY}, {REVENUE}
SELECT product,
       '(' || product || ',[' || string_agg('(' || month || ',' || {TOTAL_TEXT} || ')', ', ' ORDER BY month) || '])' AS line
FROM rev GROUP BY product""",
    "monthly_revenue_array": f"""WITH {ITEMS_BY_PARTKEY}, {PRICES_BY_PARTKEY}, {REVENUE}
SELECT product,
       string_agg(substr(month, 6, 2) || '-' || substr(month, 1, 4) || ':' || {TOTAL_TEXT}, ',' ORDER BY month) AS month_total
FROM rev GROUP BY product""",
    "price_dedup": PRICE_DEDUP_SQL,
    "product_occurrences": OCCURRENCES_SQL,
    "receipt_total": "SELECT count(*) AS receipts FROM orders",
    "pair_counts": PAIR_COUNTS_SQL,
    "pair_counts_mirror": PAIR_COUNTS_SQL,
    "pair_counts_selfjoin": f"WITH {ITEMS_BY_NAME}, {PAIRS_BY_NAME} SELECT p1, p2, pair_count FROM pc",
    "pair_counts_events_grid": f"""WITH items AS (
    SELECT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS rid, event_type AS product FROM events),
{PAIRS_POSITIONAL}
SELECT p1, p2, pair_count FROM pc""",
    "pair_counts_events": f"""WITH items AS (
    SELECT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS rid, event_type AS product FROM events),
{PAIRS_POSITIONAL}
SELECT p1, p2, pair_count FROM pc""",
    "pair_rules": RULES_SQL,
    "pair_rules_grid": RULES_SQL,
    "pair_rules_stepwise": RULES_SQL,
    "pair_rules_distinct": f"""WITH {ITEMS_BY_NAME}, {_rules(PAIRS_DISTINCT, 'dist')}
SELECT p1, p2, pair_count, support, confidence FROM rules""",
    "pair_rules_pct1": f"""WITH {ITEMS_BY_NAME}, {_rules(PAIRS_POSITIONAL)}
SELECT p1, p2, p1 || ',' || p2 || chr(9) || printf('%.1f%%', support * 100) || ', ' || printf('%.1f%%', confidence * 100) AS line
FROM rules""",
    "pair_rules_pct2": f"""WITH {ITEMS_BY_NAME}, {_rules(PAIRS_POSITIONAL)}
SELECT p1, p2, '(' || p1 || ',' || p2 || ',' || printf('%.2f', support * 100) || ',' || printf('%.2f', confidence * 100) || ')' AS line
FROM rules""",
    "pair_rules_raw_percent": f"""WITH {ITEMS_BY_NAME}, {_rules(PAIRS_BY_NAME)}
SELECT p1, p2,
       CAST(round(support * 100, 6) AS VARCHAR) || '%' AS support_pct,
       CAST(round(confidence * 100, 6) AS VARCHAR) || '%' AS confidence_pct
FROM rules""",
    "pair_rules_unrounded_percent": f"""WITH {ITEMS_BY_NAME}, {_rules(PAIRS_BY_NAME)}
SELECT p1, p2, support * 100 AS support_pct, confidence * 100 AS confidence_pct
FROM rules""",
    "one_pass_counts": f"""WITH {ITEMS_BY_NAME}, {PAIRS_POSITIONAL}
SELECT 'pair' AS tag, p1, p2, pair_count AS n FROM pc
UNION ALL
SELECT 'product' AS tag, product AS p1, CAST(NULL AS VARCHAR) AS p2, count(*) AS n FROM items GROUP BY product
UNION ALL
SELECT 'total' AS tag, CAST(NULL AS VARCHAR) AS p1, CAST(NULL AS VARCHAR) AS p2, count(*) AS n FROM orders""",
    "receipt_text_roundtrip": f"WITH {RECEIPT_LISTS} SELECT data, items FROM lists",
    "receipt_colon_roundtrip": f"WITH {RECEIPT_LISTS} SELECT data, items FROM lists",
    "receipt_unsplit_occurrences": OCCURRENCES_SQL,
    "receipt_text_top5": TOP5_SQL,
    "price_text_roundtrip": """SELECT CAST(p_partkey AS VARCHAR) AS product,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS price_cents
FROM part""",
    "table_overwrite": PRICE_DEDUP_SQL,
    "packed_revenue_parse": f"""WITH {ITEMS_BY_PARTKEY}, {PRICES_BY_PARTKEY}, {REVENUE}
SELECT product, month, CAST(total * 100 AS BIGINT) AS total_cents FROM rev WHERE price <> 0""",
    "rules_text_sink": f"""WITH {ITEMS_BY_NAME}, {_rules(PAIRS_POSITIONAL)}
SELECT p1 || ',' || p2 || chr(9) || printf('%.1f%%', support * 100) || ', ' || printf('%.1f%%', confidence * 100) AS line
FROM rules""",
    "hive_top5_sql": f"""WITH {ITEMS_BY_NAME}, {TOP5}
SELECT month,
       max(CASE WHEN rk = 1 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top1,
       max(CASE WHEN rk = 2 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top2,
       max(CASE WHEN rk = 3 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top3,
       max(CASE WHEN rk = 4 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top4,
       max(CASE WHEN rk = 5 THEN product || ' ' || CAST(units AS VARCHAR) || ', ' END) AS top5
FROM top GROUP BY month""",
    "hive_revenue_sql": f"""WITH {ITEMS_BY_PARTKEY}, {PRICES_BY_PARTKEY}, {REVENUE}
SELECT product, month, units, CAST(total * 100 AS BIGINT) AS total_cents FROM rev""",
    "hive_rules_sql": f"WITH {ITEMS_BY_NAME}, {_rules(PAIRS_BY_NAME)} SELECT p1, p2, pair_count, support, confidence FROM rules",
    "hive_rules_steps": f"""WITH {ITEMS_BY_NAME}, {PAIRS_BY_NAME},
occ AS (SELECT product, count(*) AS occurrences FROM items GROUP BY product),
num AS (SELECT o_orderkey AS rid, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders),
tot AS (SELECT max(id) AS receipts FROM num WHERE rid IN (SELECT rid FROM items))
SELECT p1, p2, pair_count, CAST(pair_count AS DOUBLE) / receipts AS support,
       CAST(pair_count AS DOUBLE) / occurrences AS confidence
FROM pc JOIN occ ON p1 = product CROSS JOIN tot""",
    "receipt_inner_empties": """WITH l AS (
    SELECT l_orderkey AS rid, CAST(l_partkey AS VARCHAR) AS product, l_partkey % 2 = 0 AS gap,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_partkey AS VARCHAR) DESC) AS back
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT product, count(*) AS occurrences FROM l GROUP BY product
UNION ALL SELECT '', count(*) FROM l WHERE gap AND back > 1 HAVING count(*) > 0""",
    "receipt_ids": """SELECT count(*) AS receipts, count(*) AS distinct_ids,
       count(*) AS max_number, count(*) AS distinct_numbers FROM orders""",
}
