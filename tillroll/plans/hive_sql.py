"""The table-based questions as plain Spark SQL over temporary views.

For users who keep their questions in SQL: receipts live in a view
``(rid, data STRING, list ARRAY<STRING>)`` with any number of rows a receipt
(nothing is gathered for it), prices in ``(product, price)``;
items come from ``LATERAL VIEW explode``, the price join is written as a
comma join with the equality in ``WHERE`` (the optimizer turns it into an
equi join), and months are a computed ``GROUP BY`` key.  Top-k is cut with
``row_number`` before anything is collected per month.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.ids import with_row_number
from tillroll.operators.rules import HOT_ITEMS_DEFAULT, MAX_HOT
from tillroll.session import Scope
from tillroll.sources.layout import spread_partitions
from tillroll.sources.sinks import save_table

TOP_COLUMNS_SQL = """
WITH counts AS (
    SELECT date_format(try_cast(data AS DATE), 'yyyy-MM') AS month, prod, count(1) AS n
    FROM {receipts} LATERAL VIEW explode(list) sub AS prod
    GROUP BY date_format(try_cast(data AS DATE), 'yyyy-MM'), prod),
ranked AS (
    SELECT month, prod, n, row_number() OVER (PARTITION BY month ORDER BY n DESC, prod) AS rk
    FROM counts)
SELECT month,
       max(CASE WHEN rk = 1 THEN concat(prod, ' ', n, ', ') END) AS top1,
       max(CASE WHEN rk = 2 THEN concat(prod, ' ', n, ', ') END) AS top2,
       max(CASE WHEN rk = 3 THEN concat(prod, ' ', n, ', ') END) AS top3,
       max(CASE WHEN rk = 4 THEN concat(prod, ' ', n, ', ') END) AS top4,
       max(CASE WHEN rk = 5 THEN concat(prod, ' ', n, ', ') END) AS top5
FROM ranked WHERE rk <= 5
GROUP BY month
"""

REVENUE_SQL = """
WITH sold_items AS (
    SELECT item, date_format(try_cast(data AS DATE), 'yyyy-MM') AS sold_in
    FROM {receipts} LATERAL VIEW explode(list) exploded AS item),
unit_counts AS (
    SELECT item, sold_in, count(*) AS sold_units FROM sold_items GROUP BY item, sold_in)
SELECT unit_counts.item AS product, sold_in AS month, sold_units AS units,
       CAST(sold_units * list_price.price * 100 AS BIGINT) AS total_cents
FROM unit_counts, {prices} AS list_price
WHERE list_price.product = unit_counts.item
"""


# Support and confidence of every ordered pair of different products.  The
# receipts of more than {hot_items} rows (the {most} largest) are split off and
# joined in blocks of buckets, so that none meets one task.
RULES_SQL = """
WITH sold AS (
    SELECT rid, item FROM {receipts} LATERAL VIEW explode(list) exploded AS item
    WHERE rid IS NOT NULL AND item IS NOT NULL),
large AS (
    SELECT rid FROM (SELECT rid, count(*) AS size FROM {receipts} WHERE rid IS NOT NULL GROUP BY rid)
    WHERE size > {hot_items} ORDER BY size DESC, rid LIMIT {most}),
plain AS (
    SELECT /*+ BROADCAST(large) */ rid, item, count(*) AS copies
    FROM (SELECT /*+ REPARTITION({by_rid}) */ * FROM sold LEFT ANTI JOIN large USING (rid)) GROUP BY rid, item),
spread AS (
    SELECT /*+ BROADCAST(large) */ rid, item, count(*) AS copies
    FROM sold LEFT SEMI JOIN large USING (rid) GROUP BY rid, item),
bucketed AS (
    SELECT /*+ BROADCAST(sized) */ spread.rid, item, copies, buckets, CAST(pmod(xxhash64(item), buckets) AS INT) AS bucket
    FROM spread, (SELECT rid, CAST(ceil(count(*) / {hot_items}) AS INT) AS buckets FROM spread GROUP BY rid LIMIT {most}) sized
    WHERE spread.rid = sized.rid),
lefts AS (
    SELECT rid, item, copies, bucket AS i, j FROM bucketed LATERAL VIEW explode(sequence(bucket, buckets - 1)) blocks AS j),
rights AS (
    SELECT rid, item, copies, i, bucket AS j FROM bucketed LATERAL VIEW explode(sequence(0, bucket)) blocks AS i),
couples AS (
    SELECT x.item AS a, y.item AS b, sum(x.copies * y.copies) AS times
    FROM plain x JOIN plain y ON x.rid = y.rid WHERE x.item < y.item GROUP BY x.item, y.item
    UNION ALL
    SELECT least(x.item, y.item), greatest(x.item, y.item), sum(x.copies * y.copies)
    FROM lefts x JOIN rights y ON x.rid = y.rid AND x.i = y.i AND x.j = y.j
    WHERE x.i < x.j OR x.item < y.item GROUP BY least(x.item, y.item), greatest(x.item, y.item)),
summed AS (SELECT a, b, sum(times) AS times FROM couples GROUP BY a, b),
ordered AS (SELECT stack(2, a, b, times, b, a, times) AS (p1, p2, pair_count) FROM summed),
singles AS (
    SELECT item, sum(copies) AS occurrences
    FROM (SELECT item, copies FROM plain UNION ALL SELECT item, copies FROM spread) GROUP BY item)
SELECT p1, p2, pair_count, pair_count / (SELECT CAST(count(*) AS DOUBLE) FROM {headers}) AS support,
       pair_count / CAST(occurrences AS DOUBLE) AS confidence
FROM ordered JOIN singles ON ordered.p1 = singles.item
"""

# The same in steps, each a table, with joins in the WHERE clause; receipts go by
# their number, and the highest number that sold something counts them.
RULE_STEPS = (
    ("id_item", """SELECT id, item, count(*) AS copies FROM {numbered} LATERAL VIEW explode(list) exploded AS item
                   WHERE item IS NOT NULL GROUP BY id, item"""),
    ("single", "SELECT item, sum(copies) AS occurrences FROM {id_item} GROUP BY item"),
    ("couple", """SELECT x.item AS p1, y.item AS p2, sum(x.copies * y.copies) AS pair_count
                  FROM {id_item} x, {id_item} y WHERE x.id = y.id AND x.item != y.item GROUP BY x.item, y.item"""),
    ("highest", "SELECT max(id) AS receipts FROM {id_item}"),
)
RULE_STEPS_SQL = """
SELECT p1, p2, pair_count, pair_count / (SELECT CAST(receipts AS DOUBLE) FROM {highest}) AS support,
       pair_count / CAST(occurrences AS DOUBLE) AS confidence
FROM {couple}, {single} WHERE p1 = item
"""


def _run(spark: SparkSession, sql: str, values: dict | None = None, **views: DataFrame) -> DataFrame:
    """The result of a statement over frames; their views leave the catalog at once."""
    with Scope(spark) as scope:
        names = {stem: scope.view(df, stem) for stem, df in views.items()}
        return spark.sql(sql.format(**names, **(values or {})))


def top_columns_sql(spark: SparkSession, receipts: DataFrame) -> DataFrame:
    """Top-5 products of each month as five text columns, in SQL."""
    return _run(spark, TOP_COLUMNS_SQL, receipts=receipts)


def revenue_sql(spark: SparkSession, receipts: DataFrame, prices: DataFrame) -> DataFrame:
    """Units and revenue (cents) per product and month, in SQL."""
    return _run(spark, REVENUE_SQL, receipts=receipts, prices=prices)


def rules_sql(spark: SparkSession, receipts: DataFrame, headers: DataFrame,
              hot_items: int = HOT_ITEMS_DEFAULT) -> DataFrame:
    """Rules of every pair of different products, as one statement.

    ``receipts`` is ``(rid, list)``, any number of rows a receipt; ``headers``
    has one row per receipt.
    """
    partitions = spread_partitions(receipts)
    by_rid = f"{partitions}, rid" if partitions else "rid"
    return _run(spark, RULES_SQL, {"hot_items": hot_items, "most": MAX_HOT, "by_rid": by_rid},
                receipts=receipts, headers=headers)


def rules_steps_sql(spark: SparkSession, receipts: DataFrame, headers: DataFrame) -> DataFrame:
    """The same rules in steps, each written as a table.

    Receipts get dense numbers in ``rid`` order; the highest number with an
    item is the number of receipts (later receipts without items don't count).
    The self-join reads a table bucketed by number, so it needs no shuffle.
    """
    numbers = with_row_number(headers.select("rid"), ["rid"], "id")
    numbered = receipts.join(numbers, "rid").select("id", "list")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    result = Scope(spark)
    with Scope(spark) as scope:
        names = {"numbered": scope.view(numbered, "numbered")}
        for stem, sql in RULE_STEPS:
            names[stem] = result.table(f"tillroll_{stem}_{uuid.uuid4().hex[:12]}")
            bucketed = {"bucket_by": "id", "buckets": buckets} if stem == "id_item" else {}
            save_table(spark.sql(sql.format(**names)), names[stem], (scope if bucketed else result).path(stem), **bucketed)
        rules = spark.sql(RULE_STEPS_SQL.format(**names))
    result.release()
    return rules
