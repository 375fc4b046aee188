"""Adapters from the Parquet test tables to receipts, items and prices.

* receipt = an ``orders`` row (``o_orderkey``, ``o_orderdate``)
* item    = a ``lineitem`` row of that order; product = ``p_name`` of its part
  (or the part key, for revenue, since one name has several prices)
* price   = ``p_retailprice``
* a second basket set: ``events`` grouped by (user, day), item = event type

Only the needed columns are selected, so the Parquet scans read just those
(``ReadSchema`` in the plan).  Joins carry no hint: the optimizer broadcasts
a side only when its measured size is under the broadcast threshold, and
shuffles both sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.layout import rebalance_scan


# The columns each adapter reads, with the types of the test
# tables.  Declaring them skips the schema-inference job of every read and
# prunes the scan to these columns.
COLUMNS = {
    "orders": "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT",
    "part": "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE",
    "events": "user_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str, typed: bool = True) -> DataFrame:
    """Read one Parquet test table; ``typed`` reads only the declared columns."""
    reader = spark.read
    if typed and name in COLUMNS:
        reader = reader.schema(COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per receipt: ``rid, data`` (item-less orders included)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rid"), F.col("o_orderdate").alias("data"))


def order_items(spark: SparkSession, sf_dir: str, product: str = "name") -> DataFrame:
    """One row per line item: ``rid, data, product``.

    ``product='name'`` uses ``p_name``; ``product='partkey'`` uses the part
    key as text, ``product='key'`` as it is.  Items of orders that do not exist are not receipt items
    (inner join with ``orders``).
    """
    lines = rebalance_scan(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if product == "name":
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        items = items.join(part, items.l_partkey == part.p_partkey)
        prod = F.col("p_name")
    elif product == "partkey":
        prod = F.col("l_partkey").cast("string")
    elif product == "key":
        prod = F.col("l_partkey")
    else:
        raise ValueError(f"product must be 'name', 'partkey' or 'key', got {product!r}")
    return items.select(
        F.col("o_orderkey").alias("rid"), F.col("o_orderdate").alias("data"), prod.alias("product"))


def order_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rid, size``: line items per order, from one narrow scan (no join).

    An estimate for :mod:`tillroll.operators.rules`: it counts lines without
    an order or a part too.
    """
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("rid"))
    return lines.where(F.col("rid").isNotNull()).groupBy("rid").agg(F.count(F.lit(1)).alias("size"))


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product, name``: part keys and their names."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"), F.col("p_name").alias("name"))


def part_prices(spark: SparkSession, sf_dir: str, key: str = "partkey") -> DataFrame:
    """Price list ``product STRING, price DECIMAL(12,2)`` from ``part``."""
    part = table(spark, sf_dir, "part")
    prod = F.col("p_partkey").cast("string") if key == "partkey" else F.col("p_name")
    return part.select(prod.alias("product"),
                       F.col("p_retailprice").cast("decimal(12,2)").alias("price"))


def _event_basket_id() -> F.Column:
    # composite receipt key (user, day) as a struct: no string formatting,
    # compact in shuffles, usable in grouping, windows and joins
    return F.struct(F.col("user_id").alias("user_id"), F.to_date(F.col("ts")).alias("day"))


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as baskets: receipt = (user, day), item = event type."""
    ev = rebalance_scan(table(spark, sf_dir, "events").select("user_id", "ts", "event_type"))
    return ev.select(_event_basket_id().alias("rid"), F.col("ts").alias("data"),
                     F.col("event_type").alias("product"))


def order_lists(spark: SparkSession, sf_dir: str, product: str = "name") -> DataFrame:
    """``(rid, data STRING, list ARRAY<STRING>)`` for SQL with LATERAL VIEW.

    A row per line item, each with a list of one: a receipt has several rows,
    and nothing is gathered by receipt.
    """
    return order_items(spark, sf_dir, product).select(
        "rid", F.date_format("data", "yyyy-MM-dd").alias("data"), F.array("product").alias("list"))


def order_receipt_arrays(spark: SparkSession, sf_dir: str, product: str = "name") -> DataFrame:
    """Receipts ``(rid, data STRING, products ARRAY<STRING>)`` for writing text.

    Builds the input of the text readers.  A text line holds a whole
    receipt, so the items of one order are gathered into one array here
    (sorted, so the line is deterministic); item-less orders get ``[]``.
    """
    items = order_items(spark, sf_dir, product).select("rid", "product")
    lists = items.groupBy("rid").agg(F.sort_array(F.collect_list("product")).alias("products"))
    receipts = order_receipts(spark, sf_dir)
    return receipts.join(lists, "rid", "left").select(
        "rid",
        F.date_format("data", "yyyy-MM-dd").alias("data"),
        F.coalesce("products", F.array().cast("array<string>")).alias("products"))
