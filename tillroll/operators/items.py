"""From receipts to items: one row per (receipt, item)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key


def explode_items(receipts: DataFrame, month_mode: str = "date") -> DataFrame:
    """Receipts ``(rid, data, products)`` -> items ``(rid, month, product)``.

    ``explode`` is a narrow generator: no shuffle, no per-receipt state, and a
    receipt without items yields no row.
    """
    return receipts.select(
        "rid",
        month_key("data", month_mode).alias("month"),
        F.explode("products").alias("product"),
    )


def with_month(items: DataFrame, month_mode: str = "date") -> DataFrame:
    """Items ``(rid, data, product)`` -> ``(rid, month, product)``."""
    return items.select("rid", month_key("data", month_mode).alias("month"), "product")


def basket(items: DataFrame, distinct_items: bool = False) -> DataFrame:
    """Collapse repeated items: ``(rid, product, c)``, c = copies on the receipt.

    The count aggregates map-side first (partial + final hash aggregate), so
    a receipt with many copies of one item shrinks to one row before any
    shuffle.  ``distinct_items=True`` sets every ``c`` to 1.  A NULL product
    is not an item.  (Both NULL filters also keep every later branch of a
    plan over the basket identical, so its shuffle is computed once and
    reused.)
    """
    b = (items.where(F.col("rid").isNotNull() & F.col("product").isNotNull())
         .groupBy("rid", "product").agg(F.count(F.lit(1)).alias("c")))
    if distinct_items:
        b = b.select("rid", "product", F.lit(1).cast("bigint").alias("c"))
    return b


def receipt_basket(items: DataFrame, distinct_items: bool = False, partitions: int | None = None) -> DataFrame:
    """:func:`basket` of receipts of bounded size, exchanged by ``rid`` alone.

    That partitioning satisfies the collapse to ``(rid, product)`` and a later
    self-join on ``rid``, so one exchange serves both; copies are collapsed
    behind it.  ``partitions`` fixes their number (None: adaptive).
    """
    items = items.where(F.col("rid").isNotNull() & F.col("product").isNotNull())
    items = items.repartition(partitions, "rid") if partitions else items.repartition("rid")
    return basket(items, distinct_items)
