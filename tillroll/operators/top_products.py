"""Q1: the best-selling products of every month (top k per group)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.sources.layout import fits_broadcast


def monthly_counts(items: DataFrame) -> DataFrame:
    """Units per (month, product): ``month, product, units BIGINT``."""
    return items.groupBy("month", "product").agg(F.count(F.lit(1)).alias("units"))


def monthly_counts_sum_of_ones(items: DataFrame) -> DataFrame:
    """The same counts written as a sum of ones (partial + final sums)."""
    return (items.select("month", "product", F.lit(1).cast("bigint").alias("one"))
            .groupBy("month", "product").agg(F.sum("one").alias("units")))


def name_counts(counts: DataFrame, names: DataFrame, by: list[str], value: str) -> DataFrame:
    """Counts per product key -> counts per product name.

    ``counts`` has ``by`` columns, ``product`` (the key) and ``value``;
    ``names`` has ``product, name``, one row per key.  The items are counted by
    key first, so the join sees one row per group and key, never an item, and
    the names' counts are a second sum.  Keys without a name drop out (inner
    join).
    """
    named = counts.join(names, "product").select(*by, F.col("name").alias("product"), value)
    return named.groupBy(*by, "product").agg(F.sum(value).alias(value))


def named_counts(items: DataFrame, names: DataFrame, by: list[str], value: str) -> DataFrame:
    """Items per ``by`` and product name, from items with product keys.

    A name table below the broadcast threshold (a checked size) is joined in the
    map tasks, so their partial counts are by name already.  A larger one meets
    counts by key (:func:`name_counts`).  Either way no item is shuffled by its key.
    """
    if fits_broadcast(names):
        named = items.join(F.broadcast(names), "product").select(*by, F.col("name").alias("product"))
        return named.groupBy(*by, "product").agg(F.count(F.lit(1)).alias(value))
    counts = items.where(F.col("product").isNotNull()).groupBy(*by, "product").agg(F.count(F.lit(1)).alias(value))
    return name_counts(counts, names, by, value)


def top_k(counts: DataFrame, group: str, order_value: str, order_name: str,
          k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the ``k`` best rows of every group: value descending, then name.

    ``row_number() <= k`` lets the optimizer add a partial WindowGroupLimit
    before the shuffle, so each task sends at most k rows per group however
    large the group is.  Ties are broken by name, so the result is total.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy(group).orderBy(F.col(order_value).desc(), F.col(order_name).asc())
    return (counts.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k))


def monthly_top_products(items: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` products of every month by units.

    Returns ``month STRING, rank INT, product STRING, units BIGINT``; ties
    at equal units are ordered by product name ascending.  A month with
    fewer than ``k`` products has fewer rows.
    """
    return top_of_counts(monthly_counts(items), k)


def top_of_counts(counts: DataFrame, k: int = 5) -> DataFrame:
    """:func:`monthly_top_products` from ``month, product, units``."""
    return top_k(counts, "month", "units", "product", k).select("month", "rank", "product", "units")
