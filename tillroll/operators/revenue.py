"""Q2: revenue of every product per month (units x list price)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.prices import typed_prices

TOTAL_DIGITS = 20  # before the point of a total


def product_month_counts(items: DataFrame) -> DataFrame:
    """Units per (product, month): ``product, month, units``."""
    return items.groupBy("product", "month").agg(F.count(F.lit(1)).alias("units"))


def dedup_prices(prices: DataFrame, rule: str = "max") -> DataFrame:
    """One price per product (duplicate price rows collapse deterministically)."""
    agg = {"max": F.max, "min": F.min}.get(rule)
    if agg is None:
        raise ValueError(f"rule must be 'max' or 'min', got {rule!r}")
    return prices.groupBy("product").agg(agg("price").alias("price"))


def monthly_revenue(items: DataFrame, prices: DataFrame, how: str = "inner",
                    zero_is_missing: bool = False, dedup: str | None = None) -> DataFrame:
    """Units and revenue per (product, month).

    Counts are aggregated before the join (the join sees one row per product
    and month, not one per item).  Returns ``product, month, units BIGINT,
    price DECIMAL(12,2), total DECIMAL(22,2)`` (a price list of a larger scale
    keeps it in both).

    * ``how='inner'``: only products that sold and have a price.
    * ``how='full'``: also products without a price (price and total NULL)
      and priced products without sales (month and units NULL).
    * ``zero_is_missing=True``: a price of 0 counts as no price (with
      ``'full'`` the product stays, with price and total NULL).
    * ``dedup='max'``: one price per product; by default every price row
      joins (a product with two prices gets two rows per month).
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be 'inner' or 'full', got {how!r}")
    p = typed_prices(prices)
    if zero_is_missing:  # the full join keeps the product, only its price is blank
        p = (p.where(F.col("price") != 0) if how == "inner"
             else p.withColumn("price", F.when(F.col("price") != 0, F.col("price"))))
    if dedup:
        p = dedup_prices(p, dedup)
    joined = (product_month_counts(items).join(p, "product") if how == "inner" else co_group(items, p))
    scale = p.schema["price"].dataType.scale
    total = (F.col("units").cast("decimal(20,0)") * F.col("price")).cast(f"decimal({TOTAL_DIGITS + scale},{scale})")
    return joined.select("product", "month", "units", "price", total.alias("total"))


def co_group(items: DataFrame, prices: DataFrame) -> DataFrame:
    """Full outer join of monthly counts and prices as one tagged aggregation.

    Sales and prices are united with a tag and counted by (product, month,
    price): map tasks combine, so a hot product leaves each of them as a few
    rows.  What is left, a row per product and month or price, is gathered once
    by product, and every month meets every price there (a side that is missing
    gives NULLs).  The lists of a product are as long as its months and its price
    rows.  NULL matches nothing, as in a join: the two sides of the NULL product
    stay apart.
    """
    none = F.lit(None)
    sales = items.select("product", F.lit(True).alias("sale"), "month", none.cast(prices.schema["price"].dataType).alias("price"))
    listed = prices.select("product", F.lit(False).alias("sale"), none.cast("string").alias("month"), "price")
    rows = sales.unionByName(listed).groupBy("product", "sale", "month", "price").agg(F.count(F.lit(1)).alias("n"))
    apart = F.when(F.col("product").isNull(), F.col("sale"))
    sold = F.when(F.col("sale"), F.struct("month", F.col("n").alias("units")))
    offered = F.when(~F.col("sale"), F.struct("price", "n"))
    by_product = rows.groupBy("product", apart.alias("apart")).agg(
        F.collect_list(sold).alias("sold"), F.collect_list(offered).alias("offered"))
    # a price that is listed twice counts twice
    each = F.flatten(F.transform("offered", lambda o: F.array_repeat(o["price"], o["n"].cast("int"))))
    return (by_product.select("product", F.explode_outer("sold").alias("s"), each.alias("each"))
            .select("product", F.col("s.month").alias("month"), F.col("s.units").alias("units"),
                    F.explode_outer("each").alias("price")))
