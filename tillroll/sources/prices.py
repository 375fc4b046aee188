"""Price list reader: ``product,price`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

PRICE_SCHEMA = "product STRING, price DECIMAL(12,2)"
PRICE_SCALE = 2


def checked_price(value, scale: int = PRICE_SCALE) -> Column:
    """A price column as exact DECIMAL(10 + scale, scale).

    Text and numbers alike: what ``scale`` decimals can't hold is an error, it
    is never rounded.  Text that is no number is NULL.  A floating-point price
    counts as the shortest decimal that stands for it (3.9 is 3.9).
    """
    kind = f"decimal({10 + scale},{scale})"
    exact = F.trim(value.cast("string")).try_cast("decimal(38,12)")
    price = exact.try_cast(kind)
    lost = exact.isNotNull() & ~exact.eqNullSafe(price.cast("decimal(38,12)"))
    return F.when(lost, F.raise_error(F.concat(
        F.lit(f"price does not fit {kind.upper()}: "), exact.cast("string")))).otherwise(price)


def read_prices(spark: SparkSession, path: str, scale: int = PRICE_SCALE) -> DataFrame:
    """Read ``product,price`` lines as plain text, split at the commas.

    Quotes have no meaning, as in receipt lines.  The price is typed
    DECIMAL(12,2), so ``3`` and ``3.5`` are both exact and the later ``units x
    price`` needs no string-to-number guess; a list with more decimals is read
    with a larger ``scale``.  A malformed price reads as NULL; one that ``scale``
    decimals can't hold is an error.  Empty lines are skipped.
    """
    parts = F.split("value", ",", -1)
    lines = spark.read.text(path).where(F.col("value") != "")
    return lines.select(F.get(parts, 0).alias("product"), checked_price(F.get(parts, 1), scale).alias("price"))


def typed_prices(prices: DataFrame, product: str = "product", price: str = "price",
                 scale: int | None = None) -> DataFrame:
    """Project any (product, price) frame to ``product STRING, price DECIMAL(10 + scale, scale)``.

    By default the scale is that of a DECIMAL price, 2 at least, and 2 for any
    other type.  A price that it can't hold is an error, as in :func:`read_prices`.
    """
    kind = prices.schema[price].dataType
    decimal = isinstance(kind, DecimalType)
    if scale is None:
        scale = max(PRICE_SCALE, min(kind.scale, 12)) if decimal else PRICE_SCALE
    fits = decimal and kind.scale <= scale and kind.precision - kind.scale <= 10
    value = F.col(price).cast(f"decimal({10 + scale},{scale})") if fits else checked_price(F.col(price), scale)
    return prices.select(F.col(product).cast("string").alias("product"), value.alias("price"))


def price_lines(prices: DataFrame) -> DataFrame:
    """Render prices back to ``product,price`` text lines."""
    return prices.select(F.concat_ws(",", "product", F.col("price").cast("string")).alias("value"))
