"""Receipt ids: random surrogate ids and dense row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_EACH = 32  # sampled keys per range


def with_random_id(df: DataFrame, name: str = "id", via: str = "uuid") -> DataFrame:
    """Prepend a random id column (star projection plus one column).

    ``via='uuid'`` uses ``uuid()``, ``via='reflect'`` calls
    ``java.util.UUID.randomUUID`` through ``reflect``.  The value is random:
    write the frame (or checkpoint it) before joining it with itself.
    """
    expr = F.expr("uuid()") if via == "uuid" else F.expr("reflect('java.util.UUID', 'randomUUID')")
    return df.select(expr.alias(name), "*")


def _ranges(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_splitters(df: DataFrame, order_cols: list[str], ranges: int) -> Column:
    """A scalar subquery: at most ``ranges - 1`` sorted keys that cut the rows into ranges.

    They are quantiles of about ``SAMPLE_EACH`` different keys a range, taken by
    a hash of the key: the same keys whenever the plan runs.
    """
    wanted = SAMPLE_EACH * ranges
    cols = [F.col(c) for c in order_cols]
    keys = df.select(F.struct(*cols).alias("k"), F.xxhash64(*cols).alias("h"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    keys = keys.where(F.pmod("h", F.lit(1 << 30)) * rows <= 2 * wanted * (1 << 30)).distinct()
    keys = keys.orderBy("h", "k").limit(wanted).agg(F.array_sort(F.collect_list("k")).alias("ks"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)),
                       lambda i: F.get("ks", F.floor(i * F.size("ks") / ranges).cast("int")))
    return keys.select(F.filter(cuts, lambda c: c.isNotNull())).scalar()


def with_row_number(df: DataFrame, order_cols: list[str], name: str = "id", ranges: int | None = None) -> DataFrame:
    """Dense 1..n numbers in ``order_cols`` order, without a one-partition window.

    1. splitters from a sample of the keys, as a scalar subquery;
    2. every row finds its range by binary search in the splitters;
    3. a window numbers the rows of each range (``ranges`` of them, by default the
       session's shuffle partitions), and a count per range, summed up over the
       ranges before it, gives the range's offset;
    4. number = offset of the range + number in the range.

    All of it is one lazy plan: no job runs before the action.  The order columns
    must be the same each time the frame is computed (no random value); rows
    that are equal in all of them are numbered in any order and share a range,
    so choose columns of which no one value holds a large part of the rows.
    Only the offsets are broadcast, one row per range.
    """
    ranges = ranges or _ranges(df)
    cols = [F.col(c) for c in order_cols]
    steps = [1 << i for i in reversed(range((ranges - 1).bit_length()))]
    cut = df.select("*", range_splitters(df, order_cols, ranges).alias("_cuts"))
    key = F.struct(*cols)
    at = F.reduce(F.array(*map(F.lit, steps)), F.lit(0), lambda below, step: F.when(
        key >= F.get("_cuts", below + step - 1), below + step).otherwise(below))
    tagged = cut.select("*", at.alias("_range")).drop("_cuts")
    counts = tagged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*cols))
    numbered = tagged.withColumn("_place", place).join(F.broadcast(offsets), "_range")
    return numbered.select((F.col("_off") + F.col("_place")).alias(name), *[F.col(c) for c in df.columns])
