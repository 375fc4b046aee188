"""Text and table sinks, and table management.

Every write replaces its target (``mode('overwrite')``), on any file system
Spark can write, so a rerun never fails on an existing output; Spark's
output commit protocol keeps a retried task from adding rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _sorted(df: DataFrame, order_by: list[str] | None) -> DataFrame:
    # a total order only at the sink: range partitioning + sort, so the part
    # files are in key order (part-00000 holds the smallest keys)
    return df.orderBy(*order_by) if order_by else df


def write_lines(df: DataFrame, path: str, col: str = "value",
                order_by: list[str] | None = None) -> None:
    """One text line per row from a STRING column (tuple text, rendered lines).

    ``order_by`` writes the lines sorted by those columns.
    """
    _sorted(df, order_by).select(F.col(col).alias("value")).write.mode("overwrite").text(path)


def write_key_value(df: DataFrame, path: str, key: str, value: str,
                    order_by: list[str] | None = None) -> None:
    """``key<TAB>value`` lines, optionally sorted by ``order_by``."""
    line = F.concat_ws("\t", F.col(key).cast("string"), F.coalesce(F.col(value).cast("string"), F.lit("")))
    _sorted(df, order_by).select(line.alias("value")).write.mode("overwrite").text(path)


def save_table(df: DataFrame, name: str, path: str | None = None,
               partition_by: list[str] | None = None, bucket_by: str | None = None,
               buckets: int | None = None) -> None:
    """Create-or-replace a Parquet table from a DataFrame (CTAS).

    With ``path`` the table is external at that location (for a shared
    folder); otherwise it lives in the session's warehouse.  ``bucket_by``
    with ``buckets`` writes it bucketed and sorted by that column: the rows are
    first partitioned as the buckets are, so each bucket is one file, not one
    of every task.
    """
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create_table(spark: SparkSession, name: str, schema: str, path: str | None = None) -> None:
    """Create an empty typed Parquet table (replacing one of the same name)."""
    drop_table(spark, name)
    empty = spark.createDataFrame([], schema)
    save_table(empty, name, path)


def load_into_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> None:
    """Load rows into a table, replacing its content; the source stays as is."""
    save_table(df, name, path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
