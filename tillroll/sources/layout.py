"""Physical layout helpers for sources."""

from __future__ import annotations

from pyspark.sql import DataFrame

REBALANCE_CONF = "spark.tillroll.rebalanceScans"
TASK_BYTES = 5 << 20  # scanned bytes whose rows one task of a spread exchange holds
ADAPTIVE_BYTES = 32 << 20  # up to here adaptive execution sizes the tasks
UNKNOWN_BYTES = 1 << 50  # Spark's estimate for a frame that it knows nothing of is larger


def rebalance_scan(df: DataFrame, rebalance: bool | None = None) -> DataFrame:
    """Let adaptive execution deal out a scan's rows evenly, if asked to.

    A Parquet file is split by row groups and a compressed text file not at
    all, so a file with one large row group, or one gzip file, is read by one
    task, with everything up to the first shuffle.  ``rebalance=True`` adds
    Spark's REBALANCE hint on all columns: one exchange by hash (the same on a
    retry) whose partitions adaptive execution sizes from what it measures.  ``None`` takes the session's
    ``spark.tillroll.rebalanceScans`` (default false), for files that are few
    and large.  Nothing is looked at and no job is started while the plan is
    built; a scan with many splits, as at scale, needs none of it.
    """
    if rebalance is None:
        rebalance = df.sparkSession.conf.get(REBALANCE_CONF, "false").lower() == "true"
    return df.hint("rebalance", *df.columns) if rebalance else df


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a scan is known to be below the session's broadcast threshold.

    The size comes from the files' metadata, as the optimizer estimates it; no
    job is started.
    """
    plan = df._jdf.queryExecution()
    limit = plan.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.optimizedPlan().stats().sizeInBytes())) <= limit


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables below a frame, as the optimizer knows them from the
    files' metadata; no job is started.  Joins are not estimated."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread_partitions(df: DataFrame) -> int | None:
    """Partitions for an exchange of all rows of a frame, or None: let adaptive execution choose.

    Adaptive execution merges shuffle partitions until there is one for each
    core or ``advisoryPartitionSizeInBytes`` of *compressed* rows in each.  Rows
    of few names compress to a few bytes and take hundreds in hash tables and
    sorts, so a task's memory would grow with the input.  Above
    ``ADAPTIVE_BYTES`` of scanned tables the number is fixed instead, one for
    ``TASK_BYTES``, and a task holds the same number of rows at any size.  It is
    never the session's own number: an exchange equal to that of a join before
    it is left out of the plan, and the join's partitions are merged.  A frame of
    unknown size (one made from an RDD) stays adaptive.
    """
    size = scanned_bytes(df)
    if not ADAPTIVE_BYTES < size < UNKNOWN_BYTES:
        return None
    partitions = -(-size // TASK_BYTES)
    return partitions + (partitions == int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
