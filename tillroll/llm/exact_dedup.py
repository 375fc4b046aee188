"""Exact deduplication with a stateful stream.

Documents are read as a stream and keyed by the SHA-256 of their normalised
text.  The keyed state has no watermark, so no key expires; it is kept in
RocksDB on the executors' disks with its changes in the checkpoint folder.
Per digest it retains the smallest document id, the content locator (file and
row) of that document, and the number of documents.  A later run of the same
stream (same state folder) continues with the state it finds.

After the stream has read what is there, the state table is read back and
every document, without its text, is joined to its digest's entry.  The texts
of hits, documents of a digest with more than one, are checked in full bytes:
a digest whose smallest and largest text are equal holds one text, the one at
the entry's locator.  That is an aggregate which map tasks combine, so a group
of a third of all rows is one text a task.  Digests that hold different texts
are grouped anew by text.  Texts of other documents pass a table of bits of
bounded size and are not shuffled.

All steps are DataFrame functions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import WORD_GAP, seen_bits, split_seen
from tillroll.session import Scope, scratch_path

# RocksDB state; a store is closed after each commit, as an open one holds
# some preallocated megabytes for every shuffle partition.
_STATE = {"spark.sql.streaming.stateStore.providerClass":
          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          "spark.sql.streaming.stateStore.unloadOnCommit": "true"}

# Files of any modification time are read: by default the stream passes over
# those that are a week older than the newest one it has seen.
MAX_FILE_AGE = "36500d"


def normalised(text: Column) -> Column:
    """Text with every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_GAP, " ")


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def literal_path(path: str, pattern: bool = False) -> str:
    """A path in which no character is taken as a pattern; a slash at its end goes.

    ``pattern=True`` makes it a pattern that only this path matches.
    """
    path = path.rstrip("/") or "/"
    last = max((i for i, c in enumerate(path) if c.isalnum()), default=-1) if pattern else -1
    return "".join(f"[{c}]" if i == last else re.sub(r"[\[\]{}*?\\]", r"\\\g<0>", c) for i, c in enumerate(path))


def _keyed(rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = normalised(rows[text_col])
    return rows.select(rows[id_col].alias("id"), text.alias("norm"), digest(text).alias("digest"),
                       F.struct(F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.row_index").alias("row")).alias("place"))


def _order() -> Column:
    """Order in which equal texts are preferred: by id, null last, then place."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "place")


def update_state(spark: SparkSession, path: str, schema: str, state_dir: str, id_col: str = "doc_id",
                 text_col: str = "text", digest: Callable[[Column], Column] = sha256_digest,
                 max_bytes_per_batch: int = 1 << 40) -> None:
    """Run the stream over the files of a Parquet table that it has not read yet."""
    before = {k: spark.conf.get(k) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        # as a pattern, since a stream takes a plain path for a folder
        rows = (spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_batch))
                .option("maxFileAge", MAX_FILE_AGE)
                .parquet(literal_path(path, pattern=True)))
        state = (_keyed(rows, id_col, text_col, digest).groupBy("digest")
                 .agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("n")))
        (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", state_dir)
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The retained entries: ``digest, first (none, id, place), n``."""
    rows = spark.read.format("statestore").load(state_dir)
    return rows.select("key.digest", F.col("value.min").alias("first"), F.col("value.count").alias("n"))


def dedup_table(spark: SparkSession, path: str, schema: str, id_col: str = "doc_id", text_col: str = "text",
                state_dir: str | None = None,
                digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """Group the rows of a Parquet table by equal normalised text.

    One row per input row: the id, ``keep_id`` (smallest id of its group),
    ``group_size``, ``kept`` (this row stays) and ``text_sha256``.  A null text
    is an empty one; a null id comes last; of rows with the same id and text
    the first one in the files stays; an empty table gives no rows; other
    columns are not read.  The stream runs when this is called; its state is
    written to ``state_dir`` (default: a new folder below the checkpoint
    folder).
    """
    state_dir = state_dir or scratch_path(spark, "dedup-state")
    update_state(spark, path, schema, state_dir, id_col, text_col, digest)
    state = read_state(spark, state_dir).withColumnRenamed("digest", "key")
    rows = _keyed(spark.read.schema(schema).parquet(literal_path(path)), id_col, text_col, digest)
    missing = F.raise_error(F.concat(F.lit("no state for a text of "), F.col("place.file")))
    sha = (F.col("digest") if digest is sha256_digest else F.sha2("norm", 256)).alias("sha")
    result = Scope(spark)
    joined = rows.select("id", "digest", "place", sha).join(state, F.col("digest") == F.col("key"), "left").select(
        "id", "digest", "place", "first", "sha",
        F.when(F.col("key").isNull(), missing.cast("long")).otherwise(F.col("n")).alias("n"))
    marked = result.keep(joined, "dedup-marked")

    hashed = F.xxhash64("digest")
    hits, _ = split_seen(rows, hashed, seen_bits(hashed, marked.where("n > 1")))
    differing = hits.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    differing = result.keep(differing.where("low <> high").select("digest"), "dedup-differing")
    if not differing.isEmpty():
        # texts that share a digest but not their bytes: group them by text
        mixed = hits.join(differing, "digest", "left_semi")
        exact = mixed.groupBy("norm").agg(F.min(_order()).alias("first2"), F.count(F.lit(1)).alias("n2"))
        regrouped = (mixed.join(exact.withColumnRenamed("norm", "norm2"), F.col("norm") == F.col("norm2"))
                     .select("id", "digest", "place", F.col("first2").alias("first"), F.sha2("norm", 256).alias("sha"),
                             F.col("n2").alias("n")))
        marked = marked.join(differing, "digest", "left_anti").unionByName(regrouped)
    return marked.select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("place") == F.col("first.place")).alias("kept"), F.col("sha").alias("text_sha256"))
