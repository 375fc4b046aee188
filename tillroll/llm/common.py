"""Shared helpers of the text operators: table reads and bounded Arrow batches."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tasks carry the functions they run, so executors need not have this library.
cloudpickle.register_pickle_by_value(sys.modules["tillroll.llm"])

# Words of the contracts: runs of anything but ASCII white space.  On UTF-8
# bytes this is exactly ``bytes.split()``.
WORD_GAP = "[\\x20\\x09-\\x0D]+"

# Rows and bytes of one Arrow batch handed to Python.  A batch is never cut
# inside a row, so the memory of a task is bounded by this and one row.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

_COLUMNS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "benchmark": "item_id BIGINT, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the text tables, with its declared columns."""
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def schema_of(name: str) -> str:
    return _COLUMNS[name]


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that this session sends to Python workers.

    The settings are read when a query is planned for execution, so they are
    set on the session; smaller values of the session are kept.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = re.fullmatch(r"(\d+)b?", str(spark.conf.get(key)))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``df.mapInArrow`` with bounded batches."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def utf8_values(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


# A table of seen hashes as bits: at most so many words of 64 bits (16 M bits).
SEEN_WORDS = 1 << 18


def seen_bits(hashes: Column, frame: DataFrame) -> DataFrame:
    """The bits ``word, bits`` of a BIGINT hash: at most ``SEEN_WORDS`` rows however many hashes there are."""
    h = frame.where(hashes.isNotNull()).select(F.pmod(hashes, F.lit(SEEN_WORDS)).alias("word"), _bit(hashes).alias("bit"))
    return h.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def split_seen(frame: DataFrame, hashes: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash may be among those of ``bits``, and rows whose hash is not.

    A Bloom filter of one bit a hash, as a broadcast join of bounded size: no
    row is shuffled.  The more hashes there are, the more rows pass in vain.
    """
    bits = F.broadcast(bits.select(F.col("word").alias("_seen_word"), F.col("bits").alias("_seen_bits")))
    marked = frame.join(bits, F.pmod(hashes, F.lit(SEEN_WORDS)) == F.col("_seen_word"), "left")
    seen = F.coalesce(F.col("_seen_bits").bitwiseAND(_bit(hashes)) != 0, F.lit(False))
    return tuple(marked.where(w).select(*[frame[c] for c in frame.columns]) for w in (seen, ~seen))


def _bit(hashes: Column) -> Column:
    # shiftleft takes a column only through SQL; the bit comes from other bits of the hash than the word
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(hashes, 40).bitwiseAND(F.lit(63)).cast("int"))
