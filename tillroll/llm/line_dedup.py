"""Line deduplication over overlapping windows of three lines.

Lines with a word are hashed by two 64-bit functions with different seeds; each
three consecutive ones of a document form a window.  A window that occurs twice
or more in the corpus keeps its first occurrence (smallest document id, then
place); the lines of every later occurrence are covered, and covered lines are
removed.  Lines without a word belong to no window and stay.

All steps are DataFrame functions.  The first occurrences come from a
map-side combined aggregate, so a window that a third of the documents share
is one row per task there; the table of repeated windows is written and read
back, so the join is a plain one that adaptive execution can split at a hot
window.  Texts are shuffled only for documents that may lose lines: the others
pass a table of bits of bounded size and go straight to the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import seen_bits, split_seen
from tillroll.session import Scope

HAS_WORD = "[^\\x20\\x09-\\x0D]"
_SALT = 20_000_003  # hashed before the line: its hash is the seed of the second function


def line_hashes(line):
    """Two hashes of a line; that the first ones of two lines agree says nothing of the second ones."""
    return F.xxhash64(line), F.xxhash64(F.lit(_SALT), line)


def line_windows(docs: DataFrame, size: int = 3) -> DataFrame:
    """Windows of ``docs(id, key, lines)``: ``at`` (line numbers), hashes ``a, b``."""
    def line(x, i):
        a, b = line_hashes(x)
        return F.struct(i.alias("i"), a.alias("a"), b.alias("b"), x.rlike(HAS_WORD).alias("word"))

    marked = F.filter(F.transform("lines", line), lambda x: x["word"])
    rows = docs.select("id", "key", marked.alias("m")).where(F.size("m") >= size)
    windows = F.transform(F.sequence(F.lit(0), F.size("m") - size), lambda j: F.struct(
        F.array(*[F.get("m", j + d)["i"] for d in range(size)]).alias("at"),
        F.xxhash64(*[F.get("m", j + d)["a"] for d in range(size)]).alias("a"),
        F.xxhash64(*[F.get("m", j + d)["b"] for d in range(size)]).alias("b")))
    return rows.select("id", "key", F.explode(windows).alias("w")).select("id", "key", "w.*")


def _place(frame: DataFrame):
    return F.struct(frame["id"].isNull().alias("none"), frame["id"].alias("id"),
                    frame["key"].alias("key"), frame["at"][0].alias("line"))


def covered_lines(docs: DataFrame, size: int, scope: Scope) -> DataFrame:
    """Line numbers that later occurrences cover: ``id, key, gone``."""
    windows = line_windows(docs, size)
    first = windows.groupBy("a", "b").agg(F.min(_place(windows)).alias("first"), F.count(F.lit(1)).alias("n"))
    first = scope.keep(first.where("n > 1").select(F.col("a").alias("a1"), F.col("b").alias("b1"), "first"), "lines-first")
    later = windows.join(first, (windows["a"] == first["a1"]) & (windows["b"] == first["b1"])
                         & (_place(windows) > first["first"]))
    return later.groupBy("id", "key").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("gone"))


def _deduped(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """The columns of ``docs`` as ``u0, u1 ...`` (so that none can clash), and
    ``text, n, removed``."""
    spark = docs.sparkSession
    names = [f"u{i}" for i in range(len(docs.columns))]
    text = F.col(names[docs.columns.index(text_col)])
    base = docs.toDF(*names).withColumns({"id": F.col(names[docs.columns.index(id_col)]), "key": F.xxhash64(text)})
    lines = F.split(text, "\n", -1)
    result = Scope(spark)
    with Scope(spark) as scope:
        gone = result.keep(covered_lines(base.select("id", "key", lines.alias("lines")), size, scope), "lines-gone")
    row = F.xxhash64("id", "key")
    touched, clean = split_seen(base, row, seen_bits(row, gone))
    gone = gone.select(F.col("id").alias("gid"), F.col("key").alias("gkey"), "gone")
    both = touched.join(gone, touched["id"].eqNullSafe(gone["gid"]) & (touched["key"] == gone["gkey"]), "left")
    count = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n")
    both = both.select(*names, lines.alias("lines"), "gone", count)
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i))
    left = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(stay, "\n"))
    both = both.select(*names, left.alias("text"), "n", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed"))
    return both.unionByName(clean.select(*names, text.alias("text"), count, F.lit(0).cast("long").alias("removed")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """Remove later occurrences of three consecutive lines.

    One row per input row: the id, ``n_lines``, ``n_removed_lines``, ``text``.
    A null text stays null with no lines; an empty text is one line without a
    word; a document with fewer than ``size`` lines with a word has no window.
    Rows with the same id and text are one place and lose the same lines; a
    null id comes last in the order of occurrences.  A document may end with
    an empty text.  An empty table gives no rows; other columns are not read.
    """
    out = _deduped(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), "id", "text", size)
    return out.select(F.col("u0").alias(id_col), F.col("n").alias("n_lines"),
                      F.col("removed").alias("n_removed_lines"), "text")


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str | None = "n_chars", size: int = 3) -> DataFrame:
    """All documents and columns, with the text that is left.

    ``length_col`` (if the table has it) is set to its code points where lines
    were removed.
    """
    out = _deduped(docs, id_col, text_col, size)
    cols = {c: F.col(f"u{i}") for i, c in enumerate(docs.columns)}
    if length_col in docs.columns:
        cols[length_col] = (F.when(F.col("removed") > 0, F.char_length("text"))
                            .otherwise(cols[length_col]).cast(docs.schema[length_col].dataType))
    cols[text_col] = F.col("text")
    return out.select(*[v.alias(c) for c, v in cols.items()])
