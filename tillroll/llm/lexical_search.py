"""Ranked lexical search: term-at-a-time with a limit on accumulators.

Documents are turned into vectors of the items' terms once (written to the
checkpoint folder), statistics are summed over all of them, and every task
then answers all items over its own documents, block by block:

* the terms of an item are taken rarest first; a document that holds the term
  gets an accumulator (or adds to the one it has);
* before each term, the kth best partial score so far (of the block, or the kth
  best final score of the task's earlier blocks) is compared with what all
  remaining terms can add together, each bounded by its largest contribution
  in the block.  Once that sum is smaller, a document without an accumulator
  can't be among the best k, and no accumulator is made any more;
* the remaining terms are looked up for the survivors only, exactly.

The comparison is strict, so documents with equal scores all stay.  A task
returns at most k rows for each item, and the best k of all tasks are taken by
windows, first by item and a salt, then by item.

Items are read in blocks of about ``BLOCK_BYTES`` of text; the items of one
block and its terms' statistics are what the driver and every task hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, utf8_values
from tillroll.session import scratch_path

TOP_K = 20
BLOCK_BYTES = 8 << 20  # item text handled at once
DOCS, POSTINGS = 8192, 4 << 20  # a block of documents ends at either
PIECE = 4 << 20  # bytes of a text that are split into words at once
SALTS = 64

# Terms are runs of digits, letters and non-ASCII characters; only A-Z is folded.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def pieces(text: bytes):
    """A folded text in pieces cut at white space, so memory is bounded on long ones."""
    text = text.translate(_FOLD)
    at = 0
    while len(text) - at > PIECE:
        cut = text.rfind(b" ", at, at + PIECE)
        if cut < 0:
            cut = text.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text (UTF-8), in order, with repeats."""
    return text.translate(_FOLD).split()


def weight(documents: int, df: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs`` of every row: its number of terms, the vocabulary's
    terms that it holds (places in the vocabulary, 32-bit numbers as bytes) and
    how often."""

    def run(batches):
        place = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in utf8_values(batch.column(1)):
                many, found = 0, []
                for piece in pieces(text):
                    words = piece.split()
                    many += len(words)
                    ids = np.fromiter(map(place.get, words, repeat(-1)), np.int32, len(words))
                    found.append(np.unique(ids[ids >= 0], return_counts=True))
                ids, tf = found[0]
                if len(found) > 1:
                    ids, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                    tf = np.bincount(back, np.concatenate([f[1] for f in found]), len(ids))
                n.append(many)
                terms.append(ids.astype("<i4").tobytes())
                tfs.append(tf.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()),
                                              pa.array(tfs, pa.binary())], ["id", "n", "terms", "tfs"])

    return map_arrow(docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col]), run,
                     "id bigint, n bigint, terms binary, tfs binary")


def statistics(vecs: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the document frequency
    of each term of the vocabulary; summed within each task first."""

    def run(batches):
        df, documents, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy()
            documents, length = documents + int((n > 0).sum()), length + int(n.sum())
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
            df += np.bincount(held, minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at.tolist()], pa.int64()),
                                          pa.array([documents, length, *df[at].tolist()], pa.int64())], ["term", "n"])

    rows = map_arrow(vecs.select("n", "terms"), run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in rows.collect()}
    df = np.zeros(size, np.int64)
    for term, n in found.items():
        if term >= 0:
            df[term] = n
    return found.get(-2, 0), found.get(-1, 0), df


@dataclass
class Block:
    """The postings of a block of documents, by term."""

    ids: np.ndarray
    known: np.ndarray
    start: np.ndarray  # of each term's postings
    doc: np.ndarray
    impact: np.ndarray
    most: np.ndarray  # largest impact of each term

    @classmethod
    def of(cls, rows: list[tuple], size: int, documents: int, length: int) -> Block:
        ids = np.concatenate([r[0] for r in rows])
        known = np.concatenate([r[1] for r in rows])
        n = np.concatenate([r[2] for r in rows])
        held = [x for r in rows for x in r[3]]
        terms = np.frombuffer(b"".join(held), "<i4")
        tf = np.frombuffer(b"".join([x for r in rows for x in r[4]]), "<i4").astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), np.fromiter(map(len, held), np.int64, len(held)) // 4)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * (75 + 25 * n * documents // max(length, 1))[doc])
        order = np.argsort(terms, kind="stable")
        terms, doc, impact = terms[order], doc[order], impact[order]
        start = np.searchsorted(terms, np.arange(size + 1))
        most = np.zeros(size, np.int64)
        some = np.flatnonzero(start[1:] > start[:-1])
        if len(some):
            most[some] = np.maximum.reduceat(impact, start[some])
        return cls(ids, known, start, doc, impact, most)


def best_of(block: Block, terms: np.ndarray, factor: np.ndarray, k: int, floor_score: int):
    """Documents of a block that may be among the best k of an item, with their scores.

    ``terms`` rarest first, ``factor`` the weight times the repeats of each;
    scores below ``floor_score`` are of no use.
    """
    here = block.start[terms + 1] > block.start[terms]
    terms, factor = terms[here], factor[here]
    left = np.append(np.cumsum((factor * block.most[terms])[::-1])[::-1], 0)
    partial = np.zeros(len(block.ids), np.int64)
    least, at = max(floor_score, 1), 0
    for at, t in enumerate(terms.tolist()):
        if at and len(partial) > k:
            least = max(least, int(np.partition(partial, -k)[-k]))
        if left[at] < least:
            break
        part = slice(block.start[t], block.start[t + 1])
        partial[block.doc[part]] += factor[at] * block.impact[part]
    else:
        at = len(terms)
    alive = np.flatnonzero(partial)
    alive = alive[partial[alive] + left[at] >= least]
    score = partial[alive]
    for j, t in enumerate(terms[at:].tolist(), at):
        part = slice(block.start[t], block.start[t + 1])
        doc = block.doc[part]
        where = np.searchsorted(doc, alive)
        where[where == len(doc)] = 0
        hit = doc[where] == alive
        score[hit] += factor[j] * block.impact[part][where[hit]]
    use = score >= least
    return alive[use], score[use]


def _first(score: np.ndarray, known: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, ~known, -score))[:k]


def _answers(vecs: DataFrame, queries: list[tuple], item_type: str, size: int, documents: int, length: int,
             k: int) -> DataFrame:
    """``item, item_id, id, score``: the best k of each task's documents for every item."""

    def run(batches):
        none = np.zeros(0, np.int64)
        best = [(none, none.astype(bool), none)] * len(queries)

        def search(rows):
            block = Block.of(rows, size, documents, length)
            for q, (_, terms, factor) in enumerate(queries):
                score, known, ids = best[q]
                doc, found = best_of(block, terms, factor, k, int(score[-1]) if len(score) == k else 1)
                if len(doc):
                    score = np.concatenate([score, found])
                    known, ids = np.concatenate([known, block.known[doc]]), np.concatenate([ids, block.ids[doc]])
                    top = _first(score, known, ids, k)
                    best[q] = score[top], known[top], ids[top]

        rows, docs, postings = [], 0, 0
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            rows.append((batch.column(0).fill_null(0).to_numpy(), known, batch.column(1).to_numpy(),
                         batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            docs, postings = docs + batch.num_rows, postings + sum(map(len, rows[-1][3])) // 4
            if docs >= DOCS or postings >= POSTINGS:
                search(rows)
                rows, docs, postings = [], 0, 0
        if docs:
            search(rows)
        for q, (score, known, ids) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(score), pa.int32()), pa.array([queries[q][0]] * len(score), kind),
                     pa.array(ids, pa.int64(), mask=~known), pa.array(score)], ["item", "item_id", "id", "score"])

    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_type]
    return map_arrow(vecs, run, f"item int, item_id {item_type}, id bigint, score bigint")


def _top(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: the item's id, ``rank``
    (from 1), the document's id (as BIGINT) and ``score``.

    Equal scores are ranked by the smaller document id.  A null or empty text
    has no terms; such an item has no rows.  Of rows with the same item id,
    null included, the one with the smallest text is the item.  Every row of
    ``docs`` is a document of its own, also with a repeated id; a null id comes
    after the others of the same score.  No documents or no items give no
    rows; other columns are not read.  Runs jobs when called; the vectors are
    written to the checkpoint folder.
    """
    spark = docs.sparkSession
    asked = items.select(items[item_col].alias("item_id"), items[item_text_col].alias("t")).groupBy("item_id").agg(
        F.coalesce(F.min("t"), F.lit("")).alias("t"))
    item_type = dict(asked.dtypes)["item_id"]
    if item_type not in ("bigint", "int", "string"):
        raise ValueError(f"item ids must be BIGINT, INT or STRING, not {item_type}")
    nbytes = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-nbytes // block_bytes) or 1
    out = None
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else asked
        rows = sorted(((r["item_id"], terms_of(r["t"].encode())) for r in mine.collect()), key=str)
        vocabulary = sorted({t for _, terms in rows for t in terms})
        path = scratch_path(spark, "search-vectors")
        vectors(docs, vocabulary, id_col, text_col).write.parquet(path)
        vecs = spark.read.schema("id bigint, n bigint, terms binary, tfs binary").parquet(path)
        documents, length, df = statistics(vecs, len(vocabulary))
        place = {t: i for i, t in enumerate(vocabulary)}
        queries = []
        for item, terms in rows:
            ids, repeats = np.unique(np.array([place[t] for t in terms], np.int64), return_counts=True)
            weights = np.array([weight(documents, int(d)) if d else 0 for d in df[ids]], np.int64)
            order = np.lexsort((ids, df[ids]))
            order = order[weights[order] > 0]
            queries.append((item, ids[order], (weights * repeats)[order]))
        found = _answers(vecs, queries, item_type, len(vocabulary), documents, length, k)
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")
        found = _top(_top(found.select("*", salt), ["item", "salt"], k).drop("rank"), ["item"], k)
        found = found.select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"),
                             F.col("id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    return out
