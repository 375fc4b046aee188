"""Mixture-controlled packing by deficit round-robin over source queues.

Every queue (source) is a line of tokens, its documents one after another,
each followed by the end id.  The line is cut into slots of ``slot`` tokens.
In a round each queue's deficit grows by its share of a window; it sends
whole slots while the deficit covers them and carries the rest to the next
round, so every window of ``window`` tokens holds the target proportions but
for deficits below one slot.  An exhausted queue drops out.

Because a queue's deficit after r rounds is a closed form, so is the rank of
every slot among all slots sent, and a document's place needs only three
small facts: where its tokens begin in its queue, and the totals and targets
of the queues.  The first is a running count inside the task that encoded it
plus the totals of the tasks before; that table (one row per task and queue)
carries the deficits across partitions.  It is broadcast up to
``BROADCAST_ROWS`` rows, and then no token is shuffled; a larger one is joined
by a shuffle of the encoded documents by task and queue.  No order over the
corpus is sequential, and the driver sees one row per queue.

The closed form sums over all queues, so it serves up to ``MAX_QUEUES`` of
them.  With more, the same order comes from a range sort of the slots by round,
queue and number: a slot's place is the running sum of the slots' tokens.  The
encoded documents are then shuffled once, to meet the places of their slots.

Sequences are ``window`` tokens, filled without gaps; documents are cut where
a slot or sequence ends, and only the last sequence may be short.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow
from tillroll.llm.encoding import CachedEncoder, RankEncoder, check_byte_level, ranks_of
from tillroll.llm.pretoken import Pretokenizer, probe_of_tokenizers
from tillroll.session import scratch_path

MAX_QUEUES = 4096  # of the closed form; with more queues the slots are sorted
UNIT = 1 << 16  # deficits are counted in 1/UNIT tokens
BROADCAST_ROWS = 200_000  # of the offsets table; beyond that it is joined by shuffle
SORT_SLOTS = 4_000_000  # in a task of the sort


def tokenizer_encoder(file: bytes) -> CachedEncoder | RankEncoder:
    """Encoder of a byte-level BPE tokenizer file, as the library gives the ids.

    A file whose settings this encoder does not follow is an error.
    """
    from tokenizers import Tokenizer

    check_byte_level(json.loads(file))
    tok = Tokenizer.from_str(file.decode())
    special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    if len(special) > 1:
        raise ValueError("one added token is supported")

    def many(pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch(pieces, add_special_tokens=False)]

    pretokenizer = Pretokenizer(probe_of_tokenizers(tok))
    exact = CachedEncoder(pretokenizer, many, special)
    ranks = ranks_of(json.loads(file))
    return RankEncoder(ranks, special, pretokenizer, exact) if ranks else exact


def encode_queues(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str,
                  queue_col: str) -> DataFrame:
    """Ids of every document and their place in the task's part of its queue.

    ``id, queue, block, at, n, ids``: ``block`` is the task, ``at`` the tokens
    of the queue before this document in that block.
    """
    with open(tokenizer_path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, about 1.5 MB
    end = np.uint32(end_id).tobytes()
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, block, before = tokenizer_encoder(file.value), TaskContext.get().partitionId(), {}
        for batch in batches:
            ids = [x + end for x in encoder.encode([t or "" for t in batch.column(1).to_pylist()])]
            queues = batch.column(2).to_pylist()
            n, at = [len(x) // 4 for x in ids], []
            for q, k in zip(queues, n):
                at.append(before.get(q, 0))
                before[q] = at[-1] + k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([block] * len(n), pa.int32()),
                 pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                ["id", "queue", "block", "at", "n", "ids"])

    source = docs.select(docs[id_col], docs[text_col],
                         F.coalesce(docs[queue_col].cast("string"), F.lit("")).alias("__queue"))
    return map_arrow(source, run, f"id {id_type}, queue string, block int, at bigint, n bigint, ids binary")


class Schedule:
    """Places of slots in the order in which deficit round-robin sends them.

    ``totals``: tokens of each queue; ``weights``: its target (any scale).
    Queues take their turn in a round in the given order.
    """

    def __init__(self, totals: list[int], weights: list[float], slot: int, window: int):
        self.slot, self.window = slot, window
        self.totals = np.array(totals, np.int64)
        share = np.array(weights, float)
        share = share / share.sum()
        self.quantum = np.maximum(1, np.round(share * window * UNIT)).astype(np.int64)
        self.slots = -(-self.totals // slot)
        if self.slots.max(initial=0) >= 1 << 38:
            raise ValueError("a queue has too many slots for 64-bit places")
        # rounds after which a queue is empty: more of them change nothing, and products stay below 2**63
        self.rounds = -(-self.slots * (slot * UNIT) // self.quantum)
        # the last slot of a queue may be short; later places move up
        ends = np.full(len(self.totals), -1, np.int64)
        some = np.flatnonzero(self.totals)
        ends[some] = self._rank(some, self.slots[some] - 1)
        order = np.argsort(ends, kind="stable")
        self._ends = ends[order]
        self._missing = np.concatenate([[0], np.cumsum((self.slots * slot - self.totals)[order])])

    def _rank(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Slots sent before slot ``k`` of ``queue``."""
        cost = self.slot * UNIT
        turn = -(-(k + 1) * cost // self.quantum[queue])  # the round that sends it
        out = k.copy()
        for other in range(len(self.totals)):
            rounds = np.minimum(turn - (queue <= other), self.rounds[other])
            sent = np.minimum(self.slots[other], rounds * self.quantum[other] // cost)
            out += np.where(queue == other, 0, sent)
        return out

    def position(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Tokens placed before slot ``k`` of ``queue``."""
        rank = self._rank(queue, k)
        return rank * self.slot - self._missing[np.searchsorted(self._ends, rank)]

    def pieces(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray):
        """Pieces of documents (``n`` tokens from ``start`` in ``queue``)."""
        return cut(start, n, self.slot, self.window, lambda doc, k: self.position(queue[doc], k))


def cut(start: np.ndarray, n: np.ndarray, slot: int, window: int, position):
    """Cut documents (``n`` tokens from ``start`` in their queue) into pieces.

    ``position`` gives the tokens placed before slot ``k`` of the queue of
    document ``doc``; it is asked for all slots in order of both.  Arrays
    ``doc, begin, length, place``: index of the document, first token in it,
    tokens, and place of the first token in the output.
    """
    first, last = start // slot, (start + n - 1) // slot
    many = np.where(n > 0, last - first + 1, 0)
    doc = np.repeat(np.arange(len(n)), many)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + first[doc]
    low = np.maximum(start[doc], k * slot)
    high = np.minimum((start + n)[doc], (k + 1) * slot)
    place = position(doc, k) + low - k * slot
    begin, length = low - start[doc], high - low
    # a slot that moved up may lie across two sequences
    room = window - place % window
    over = length > room
    doc2, begin2, length2, place2 = doc[over], (begin + room)[over], (length - room)[over], (place + room)[over]
    length = np.minimum(length, room)
    doc, begin = np.concatenate([doc, doc2]), np.concatenate([begin, begin2])
    length, place = np.concatenate([length, length2]), np.concatenate([place, place2])
    order = np.lexsort((begin, doc))
    doc, begin, length, place = doc[order], begin[order], length[order], place[order]
    # neighbours in the document and in the same sequence are one piece
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + length[:-1]) | (place[1:] % window == 0)
    at = np.flatnonzero(new)
    if not len(at):
        return doc, begin, length, place
    return doc[at], begin[at], np.add.reduceat(length, at), place[at]


def quanta(queues: DataFrame, targets: dict[str, float] | None, window: int) -> DataFrame:
    """``queue, total, quantum`` of ``queues(queue, tokens)``, as :class:`Schedule` has them."""
    if targets:
        named = queues.sparkSession.createDataFrame(list(targets.items()), "name string, target double")
        queues = queues.join(named, queues["queue"] == named["name"], "left")
        least = min(targets.values())
        others = queues.where("name is null").count()
        present = queues.where("name is not null").select("target").collect()
        weight, whole = F.coalesce("target", F.lit(float(least))), math.fsum([r[0] for r in present] + [least * others])
    else:
        weight, whole = F.col("tokens").cast("double"), float(queues.agg(F.sum("tokens")).first()[0])
    quantum = F.greatest(F.lit(1), F.rint(weight / F.lit(whole) * window * UNIT).cast("bigint"))
    return queues.select("queue", F.col("tokens").alias("total"), quantum.alias("quantum"))


def sorted_places(docs: DataFrame, n_slots: int, slot: int) -> DataFrame:
    """Places of the slots of ``docs(queue, start, n, total, quantum)``: ``queue, k, place``.

    Every slot is made once, from the document in which it begins.
    """
    begin, end = F.expr(f"(start + {slot - 1}) div {slot}"), F.expr(f"(start + n - 1) div {slot}")
    slots = (docs.where(begin <= end).select("queue", "total", "quantum", F.explode(F.sequence(begin, end)).alias("k"))
             .select("queue", "k", F.least(F.lit(slot), F.col("total") - F.col("k") * slot).alias("tokens"),
                     F.expr(f"((k + 1) * {slot * UNIT} + quantum - 1) div quantum").alias("turn")))
    path = scratch_path(docs.sparkSession, "packing-slots")
    (slots.repartitionByRange(n_slots // SORT_SLOTS + 1, "turn", "queue", "k")
     .withColumn("part", F.spark_partition_id()).write.parquet(path))
    slots = docs.sparkSession.read.parquet(path)
    inside = Window.partitionBy("part").orderBy("turn", "queue", "k").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of the sort
    sums = slots.groupBy(F.col("part").alias("of")).agg(F.sum("tokens").alias("held"))
    sums = sums.select("of", F.coalesce(F.sum("held").over(parts), F.lit(0)).alias("base"))
    slots = slots.select("queue", "k", "part", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("before"))
    return slots.join(F.broadcast(sums), F.col("part") == F.col("of")).select(
        "queue", "k", (F.col("base") + F.col("before")).alias("place"))


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 1024, slot: int = 256,
                   targets: dict[str, float] | None = None, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", queue_col: str = "source") -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    ``targets`` maps a queue to its weight in every window (a queue that is
    not named weighs as the smallest named one); without it the weights are
    the queues' shares of all tokens.  One row per piece: the id, ``start``,
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``,
    ``queue``.  A null or empty text is just the end id; a null queue is the
    queue ''; repeated rows are packed as often as they occur; an empty table
    gives no rows; other columns are not read.  The encoded documents are
    written to the checkpoint folder once, when this is called.  There may be
    any number of queues; with more than ``MAX_QUEUES`` the slots are written,
    too.
    """
    if slot > window:
        raise ValueError("a slot must fit into a window")
    spark = docs.sparkSession
    path = scratch_path(spark, "packing")
    (encode_queues(docs, tokenizer_path, end_id, id_col, text_col, queue_col)
     .write.option("compression", "zstd").parquet(path))
    coded = spark.read.parquet(path)
    id_type = dict(coded.dtypes)["id"]

    blocks = coded.groupBy("block", "queue").agg(F.sum("n").alias("tokens"))
    queues = blocks.groupBy("queue").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    found = sorted(queues.limit(MAX_QUEUES + 1).collect(), key=lambda r: r["queue"])
    many = len(found) > MAX_QUEUES
    least = min(targets.values()) if targets else 0
    if targets and least <= 0:
        raise ValueError("targets must be positive")
    number = {} if many else {r["queue"]: i for i, r in enumerate(found)}
    weights = [targets.get(r["queue"], least) if targets else r["tokens"] for r in found]
    schedule = Schedule([r["tokens"] for r in found], weights or [1], slot, window) if number else None

    before = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("block", "queue", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    if many:
        offsets = offsets.join(quanta(queues, targets, window), "queue")
    elif sum(r["rows"] for r in found) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    extra = ["total", "quantum"] if many else []
    placed = coded.join(offsets, ["block", "queue"]).select(
        "id", "queue", (F.col("base") + F.col("at")).alias("start"), "n", "ids", *extra)
    if many:
        n_slots = queues.agg(F.sum(F.expr(f"(tokens + {slot - 1}) div {slot}"))).first()[0]
        touched = F.explode(F.sequence(F.expr(f"start div {slot}"), F.expr(f"(start + n - 1) div {slot}"))).alias("k")
        # a queue and a start are one document, since each has at least the end id
        places = (placed.select("queue", "start", touched).join(sorted_places(placed, n_slots, slot), ["queue", "k"])
                  .groupBy("queue", "start").agg(F.array_sort(F.collect_list(F.struct("k", "place"))).alias("slots")))
        placed = placed.drop(*extra).join(places, ["queue", "start"]).select(
            "id", "queue", "start", "n", "ids", F.col("slots.place").alias("places"))

    def run(batches):
        for batch in batches:
            start = np.asarray(batch.column(2).to_pylist(), np.int64)
            n = np.asarray(batch.column(3).to_pylist(), np.int64)
            names, ids = batch.column(1).to_pylist(), batch.column(4).to_pylist()
            if schedule:
                queue = np.array([number[q] for q in names], np.int64)
                doc, begin, length, place = schedule.pieces(queue, start, n)
            else:
                places = np.asarray(batch.column(5).flatten())
                doc, begin, length, place = cut(start, n, slot, window, lambda doc, k: places)
            sums = [zlib.crc32(memoryview(ids[d])[4 * b:4 * (b + k)])
                    for d, b, k in zip(doc.tolist(), begin.tolist(), length.tolist())]
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(begin), pa.array(length), pa.array(sums, pa.int64()),
                 batch.column(3).take(at), pa.array(place // window), pa.array(place % window),
                 batch.column(1).take(at)],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    out = map_arrow(placed, run, f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, "
                                 "doc_tokens bigint, sequence_id bigint, offset bigint, queue string")
    return out.withColumnRenamed("id", id_col)
