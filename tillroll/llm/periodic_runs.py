"""Periodic runs of words, found through an enhanced suffix array.

A run is a stretch of consecutive words with a smallest period q (words q apart
are identical), of at least ``max(least, times * q)`` words, that no
neighbouring word extends with that period.

The texts of a batch are sorted together, documents kept apart: ranks by one,
two, four ... first words (a suffix whose rank is its own is not sorted again),
the suffix array, and longest common prefixes of neighbours by those ranks.
There are no tree nodes: an LCP interval is given by the nearest smaller values
around each boundary, its children by the nearest values not above it.

Branching tandem test: a square of period d that the next word does not
continue starts in one child of an interval of depth d, and its second half in
another one.  So for each suffix i of all children but the largest (every child
of at most half of the interval is taken, which leaves out no smaller one),
ISA[i + d] and ISA[i - d] are looked up in the interval outside the child: n
log n look-ups in all.  Each square found is rotated to the left as far as the
period holds, in logarithmic steps by the same ranks, and is then the end of a
run.  Squares with the same stretch merge, the smallest period stands.

A document in which no 16 words occur twice is not looked at further when
``least`` is 24 and ``times`` 3: a run of L words repeats L - q of them at a
distance of q, at least 16.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_arrow, utf8_values

LEAST, TIMES = 24, 3
BATCH_WORDS = 1 << 20  # texts are sorted together up to this many words
LOOKUPS = 1 << 21  # suffixes tested at once
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass
class Ranks:
    """``level[k]``: numbers that are equal where the first 2**k words are; the
    last level is the inverse suffix array.  ``start`` are the documents' first
    words, with the total at the end."""

    level: list[np.ndarray]
    start: np.ndarray


def _ends(start: np.ndarray) -> np.ndarray:
    return np.repeat(start[1:], np.diff(start))


def rank_suffixes(ids: np.ndarray, start: np.ndarray, spread: int = 1) -> tuple[Ranks, np.ndarray]:
    """Sort the suffixes of documents that repeat ``spread`` words or more.

    Returns the ranks of these documents and their numbers.
    """
    n = len(ids)
    docs = np.arange(len(start) - 1)
    doc = np.repeat(docs, np.diff(start))
    many = int(ids.max(initial=0)) + 2
    after = np.zeros(n, np.int64)
    if n:
        after[:-1] = ids[1:] + 1
        after[start[1:][np.diff(start) > 0] - 1] = 0
    key = (doc * many + ids) * many + after
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    changed = np.ones(n, bool)
    changed[1:] = key[order[1:]] != key[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(changed, np.arange(n), 0))
    level, words, filtered = [ids.astype(np.int32), rank.astype(np.int32)], 2, spread < 2
    while True:
        # places in the suffix array whose rank is shared
        shared = ~changed
        shared[:-1] |= ~changed[1:]
        if not filtered and (words >= spread or not shared.any()):
            filtered, keep = True, np.zeros(len(docs), bool)
            keep[np.searchsorted(start, order[shared], side="right") - 1] = True
            if not keep.all():
                size = np.where(keep, np.diff(start), 0)
                mine = np.repeat(keep, np.diff(start))
                moved = np.concatenate([[0], np.cumsum(size)])
                shift = np.repeat((moved[:-1] - start[:-1])[keep], size[keep]).astype(np.int32)
                level = [level[0][mine], *[x[mine] + shift for x in level[1:]]]
                # a document's suffixes are in the same places of the suffix array as of the text
                order, changed = order[mine] + shift, changed[mine]
                start, docs, n = np.concatenate([[0], np.cumsum(size[keep])]), docs[keep], int(size.sum())
                rank = level[-1].astype(np.int64)
                shared = shared[mine]
        at = np.flatnonzero(shared)
        if not len(at):
            break
        end = _ends(start)
        suffix = order[at]
        further = suffix + words
        inside = further < end[suffix]
        key = rank[suffix] * (n + 1)
        key[inside] += rank[further[inside]] + 1
        sort = np.argsort(key)
        key, suffix = key[sort], suffix[sort]
        order[at] = suffix
        first = np.ones(len(at), bool)
        first[1:] = key[1:] != key[:-1]
        rank[suffix] = np.maximum.accumulate(np.where(first, at, 0))
        changed[at] = first
        level.append(rank.astype(np.int32))
        words *= 2
    return Ranks(level, start), docs


def common_prefixes(ranks: Ranks, order: np.ndarray) -> np.ndarray:
    """Longest common prefixes of neighbours in the suffix array; 0 at the
    documents' first places and after the last one."""
    n = len(order)
    lcp = np.zeros(n + 1, np.int64)
    if n < 2:
        return lcp
    a, b = order[:-1].copy(), order[1:].copy()
    end = _ends(ranks.start)
    end_a, end_b = end[a], end[b]
    apart = end_a != end_b
    for k in range(len(ranks.level) - 1, -1, -1):
        rank = ranks.level[k]
        inside = (a < end_a) & (b < end_b) & ~apart
        at = np.flatnonzero(inside)
        same = at[rank[a[at]] == rank[b[at]]]
        a[same] += 1 << k
        b[same] += 1 << k
        lcp[same + 1] += 1 << k
    return lcp


def nearest(lcp: np.ndarray, step: int, below: bool) -> np.ndarray:
    """For each positive value the nearest place in the direction of ``step``
    whose value is smaller (``below``) or not larger; other places are undefined."""
    at = np.flatnonzero(lcp > 0)
    near = np.arange(len(lcp)) + step
    value = lcp[at]
    while len(at):
        there = lcp[near[at]]
        go = there >= value if below else there > value
        at, value = at[go], value[go]
        near[at] = near[near[at]]
    return near


def _children(lcp: np.ndarray):
    """Depth, interval and child (places in the suffix array, ends excluded) of
    every child of at most half of its LCP interval."""
    low, high = nearest(lcp, -1, True), nearest(lcp, 1, True)
    left, right = nearest(lcp, -1, False), nearest(lcp, 1, False)
    at = np.flatnonzero(lcp > 0)
    last = at[right[at] == high[at]]  # the last boundary of an interval also ends its last child
    child = np.concatenate([left[at], last]), np.concatenate([at, right[last]])
    at = np.concatenate([at, last])
    small = 2 * (child[1] - child[0]) <= high[at] - low[at]
    at = at[small]
    return lcp[at], low[at], high[at], child[0][small], child[1][small]


def branching_squares(ranks: Ranks, order: np.ndarray, lcp: np.ndarray):
    """Start and period of the squares that the next word does not continue."""
    depth, low, high, first, last = _children(lcp)
    length = np.diff(ranks.start)[np.searchsorted(ranks.start, order[low], side="right") - 1] if len(low) else depth
    use = 2 * depth <= length
    depth, low, high, first, last = (x[use] for x in (depth, low, high, first, last))
    inverse, n = ranks.level[-1], len(order)
    sizes = last - first
    block = np.cumsum(sizes) // LOOKUPS
    starts, periods = [], []
    for b in range(int(block[-1]) + 1 if len(block) else 0):
        c = slice(*np.searchsorted(block, [b, b + 1]))
        size = sizes[c]
        if not len(size):
            continue
        d, lo, hi, f, e = (np.repeat(x[c], size) for x in (depth, low, high, first, last))
        i = order[np.arange(len(d)) + np.repeat(first[c] - (np.cumsum(size) - size), size)]
        for other, begin in ((i + d, i), (i - d, i - d)):
            ok = np.flatnonzero((other >= 0) & (other < n))
            place = inverse[other[ok]]
            ok = ok[(lo[ok] <= place) & (place < hi[ok]) & ((place < f[ok]) | (place >= e[ok]))]
            starts.append(begin[ok])
            periods.append(d[ok])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(ids: np.ndarray, start: np.ndarray, least: int = LEAST, times: int = TIMES):
    """``document, start, length, period`` (arrays) of all runs, ordered by
    document, start and period, of documents given as word numbers."""
    # a run of L >= max(least, times * q) words repeats L - q >= this many at a distance of q
    spread = max(1, -(-least * (times - 1) // times))
    ranks, docs = rank_suffixes(ids, start, 1 << (spread.bit_length() - 1))
    if not len(docs):
        return (np.zeros(0, np.int64),) * 4
    inverse = ranks.level[-1]
    order = np.empty(len(inverse), np.int64)
    order[inverse] = np.arange(len(inverse))
    begin, period = branching_squares(ranks, order, common_prefixes(ranks, order))
    end = begin + 2 * period
    number = np.searchsorted(ranks.start, begin, side="right") - 1
    first = ranks.start[number]
    for k in range(len(ranks.level) - 1, -1, -1):  # rotate to the left while the period holds
        rank, back = ranks.level[k], begin - (1 << k)
        at = np.flatnonzero(back >= first)
        at = at[rank[back[at]] == rank[back[at] + period[at]]]
        begin[at] -= 1 << k
    long = end - begin >= np.maximum(least, times * period)
    number, begin, end, period, first = (x[long] for x in (number, begin, end, period, first))
    sort = np.lexsort((period, end, begin))
    number, begin, end, period, first = (x[sort] for x in (number, begin, end, period, first))
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])  # equal stretches: the smallest period
    number, begin, end, period, first = (x[new] for x in (number, begin, end, period, first))
    sort = np.lexsort((period, begin))
    return docs[number[sort]], (begin - first)[sort], (end - begin)[sort], period[sort]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  times: int = TIMES) -> DataFrame:
    """The runs of every whole text: the id, ``n_words``, ``runs`` (start,
    length and period in words, ordered by start, then period) and
    ``collapsed``: the words joined by a space, without those that a run
    contains after its first ``period`` words.

    ``least`` is 2 or more and ``times`` 2 or more.  One row per input row and
    no shuffle: a null or empty text has no words, no runs and an empty
    ``collapsed``; null ids and repeated rows are kept as they are; an empty
    table gives no rows; other columns are not read.  Texts are taken whole; a
    task holds about ``BATCH_WORDS`` words at once, or one text.
    """
    if least < 2 or times < 2:
        raise ValueError("least and times must be 2 or more")
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def result(batches, texts):
        number = defaultdict()
        number.default_factory = number.__len__
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ids = np.empty(start[-1], np.int64)
        for words, at, size in zip(texts, start.tolist(), sizes.tolist()):
            ids[at:at + size] = np.fromiter(map(number.__getitem__, words), np.int64, size)
        doc, begin, length, period = find_runs(ids, start, least, times)
        gone = np.zeros(start[-1] + 1, np.int64)
        np.add.at(gone, start[doc] + begin + period, 1)
        np.add.at(gone, start[doc] + begin + length, -1)
        stay = np.cumsum(gone[:-1]) == 0
        offsets = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (begin, length, period)], ["start", "length", "period"]))
        touched = set(doc.tolist())
        text = []
        for i, words in enumerate(texts):
            if i in touched:
                mine = stay[start[i]:start[i + 1]].tolist()
                words = [w for w, s in zip(words, mine) if s]
            text.append(b" ".join(words))
        out = [pa.array(sizes), runs, pa.array(text, pa.binary()).cast(pa.string())]
        at = 0
        for ids_ in batches:  # as many rows at once as came
            n = len(ids_)
            yield pa.RecordBatch.from_arrays([ids_, *[x.slice(at, n) for x in out]], ["id", "n_words", "runs", "collapsed"])
            at += n

    def run(batches):
        held, texts, words = [], [], 0
        for batch in batches:
            found = [t.split() for t in utf8_values(batch.column(1))]
            held.append(batch.column(0))
            texts += found
            words += sum(map(len, found))
            if words >= BATCH_WORDS:
                yield from result(held, texts)
                held, texts, words = [], [], 0
        if held:
            yield from result(held, texts)

    return map_arrow(docs.select(docs[id_col].alias("id"), docs[text_col]), run,
                     f"id {id_type}, n_words bigint, runs {RUN}, collapsed string").withColumnRenamed("id", id_col)
