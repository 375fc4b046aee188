"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text are counts of bytes, words and lines, taken over the
whole text.  Trees are fitted in numpy on a bounded sample of labelled
documents: features are cut into quantile bins, each level sums gradients by
(node, feature, bin) and takes the best split of the logistic loss.  Trees
are complete and flattened into arrays (feature, threshold, leaf), so scoring
walks all trees for a batch of rows with one numpy step a level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, utf8_values

FEATURES = ("log_words", "word_length", "distinct_words", "stutters", "odd_marks", "bars", "shouts", "upper",
            "digits", "accents", "stops", "commas", "lines", "dup_lines", "quotes")
TRAIN_ROWS = 20_000  # about so many labelled documents are used for fitting


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_ODD, _UPPER, _DIGIT = _mask("#*$%&<>~^=+{}[]\\@_"), _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("0123456789")
_LOWER, _QUOTE, _GAP = _mask("abcdefghijklmnopqrstuvwxyz"), _mask("\"'()"), _mask(" \t\n\x0b\x0c\r")
_LEAD = (np.arange(256) & 0xC0) != 0x80


def statistics(text: bytes) -> list[float]:
    """The features of one text (UTF-8); an empty text has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(count[_LEAD & ~_GAP].sum())
    accents = int(count[192:].sum())
    letters = int(count[_UPPER].sum() + count[_LOWER].sum()) + accents
    lines = text.split(b"\n")
    stutters = sum(map(bytes.__eq__, words, words[1:]))
    return [np.log1p(n), chars / n, len(set(words)) / n ** 0.9, stutters / n, count[_ODD].sum() / n,
            count[ord("|")] / n, count[ord("!")] / n, count[_UPPER].sum() / max(letters, 1),
            count[_DIGIT].sum() / max(chars, 1), accents / max(chars, 1),
            (count[ord(".")] + count[ord("?")]) / n, count[ord(",")] / n, len(lines) / n,
            1 - len(set(lines)) / len(lines), count[_QUOTE].sum() / n]


@dataclass
class Trees:
    """Flattened trees: ``feature`` and ``threshold`` (tree, inner node), ``leaf``
    (tree, leaf); a row goes right where its feature exceeds the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for a matrix of features."""
        n, trees = len(rows), len(self.leaf)
        if not trees or not n:
            return np.full(n, 1 / (1 + np.exp(-self.prior)))
        depth = int(self.leaf.shape[1]).bit_length() - 1
        at = np.zeros((n, trees), np.int64)
        tree, row = np.arange(trees), np.arange(n)[:, None]
        for _ in range(depth):
            right = rows[row, self.feature[tree, at]] > self.threshold[tree, at]
            at = 2 * at + 1 + right
        margin = self.prior + self.leaf[tree, at - (2 ** depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 48,
              rate: float = 0.2, least_hessian: float = 5.0, penalty: float = 1.0) -> Trees:
    """Fit boosted trees to 0/1 labels; the result depends on the rows alone."""
    inner = 2 ** depth - 1
    n, width = rows.shape
    mean = float(np.clip(labels.mean(), 0.01, 0.99)) if n else 0.5
    prior = float(np.log(mean / (1 - mean)))
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                  np.zeros((trees, inner + 1)), prior)
    if n < 2 or labels.min() == labels.max():
        return Trees(model.feature[:0], model.threshold[:0], model.leaf[:0], prior)
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(n, prior)
    column = np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - labels, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            index = ((node - first)[:, None] * (width * bins) + column + binned).ravel()
            shape = (many, width, bins)
            g = np.bincount(index, np.repeat(grad, width), many * width * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(index, np.repeat(hess, width), many * width * bins).reshape(shape).cumsum(axis=2)
            total_g, total_h = g[:, :, -1:], h[:, :, -1:]
            gain = (g ** 2 / (h + penalty) + (total_g - g) ** 2 / (total_h - h + penalty)
                    - total_g ** 2 / (total_h + penalty))
            gain[(h < least_hessian) | (total_h - h < least_hessian)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for i in range(many):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-9 and b < len(cuts[f]):
                    model.feature[t, first + i], model.threshold[t, first + i] = f, cuts[f][b]
            right = rows[np.arange(n), model.feature[t, node]] > model.threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        model.leaf[t] = -rate * g / (h + penalty)
        margin += model.leaf[t][leaf]
    return model


def in_fold(id_col: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32 of the id as text falls into a fold; a null id does not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality") -> Trees:
    """Fit on about ``train_rows`` labelled documents outside the held-out fold.

    The sample is drawn by a hash of the id before any text is read, so it is
    the same on every run; its ids (at most about ``train_rows``) are
    broadcast and its features are collected.  Null ids or labels are left
    out, an id with several labels takes the smallest, one with several texts
    the smallest row of features.  Without usable labels every score is 0.5.
    """
    usable = labels.where(labels[id_col].isNotNull() & labels[label_col].isNotNull() & ~in_fold(labels[id_col]))
    usable = usable.groupBy(usable[id_col].alias("id")).agg(F.min(usable[label_col]).alias("label"))
    found = usable.count()
    if found > train_rows:
        cut = int(train_rows / found * (1 << 30))
        usable = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < cut)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = texts.join(F.broadcast(usable), "id").select("id", "label", "text")

    def run(batches):
        for batch in batches:
            rows = [[float(x) for x in statistics(t)] for t in utf8_values(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["id", "label", "x"])

    id_type, label_type = (dict(texts.dtypes)[c] for c in ("id", "label"))
    sample = (map_arrow(texts, run, f"id {id_type}, label {label_type}, x array<double>")
              .groupBy("id").agg(F.min(F.struct("label", "x")).alias("row")).collect())
    sample.sort(key=lambda r: str(r["id"]))
    x = np.array([r["row"]["x"] for r in sample], float).reshape(len(sample), len(FEATURES))
    return fit_trees(x, np.array([r["row"]["label"] for r in sample], float))


def score_documents(docs: DataFrame, model: Trees, threshold: float = 0.7, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Score every whole text: the id, ``held_out``, ``score``, ``predicted``.

    No shuffle.  A null text counts as empty and is scored too; repeated rows
    give repeated results; an empty table gives none; other columns are not
    read.
    """
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        for batch in batches:
            rows = np.array([statistics(t) for t in utf8_values(batch.column(1))], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(rows.reshape(-1, len(FEATURES))))], ["id", "score"])

    out = map_arrow(docs.select(docs[id_col], docs[text_col]), run, f"id {id_type}, score double")
    return out.select(F.col("id").alias(id_col), in_fold(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: Trees, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The documents that score ``threshold`` or more, all columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            rows = np.array([statistics(t) for t in utf8_values(batch.column(at))], float)
            keep = np.flatnonzero(model.score(rows.reshape(-1, len(FEATURES))) >= threshold)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep)) for c in batch.columns],
                                             names=batch.schema.names)

    return map_arrow(docs, run, docs.schema)
