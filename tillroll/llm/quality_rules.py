"""Line-first quality rules.

Every line is judged on its own by three rules; failing lines are removed and
a document that loses too much of its text is rejected:

* punctuation: marks that are not prose punctuation (or shouted exclamation
  marks) outnumber a share of the words, or a long line has no sentence mark;
* navigation: several menu separators, and many of them for its words;
* boilerplate: a short line with a stock phrase of notices.

Besides, document counts are taken over the whole text, and a document with
too few words or too much repetition fails them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_arrow, utf8_values

# Symbols counted by the contract, marks of the punctuation
# rule, sentence marks, menu separators and stock phrases (lower case).
SYMBOLS = b"#*$%&|<>"
ODD_MARKS = b"#*$%&|<>!~^=+{}[]\\@_"
SENTENCE_MARKS = [x.encode() for x in (".", "!", "?", ":", ";", ",", "…", "。", "！", "？", "،", "।")]
SEPARATORS = [x.encode() for x in ("|", " > ", "»", "·", "•", " / ", "→")]
PHRASES = [x.encode() for x in (
    "all rights reserved", "copyright (c)", "copyright ©", "© 20", "cookie policy", "privacy policy",
    "use of cookies", "terms of use", "terms of service", "enable javascript", "lorem ipsum",
    "subscribe to our newsletter", "sign up for our newsletter", "click here to", "powered by wordpress",
    "skip to content", "permission is hereby granted", "licensed under the")]


@dataclass(frozen=True)
class Rules:
    """Thresholds of the rules."""

    min_words: int = 50
    max_repeat_pct: int = 50
    odd_marks_per_word: float = 0.5
    unmarked_words: int = 60
    min_separators: int = 3
    separators_per_word: float = 0.2
    phrase_words: int = 40
    max_loss: float = 0.3


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(SYMBOLS)
_INK = ~_table(b" \t\n\x0b\x0c\r") & ((np.arange(256) & 0xC0) != 0x80)  # first bytes of word characters


def line_fails(line: bytes, n_words: int, rules: Rules) -> bool:
    """Whether a line (UTF-8, with a word) is removed."""
    odd = len(line) - len(line.translate(None, ODD_MARKS))
    if odd >= 2 and odd > rules.odd_marks_per_word * n_words:
        return True
    if n_words >= rules.unmarked_words and not any(m in line for m in SENTENCE_MARKS):
        return True
    separators = sum(map(line.count, SEPARATORS))
    if separators >= rules.min_separators and separators >= rules.separators_per_word * n_words:
        return True
    if n_words <= rules.phrase_words:
        low = line.lower()
        return any(p in low for p in PHRASES)
    return False


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, first ones included."""
    n = len(words)
    if n < 4:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * len(index) + ids[1:]
    if len(index) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, back, counts = np.unique(pairs[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[back] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def judge(text: bytes, rules: Rules) -> tuple[dict, list[bytes]]:
    """Counts and verdicts of one text, and the lines that stay."""
    words = text.split()
    data = np.frombuffer(text, np.uint8)
    lines = text.split(b"\n")
    seen, stay = set(), []
    dup = removed = removed_words = 0
    for line in lines:
        k = len(line.split())
        if not k:
            stay.append(line)
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        if line_fails(line, k, rules):
            removed += 1
            removed_words += k
        else:
            stay.append(line)
    n, again = len(words), repeat_words(words)
    failed = n < rules.min_words or 100 * again > rules.max_repeat_pct * n
    return {"n_words": n, "word_chars": int(_INK[data].sum()), "n_symbols": int(_SYMBOL[data].sum()),
            "n_dup_lines": dup, "n_repeat_words": again, "base_failed": failed,
            "kept": not failed and removed_words <= rules.max_loss * n,
            "n_lines": len(lines) if text else 0, "n_removed_lines": removed,
            "n_removed_words": removed_words}, stay


_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
           ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
           ("kept", pa.bool_()), ("n_lines", pa.int64()), ("n_removed_lines", pa.int64()),
           ("n_removed_words", pa.int64())]


def judge_documents(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = True) -> DataFrame:
    """Counts, verdicts and cleaned text of every document, without a shuffle.

    One row per input row: the id, the counts, ``base_failed``, ``kept``, line
    counts and, with ``with_text``, ``clean_text`` (the lines that stay).  A
    null text has no words, fails and its clean text is empty; an empty table
    gives no rows; other input columns are not read.
    """
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        for batch in batches:
            found = [judge(x, rules) for x in utf8_values(batch.column(1))]
            columns = [batch.column(0), *(pa.array([f[k] for f, _ in found], t) for k, t in _FIELDS)]
            if with_text:
                columns.append(pa.array([b"\n".join(s).decode() for _, s in found], pa.string()))
            yield pa.RecordBatch.from_arrays(
                columns, ["id", *(k for k, _ in _FIELDS), *["clean_text"] * with_text])

    kinds = ", ".join(f"{k} {'boolean' if t == pa.bool_() else 'bigint'}" for k, t in _FIELDS)
    out = map_arrow(docs.select(docs[id_col], docs[text_col]), run,
                    f"id {id_type}, {kinds}{', clean_text string' * with_text}")
    return out.withColumnRenamed("id", id_col)


def clean_documents(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text",
                    length_col: str | None = "n_chars") -> DataFrame:
    """The documents that are kept, all columns, with the cleaned text.

    ``length_col`` (if the table has it) is set to the code points left.
    """
    names = docs.columns
    at, size_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def run(batches):
        for batch in batches:
            found = [judge(x, rules) for x in utf8_values(batch.column(at))]
            keep = pa.array([i for i, (f, _) in enumerate(found) if f["kept"]], pa.int64())
            texts = [b"\n".join(s).decode() for f, s in found if f["kept"]]
            columns = [c.take(keep) for c in batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if size_at is not None:
                columns[size_at] = pa.array([len(t) for t in texts], batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_arrow(docs, run, docs.schema)
