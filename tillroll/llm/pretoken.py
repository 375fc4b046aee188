"""Vectorised pre-tokens of the byte-level tokenizers.

The split pattern of these vocabularies,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is regular, and where a pre-token starts depends on four character classes
(letter, number, white space, other) of a few neighbours.  ``starts`` finds
all starts of a block of text at once with numpy.  Which class a code point
has is asked of the tokenizer library itself, once per code point seen: the
Unicode versions of the libraries differ.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

UNKNOWN, LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3, 4

# Fixed value: the split pattern of these vocabularies.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# What may follow an apostrophe in a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

Probe = Callable[[str], "tuple[bool, bool, bool]"]


def probe_of_tokenizers(tokenizer) -> Probe:
    """Class probe through the pre-tokenizer of a ``tokenizers.Tokenizer``."""
    split = tokenizer.pre_tokenizer.pre_tokenize_str

    def joined(text: str, at: int) -> bool:
        return all(s != at for _, (s, _) in split(text))

    return lambda c: (joined(f"a{c}", 1), joined(f"{c}1", 1), joined(f"{c}.", 1))


def probe_of_tiktoken(pattern: str) -> Probe:
    """Class probe through tiktoken with ``pattern``: a toy vocabulary that has
    every pair (a, lead byte), (last byte, 1) and (last byte, .), so two
    characters of one pre-token show as a merged pair."""
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    for b in range(256):
        for pair in (bytes([97, b]), bytes([b, 49]), bytes([b, 46])):
            ranks.setdefault(pair, len(ranks))
    toy = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def joined(text: str) -> bool:
        return len(toy.encode_ordinary(text)) < len(text.encode())

    return lambda c: (joined(f"a{c}"), joined(f"{c}1"), joined(f"{c}."))


class Pretokenizer:
    """Starts of pre-tokens; the class table fills as code points are seen."""

    def __init__(self, probe: Probe):
        self._probe = probe
        self._table = np.zeros(0x110000, np.uint8)
        self._table[32] = SPACE  # joins what follows, so the probe can't tell

    def classes(self, points: np.ndarray) -> np.ndarray:
        """The class of each code point."""
        found = self._table[points]
        if not found.all():
            for c in np.unique(points[found == UNKNOWN]).tolist():
                letter, number, other = self._probe(chr(c))
                self._table[c] = LETTER if letter else NUMBER if number else OTHER if other else SPACE
            found = self._table[points]
        return found

    def starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pre-tokens start, as a mask over the code points.

        ``points``: code points of several texts one after another; ``first``:
        mask of the first code point of each text.
        """
        n = len(points)
        if n == 0:
            return np.zeros(0, bool)
        cls = self.classes(points)
        last = np.empty(n, bool)
        last[:-1], last[-1] = first[1:], True
        before = np.empty(n, np.uint8)
        before[0], before[1:] = UNKNOWN, cls[:-1]
        after = np.empty(n, np.uint8)
        after[-1], after[:-1] = UNKNOWN, cls[1:]
        before[first] = UNKNOWN
        after[last] = UNKNOWN
        blank = np.empty(n, bool)  # the character before is a plain space of the same text
        blank[0], blank[1:] = False, points[:-1] == 32
        blank &= ~first

        space = cls == SPACE
        start = (cls != before) & ~(blank & ~space)
        # the last white space before a word is on its own or joins the word
        start |= space & (after != SPACE) & (after != UNKNOWN)
        start |= first

        # contractions: an apostrophe that starts a pre-token and what follows it
        for i in np.flatnonzero((points == 39) & start & (after == LETTER)).tolist():
            tail = points[i + 1:i + 3].tolist()
            stop = i + 1
            while stop < min(i + 3, n) and not first[stop]:
                stop += 1
            text = "".join(map(chr, tail[:stop - i - 1]))
            size = 1 if text[:1] in CONTRACTIONS else 2 if text in CONTRACTIONS else 0
            if size:
                start[i + 1:i + 1 + size] = False
                if i + 1 + size < n:
                    start[i + 1 + size] = True
        return start

    def split(self, text: str) -> list[str]:
        """The pre-tokens of one text."""
        if not text:
            return []
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        first = np.zeros(len(points), bool)
        first[0] = True
        at = np.flatnonzero(self.starts(points, first)).tolist()
        return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]
