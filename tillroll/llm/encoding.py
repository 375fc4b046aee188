"""Cached encoding of whole texts, one pre-token at a time.

Byte-level BPE never merges across pre-tokens, so the ids of a text are the
ids of its pre-tokens in order.  Words repeat, so each worker keeps a bounded
cache from pre-token to ids and asks the tokenizer only for new ones.  The
cache has two generations, so frequent pre-tokens outlive rare ones.

A tokenizer file whose ids are numbered in merge order is also a table of
ranks, which tiktoken encodes several times as fast.  ``RankEncoder`` does so
for every text in which both libraries see the same characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

from tillroll.llm.pretoken import SPLIT_PATTERN, UNKNOWN, Pretokenizer, probe_of_tiktoken

CACHE_ENTRIES = 400_000
CACHE_LENGTH = 48
BLOCK_CHARS = 1 << 20
LONG_RUN = 1000  # characters of one class; a pre-token beyond that is slow in tiktoken
DIFFERENT = 255  # a character of another class in the other library


class CachedEncoder:
    """Texts to little-endian unsigned 32-bit ids.

    ``encode_many`` gives the ids of a list of pre-tokens.  ``special`` maps a
    string that is cut out of texts before anything else to its id.  A long
    pre-token is encoded anew each time, and of a full generation only what is
    used again survives, so the memory stays bounded.
    """

    def __init__(self, pretokenizer: Pretokenizer,
                 encode_many: Callable[[list[str]], Iterable[list[int]]],
                 special: dict[str, int] | None = None):
        self._pre, self._encode = pretokenizer, encode_many
        self._special = {k: np.uint32(v).tobytes() for k, v in (special or {}).items()}
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        out: list[bytes] = []
        block: list[str] = []
        size = 0
        for text in texts:
            if block and size + len(text) > BLOCK_CHARS:
                out += self._with_specials(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        return out + self._with_specials(block)

    def _with_specials(self, texts: list[str]) -> list[bytes]:
        for mark, ids in self._special.items():
            if any(mark in t for t in texts):
                parts = [t.split(mark) for t in texts]
                coded = iter(self._block([p for ps in parts for p in ps]))
                return [ids.join(next(coded) for _ in ps) for ps in parts]
        return self._block(texts)

    def _block(self, texts: list[str]) -> list[bytes]:
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        bounds = np.cumsum([0, *map(len, texts)])
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        first = np.zeros(len(points), bool)
        first[bounds[:-1][bounds[:-1] < len(points)]] = True
        at = np.flatnonzero(self._pre.starts(points, first))
        cuts = np.searchsorted(at, bounds).tolist()
        ends = at.tolist()
        pieces = [joined[a:b] for a, b in zip(ends, [*ends[1:], len(joined)])]
        if len(self._cache) > CACHE_ENTRIES:
            self._older, self._cache = self._cache, {}
        coded = list(map(self._cache.get, pieces))
        missing = list(dict.fromkeys(p for p, c in zip(pieces, coded) if c is None))
        if missing:
            new = {p: c for p in missing if (c := self._older.get(p)) is not None}
            fresh = [p for p in missing if p not in new]
            if fresh:
                new.update((p, np.array(ids, "<u4").tobytes()) for p, ids in zip(fresh, self._encode(fresh)))
            coded = [new[p] if c is None else c for p, c in zip(pieces, coded)]
            self._cache.update((p, c) for p, c in new.items() if len(p) <= CACHE_LENGTH)
        return [b"".join(coded[a:b]) for a, b in zip(cuts, cuts[1:])]


def check_byte_level(settings: dict) -> None:
    """Raise unless a ``tokenizers`` file (parsed JSON) is a byte-level BPE that cuts
    texts by ``SPLIT_PATTERN``, changes nothing in them and has plain added tokens."""
    model, pre = settings.get("model") or {}, settings.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or settings.get("normalizer")
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))):
        raise ValueError("only byte-level BPE with the usual split pattern and without normaliser or prefix space is supported")
    if any(t.get(k) for t in settings.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens must match as plain strings")


def ranks_of(settings: dict) -> dict[bytes, int] | None:
    """Bytes to id of a ``tokenizers`` file (parsed JSON) that ranks can express.

    That is a byte-level BPE with the usual split pattern, nothing that
    changes texts, and ids that rise in the order of the merges; None for any
    other file.
    """
    model, pre = settings.get("model") or {}, settings.get("pre_tokenizer") or {}
    plain = (model.get("type", "BPE") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and not settings.get("normalizer")
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")))
    if not plain:
        return None
    # byte-level files show printable bytes as themselves, the others from U+0100 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"] for t in settings.get("added_tokens") or ()}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocab.get(t, -1) for t in merged]
    if (set(vocab) != {*byte, *merged} or any(a >= b for a, b in zip(ids, ids[1:]))
            or ids and ids[0] < max(vocab[c] for c in byte)):
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocab.items()}


class RankEncoder:
    """Ids of whole texts through tiktoken, equal to those of ``exact``.

    A text goes to ``exact`` if it has a character that the two libraries put
    in different classes, or any run of ``LONG_RUN`` characters of one class
    (half as many where they fill a block).
    """

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], pretokenizer: Pretokenizer,
                 exact: CachedEncoder):
        import tiktoken

        self._fast = tiktoken.Encoding("ranks", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._own, self._other = pretokenizer, Pretokenizer(probe_of_tiktoken(SPLIT_PATTERN))
        self._alike = np.zeros(0x110000, np.uint8)  # the class, DIFFERENT, or UNKNOWN until seen
        self._exact = exact

    def _fits(self, text: str) -> bool:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.intp)
        found = self._alike.take(points)
        if not found.all():
            new = np.unique(points[found == UNKNOWN])
            own = self._own.classes(new)
            self._alike[new] = np.where(own == self._other.classes(new), own, DIFFERENT)
            found = self._alike.take(points)
        if (found == DIFFERENT).any():
            return False
        # every longer run covers one of these blocks
        half = LONG_RUN // 2
        blocks = found[:len(found) // half * half].reshape(-1, half)
        return not (blocks.min(axis=1) == blocks.max(axis=1)).any()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        return [self._fast.encode_to_numpy(t, allowed_special="all").astype("<u4", copy=False).tobytes()
                if self._fits(t) else self._exact.encode([t])[0] for t in texts]
