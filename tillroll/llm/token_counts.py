"""Token counts by a finite-state transducer compiled from the vocabulary.

BPE has a local characterisation: a sequence of tokens is the encoding of its
bytes exactly when each neighbouring pair of tokens is the encoding of its
own bytes (Berglund, Martens and van der Merwe, "Constructing a BPE
tokenization DFA", 2024).  So the last token of every prefix follows from the
last tokens at the few earlier positions from which a vocabulary entry may
still be running.  A state is the set of those runs: (node of the vocabulary
trie, last token where the run began, tokens counted there relative to now).
Reading a byte moves every run and adds a new one; the transition is annotated
with the change of the token count.  The subset construction is done on
demand, so only states that texts reach are compiled; a full table is emptied
between blocks.

Texts are read in lockstep: a block of texts is one byte stream cut into
equal chunks, and one numpy step moves all chunks by a byte.  Every chunk has a
map from entry state to exit state.  It is constant once the chunk holds a
start of a pre-token, where the transducer is reset.  The map of a chunk inside
one long pre-token is built over the entry states that occur: first the state
that the chunk before leaves when it is read from the start state, as states
soon forget what they began with.  The maps are composed by a parallel prefix
scan in log2(chunks) steps, which gives the entry of every chunk; a chunk that
is entered in a state its map does not have yet is read from that state too,
all such chunks at once, and the scan is repeated.  At last all chunks are read
once more, together, from their entries, for the counts.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_arrow
from tillroll.llm.byte_bpe import byte_characters
from tillroll.llm.encoding import check_byte_level
from tillroll.llm.pretoken import Pretokenizer, probe_of_tokenizers

START, DEAD = 0, 1
CHUNK = 256
MAX_LANES = 4096
BLOCK_BYTES = 1 << 19
STATES_KEPT = 300_000
PAIRS_KEPT = 500_000

# A run is one number: trie node, last token + 1, relative count + BIAS.
NODE_BIT, TOKEN_BIT, BIAS = 40, 8, 128
TOKEN_MASK = (1 << NODE_BIT) - (1 << TOKEN_BIT)
FIRST_RUN = BIAS


class Vocabulary:
    """Merge ranks and trie of a byte-level BPE tokenizer file."""

    def __init__(self, file: bytes):
        model = json.loads(file)["model"]
        back = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        spelled = {k: b"".join(back[c] for c in k) for k in model["vocab"] if all(c in back for c in k)}
        self.id = {spelled[k]: v for k, v in model["vocab"].items() if k in spelled}
        self.bytes = {v: k for k, v in self.id.items()}
        if max(map(len, self.id), default=0) > BIAS:  # a count lags by no more than the longest entry
            raise ValueError(f"entries of more than {BIAS} bytes are not supported")
        self._merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (spelled[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self._merge.setdefault((self.id[a], self.id[b]), (rank, self.id[a + b]))
        self._fits: dict[tuple[int, int], bool] = {}
        self.kids: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for word, token in self.id.items():
            node = 0
            for b in word:
                child = self.kids[node].get(b)
                if child is None:
                    child = self.kids[node][b] = len(self.kids)
                    self.kids.append({})
                    self.token.append(-1)
                node = child
            self.token[node] = token

    def encode(self, data: bytes) -> list[int]:
        """Plain BPE by merge rank, for short byte strings."""
        ids = [self.id[bytes([b])] for b in data]
        while len(ids) > 1:
            best = min((m, i) for i, pair in enumerate(zip(ids, ids[1:]))
                       for m in [self._merge.get(pair, (1 << 60, -1))])
            (rank, token), i = best
            if token < 0:
                break
            ids[i:i + 2] = [token]
        return ids

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left right`` is the encoding of its bytes (left -1: none)."""
        known = self._fits.get((left, right))
        if known is None:
            both = [right] if left < 0 else [left, right]
            known = self.encode(b"".join(self.bytes[x] for x in both)) == both
            if len(self._fits) > PAIRS_KEPT:
                self._fits.clear()
            self._fits[left, right] = known
        return known


ANY = -1  # the entry of a constant map


def compose(first: dict[int, int], second: dict[int, int]) -> dict[int, int]:
    """The map of two chunks, one after the other, where both are known.

    A map goes from entry states to exit states; one that holds ``ANY`` is
    constant and holds nothing else.
    """
    if ANY in second:
        return second
    return {entry: second[exit] for entry, exit in first.items() if exit in second}


def prefix_maps(maps: list[dict[int, int]]) -> list[dict[int, int]]:
    """The composition of the maps up to each one, in log2(n) parallel steps."""
    out, step = list(maps), 1
    while step < len(out):
        out = out[:step] + [compose(a, b) for a, b in zip(out, out[step:])]
        step *= 2
    return out


class CountingTransducer:
    """Deterministic transducer: bytes in, changes of the token count out."""

    def __init__(self, vocabulary: Vocabulary):
        self._v = vocabulary
        self._reset()

    def _reset(self) -> None:
        self._states = [(FIRST_RUN,), ()]
        self._number = {self._states[START]: START}
        self._column = np.full(256, -1, np.int64)  # of the bytes seen so far
        self._width = 128
        self._next = self._rows(4096)
        self._next[DEAD] = DEAD << 8 | BIAS

    def _rows(self, n: int) -> np.ndarray:
        """An empty table; an entry holds the next state and the change + BIAS."""
        return np.full((n, self._width), -1, np.int32)

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """Table columns of bytes; the table is made for all bytes if many occur."""
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self._column[b] < 0:
                self._column[b] = self._column.max() + 1
        if self._column.max() >= self._width:
            old, self._width = self._next, 256
            self._next = self._rows(len(old))
            self._next[:, :old.shape[1]] = old
            self._next[DEAD] = DEAD << 8 | BIAS
        return self._column[data]

    def _compile(self, state: int, byte: int) -> int:
        """The entry of one new transition."""
        v, moved, found = self._v, [], -1
        kids, tokens, fits = v.kids, v.token, v.fits
        for run in self._states[state]:
            child = kids[run >> NODE_BIT].get(byte)
            if child is None:
                continue
            token = tokens[child]
            if found < 0 and token >= 0 and fits(((run & TOKEN_MASK) >> TOKEN_BIT) - 1, token):
                found, change = token, (run & 255) - BIAS + 1
            if kids[child]:
                moved.append(child << NODE_BIT | run & (1 << NODE_BIT) - 1)
        if found < 0:
            raise ValueError("the vocabulary has no encoding of these bytes")
        key = (*[run - change for run in moved], found + 1 << TOKEN_BIT | BIAS)
        to = self._number.get(key)
        if to is None:
            to = self._number[key] = len(self._states)
            self._states.append(key)
            if to >= len(self._next):
                old = self._next
                self._next = self._rows(len(old) * 3 // 2)
                self._next[:len(old)] = old
        return to << 8 | change + BIAS

    def _step(self, states: np.ndarray, columns: np.ndarray,
              data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = states * self._width + columns
        after = self._next.reshape(-1).take(at)
        if len(after) and after.min() < 0:
            new = after < 0
            for state, byte in set(zip(states[new].tolist(), data[new].tolist())):
                entry = self._compile(state, byte)
                self._next[state, self._column[byte]] = entry
            after = self._next.reshape(-1).take(at)
        return (after >> 8).astype(np.int64), (after & 255) - BIAS

    def changes(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The change of the token count at each byte of a stream.

        ``start`` marks the bytes that start a pre-token; the first byte does.
        """
        if len(self._states) > STATES_KEPT:
            self._reset()
        n = len(data)
        if n == 0:
            return np.zeros(0, np.int8)
        size = max(CHUNK, -(-n // MAX_LANES))
        lanes = -(-n // size)
        rows = np.zeros(lanes * size, np.uint8)
        rows[:n] = data
        rows = np.ascontiguousarray(rows.reshape(lanes, size).T)
        columns = self._columns(rows.reshape(-1)).reshape(rows.shape)
        resets = np.zeros(lanes * size, bool)
        resets[:n] = start
        resets[n:] = True
        resets = np.ascontiguousarray(resets.reshape(lanes, size).T)
        emitted = np.zeros((size, lanes), np.int8)

        # chunks from their first start on: constant maps
        states = np.full(lanes, DEAD, np.int64)
        for t in range(size):
            states[resets[t]] = START
            states, emitted[t] = self._step(states, columns[t], rows[t])
        known = resets.any(axis=0)
        head = np.where(known, resets.argmax(axis=0), size)

        entry = self._entries(rows, columns, states, known)
        now = np.flatnonzero(head > 0)
        carried = entry[now]
        for t in range(int(head.max(initial=0))):
            on = head[now] > t
            if not on.all():
                now, carried = now[on], carried[on]
            carried, emitted[t, now] = self._step(carried, columns[t, now], rows[t, now])
        return emitted.T.ravel()[:n]


    def _entries(self, rows: np.ndarray, columns: np.ndarray, exits: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The entry state of every chunk; chunks that are ``known`` leave in ``exits`` whatever their entry."""
        inside = np.flatnonzero(~known)

        def read(lanes: np.ndarray, states: np.ndarray) -> np.ndarray:
            for t in range(len(rows)):
                states, _ = self._step(states, columns[t, lanes], rows[t, lanes])
            return states

        maps = [{ANY: int(x)} if k else {} for x, k in zip(exits, known)]
        guess = exits.copy()
        if len(inside):
            # a first guess of what the chunk before leaves
            guess[inside] = read(inside, np.full(len(inside), START))
        todo, states = inside, guess[inside - 1]
        while len(todo):
            for lane, before, after in zip(todo.tolist(), states.tolist(), read(todo, states).tolist()):
                maps[lane][before] = after
            leaves = [m.get(ANY) for m in prefix_maps(maps)]
            missing = [(lane, leaves[lane - 1]) for lane in inside.tolist()
                       if leaves[lane - 1] is not None and leaves[lane - 1] not in maps[lane]]
            todo = np.array([lane for lane, _ in missing], np.int64)
            states = np.array([state for _, state in missing], np.int64)
        if len(inside):
            exits = np.array([m[ANY] for m in prefix_maps(maps)], np.int64)
        return np.concatenate([[START], exits[:-1]])


class TokenCounter:
    """Token counts of texts, one per worker; ``file`` is the tokenizer file."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(file)
        check_byte_level(spec)
        self._special = [t["content"] for t in spec["added_tokens"]]
        if len(self._special) > 1:
            raise ValueError("one added token is supported")
        self._pre = Pretokenizer(probe_of_tokenizers(Tokenizer.from_str(file.decode())))
        self._transducer = CountingTransducer(Vocabulary(file))

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        block: list[str] = []
        size = 0
        for text in texts:
            if block and size + len(text) > BLOCK_BYTES:
                out += self._block(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        return out + (self._block(block) if block else [])

    def _block(self, texts: list[str]) -> list[int]:
        parts = [t.split(self._special[0]) for t in texts] if self._special else [[t] for t in texts]
        flat = [p for ps in parts for p in ps]
        joined = "".join(flat)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        bounds = np.cumsum([0, *map(len, flat)])
        first = np.zeros(len(points), bool)
        first[bounds[:-1][bounds[:-1] < len(points)]] = True
        starts = self._pre.starts(points, first)
        data = np.frombuffer(joined.encode(), np.uint8)
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        at_byte = np.zeros(len(data), bool)
        at_byte[leads[starts]] = True
        total = np.concatenate([[0], np.cumsum(self._transducer.changes(data, at_byte), dtype=np.int64)])
        byte_bounds = np.append(leads, len(data))[np.cumsum([0, *(sum(map(len, ps)) for ps in parts)])]
        return [int(n) + len(ps) - 1 for n, ps in zip(np.diff(total[byte_bounds]), parts)]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Tokens of every whole text, counted without encoding it and without a shuffle.

    One row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` as the
    tokenizer library gives them without added special tokens, ``over_limit``
    (n_tokens > ``limit``).  A null text is empty and has no tokens; repeated
    rows give repeated results; an empty table gives none; other columns are
    not read.
    """
    with open(tokenizer_path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, about 1.5 MB
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        counter = TokenCounter(file.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    out = map_arrow(docs.select(docs[id_col], docs[text_col]), run,
                    f"id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
