"""Byte-level BPE encoding and decoding through a sentencepiece model.

A rank file (one base64 byte string and its rank per line) is serialised
directly as a sentencepiece BPE model: every byte is mapped to a character of
its own, a piece is the mapped byte string, its score is the negative rank,
and normalisation is the identity.  sentencepiece then merges the pair whose
result has the highest score, leftmost first, which is the merge of lowest
rank.  Texts are cut into pre-tokens, each is encoded separately; a pre-token
that is itself a piece is that piece.  Decoding maps ids back to bytes.

Nothing is trained; the model is a re-encoding of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_arrow
from tillroll.llm.encoding import CachedEncoder
from tillroll.llm.pretoken import SPLIT_PATTERN, Pretokenizer, probe_of_tiktoken

# Spellings of the one pattern by which texts are cut.
PATTERNS = (SPLIT_PATTERN, r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")

BPE_MODEL, NORMAL_PIECE, UNKNOWN_PIECE = 2, 1, 2  # fixed values of the model format


def byte_characters() -> list[str]:
    """The character of each byte: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file as byte string -> rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _sized(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary; piece ids are the ranks.

    Raises ValueError unless the ranks are 0, 1, 2 ... and hold every byte.
    """
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[x] for x in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2 ... without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must have a rank")
    chars = byte_characters()
    out = []
    for rank, piece in enumerate(by_rank):
        out.append(_sized(1, _sized(1, "".join(chars[b] for b in piece).encode())
                          + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, NORMAL_PIECE)))
    out.append(_sized(1, _sized(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, UNKNOWN_PIECE)))
    trainer = _number(3, BPE_MODEL) + _number(4, len(out)) + _number(40, len(out) - 1)
    normalizer = _sized(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _sized(2, trainer) + _sized(3, normalizer)


class ByteBpe:
    """Encoder and decoder over one serialised model (one per worker)."""

    def __init__(self, model: bytes, pattern: str):
        import sentencepiece

        if pattern not in PATTERNS:
            raise ValueError(f"texts can only be cut by {SPLIT_PATTERN!r}, not by {pattern!r}")
        self._sp = sentencepiece.SentencePieceProcessor()
        self._sp.LoadFromSerializedProto(model)
        chars = byte_characters()
        self._map = {b: ord(c) for b, c in enumerate(chars)}
        back = {c: b for b, c in enumerate(chars)}
        unknown = self._sp.unk_id()
        self._bytes = [bytes(back[c] for c in self._sp.id_to_piece(i))
                       for i in range(self._sp.get_piece_size()) if i != unknown]
        self._whole = {piece: [i] for i, piece in enumerate(self._bytes)}
        self._texts = CachedEncoder(Pretokenizer(probe_of_tiktoken(pattern)), self._pretokens)

    def _pretokens(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in pieces]
        out = [self._whole.get(b) for b in raw]
        rest = [i for i, ids in enumerate(out) if ids is None]
        mapped = [raw[i].decode("latin-1").translate(self._map) for i in rest]
        for i, ids in zip(rest, self._sp.encode(mapped, num_threads=1) if mapped else []):
            out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self._texts.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode it again, without a shuffle.

    One row per input row: the id, ``n_tokens``, ``ids`` (binary, left out with
    ``keep_ids=False``), ``ids_sha256`` and ``decoded_sha256``.  A null text is
    empty; repeated rows give repeated results; an empty table gives none;
    other input columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(ranks_path)))  # a vocabulary, about 1 MB
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        bpe = ByteBpe(model.value, pattern)
        for batch in batches:
            ids = bpe.encode([t or "" for t in batch.column(1).to_pylist()])
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if keep_ids:
                columns.append(pa.array(ids, pa.binary()))
            columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()))
            columns.append(pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(
                columns, ["id", "n_tokens", *["ids"] * keep_ids, "ids_sha256", "decoded_sha256"])

    out = map_arrow(docs.select(docs[id_col], docs[text_col]), run,
                    f"id {id_type}, n_tokens bigint, {'ids binary, ' * keep_ids}"
                    "ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
