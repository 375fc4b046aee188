"""WARC archives in Zstandard files, written and read on Spark.

An archive is a leading skippable frame that holds a compression dictionary,
then one Zstandard frame per record.  The dictionary of an archive is trained
from a spread of its own first records; an archive too small for that has none.

Writing: a task's records become chunks of bounded size, and Spark's text sink
writes ``ARCHIVE_CHUNKS`` of them as the rows of one file, so any file system and
Spark's commit protocol apply.  The first chunk of each file begins with the
dictionary, and the others are compressed with it.  The sink's line separator is
an empty skippable frame, which readers of Zstandard ignore.

Reading: files are read whole, so a file may have at most 2 GB (our own have
about 60 MB); the dictionary is loaded from the leading frame, every frame is
decoded on its own, and version line, headers, lengths and digests are
validated.  :func:`read_records` reads any records (WARC/1.0 and 1.1, all types,
any ids), :func:`read_archives` those of :func:`write_archives` as pages.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bound_batches, map_arrow

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.1", b"WARC/1.0")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")

CHUNK_BYTES = 8 << 20  # of payloads, before compression
ARCHIVE_CHUNKS = 32  # in a file: 256 MB of payloads
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20


def record_id(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str):
    value = uri[len("<urn:page:"):-1]
    return None if value == "none" else int(value)


def _clean(value: str) -> str:
    """A header value on one line: anything but visible ASCII becomes %XX."""
    if value.isascii() and value.isprintable() and " " not in value:
        return value
    return "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in value.encode())


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, is_revisit: bool,
                date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP headers only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    block = http if is_revisit else http + payload
    headers = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
               ("WARC-Date", date), ("WARC-Target-URI", _clean(url or "")),
               ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if is_revisit:
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, what: str) -> dict[str, str]:
    """Header lines by name; a folded line belongs to the one before, values of a repeated name are listed."""
    out: dict[str, str] = {}
    name = None
    for line in data.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and name:
            out[name] += " " + line.decode("utf-8", "replace").strip()
            continue
        first, colon, value = line.partition(b":")
        if not colon or not first.strip():
            raise ValueError(f"{what}: malformed header line")
        name, text = first.decode("utf-8", "replace").strip(), value.decode("utf-8", "replace").strip()
        out[name] = f"{out[name]}, {text}" if name in out else text
    return out


def _check_digest(told: str | None, data: bytes, what: str) -> None:
    """Compare a ``sha1:`` digest, base32 or hex; other algorithms are not checked."""
    algorithm, _, value = (told or "").partition(":")
    if algorithm.lower() != "sha1" or not value:
        return
    found = hashlib.sha1(data)
    if value.upper().rstrip("=") != base64.b32encode(found.digest()).decode() and value.lower() != found.hexdigest():
        raise ValueError(f"{what} digest does not match")


def parse_any(data: bytes) -> dict:
    """Validate a record of any type and take it apart; raises ValueError.

    ``headers`` are the WARC headers, their names as written; ``status`` and
    ``http_headers`` are those of an HTTP message (else null), ``payload`` is
    the message's body, or the whole block where there is no HTTP message.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version not in VERSIONS or not gap:
        raise ValueError("record does not begin with a WARC/1.0 or WARC/1.1 header")
    headers = _headers(lines, "WARC header")
    field = {k.lower(): v for k, v in headers.items()}
    if missing := [h for h in NEEDED if h.lower() not in field]:
        raise ValueError(f"missing headers: {', '.join(missing)}")
    if not field["content-length"].isdigit() or len(rest) != int(field["content-length"]) + 4:
        raise ValueError("Content-Length does not match the record")
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("record does not end with two line breaks")
    block = rest[:-4]
    _check_digest(field.get("warc-block-digest"), block, "block")
    out = {"record_id": field["warc-record-id"], "record_type": field["warc-type"], "date": field["warc-date"],
           "target_uri": field.get("warc-target-uri"), "content_type": field.get("content-type"), "headers": headers,
           "refers_to": field.get("warc-refers-to"), "payload_digest": field.get("warc-payload-digest"),
           "status": None, "http_headers": None, "payload": block}
    if out["record_type"] in ("response", "request", "revisit") and (out["content_type"] or "").startswith("application/http"):
        http_head, gap, out["payload"] = block.partition(b"\r\n\r\n")
        first, _, lines = http_head.partition(b"\r\n")
        words = first.split(b" ")
        if not gap or not (words[0].startswith(b"HTTP/") or words[-1].startswith(b"HTTP/")):
            raise ValueError("block has no HTTP header")
        out["http_headers"] = _headers(lines, "HTTP header") if lines else {}
        if words[0].startswith(b"HTTP/") and len(words) > 1 and words[1].isdigit():
            out["status"] = int(words[1])
    coded = any(k.lower() == "transfer-encoding" for k in out["http_headers"] or ())
    if out["record_type"] in ("response", "resource") and not coded:
        _check_digest(out["payload_digest"], out["payload"], "payload")
    return out


def parse_record(data: bytes) -> dict:
    """Validate one record of :func:`write_archives` and give its page; raises ValueError."""
    r = parse_any(data)
    kind, payload = r["record_type"], r["payload"]
    if kind not in ("response", "revisit") or r["http_headers"] is None:
        raise ValueError(f"unexpected record of type {kind}")
    size = int(r["http_headers"].get("Content-Length", -1))
    if not (r["payload_digest"] or "").startswith("sha1:"):
        raise ValueError("record has no payload digest")
    if kind == "response" and size != len(payload):
        raise ValueError("payload length does not match")
    if kind == "revisit" and (not r["refers_to"] or payload):
        raise ValueError(f"unexpected record of type {kind}")
    return {"page_id": page_of(r["record_id"]), "payload_bytes": size, "payload_digest": r["payload_digest"][5:],
            "record_type": kind, "refers_to": page_of(r["refers_to"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


class Archive:
    """One archive in the making: its dictionary is trained from the first chunk of records."""

    def __init__(self):
        self._compressor = None

    def chunk(self, records: list[bytes]) -> bytes:
        """A frame per record; before the first ones the dictionary in a skippable frame."""
        out = []
        if self._compressor is None:
            dictionary = self._train(records)
            if dictionary:
                raw = dictionary.as_bytes()
                out.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
            self._compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        return b"".join(out + [self._compressor.compress(r) for r in records])

    @staticmethod
    def _train(records: list[bytes]):
        samples, size = [], 0
        for r in records[::max(1, len(records) // 256)]:
            samples.append(r[:64 << 10])
            size += len(samples[-1])
            if size > SAMPLE_BYTES:
                break
        if len(samples) < 16 or size < 8 * DICTIONARY_BYTES:
            return None
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:
            return None  # samples too alike or too small; the archive goes without


def make_archive(records: list[bytes]) -> bytes:
    """One archive of one chunk."""
    return Archive().chunk(records)


def _frame_end(view: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, by its block headers."""
    try:
        pos = at + zstandard.frame_header_size(view[at:at + 18])
        checksum = zstandard.get_frame_parameters(view[at:at + 18]).has_checksum
    except zstandard.ZstdError as e:
        raise ValueError(f"broken frame header: {e}") from e
    last = False
    while not last:
        block = int.from_bytes(view[pos:pos + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        pos += 3 + (1 if kind == 1 else size)
        if pos > len(view):
            raise ValueError("frame is cut short")
    return pos + 4 * checksum


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of one archive, decoded frame by frame; raises ValueError."""
    at, first = 0, True
    view = memoryview(data)
    decoder = zstandard.ZstdDecompressor()
    while at < len(view):
        if at + 8 > len(view):
            raise ValueError("archive ends inside a frame header")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            body = bytes(view[at + 8:at + 8 + size])
            if len(body) != size:
                raise ValueError("skippable frame is cut short")
            if magic == DICTIONARY_MAGIC:
                if not first:
                    raise ValueError("dictionary frame is not the leading frame")
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = decoder.decompress(body)
                decoder = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_FULLDICT))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = _frame_end(view, at)
            one = decoder.decompressobj()
            try:
                record = one.decompress(view[at:end])
            except zstandard.ZstdError as e:
                raise ValueError(f"broken frame: {e}") from e
            if not one.eof or one.unused_data:
                raise ValueError("frame is cut short")
            at = end
            yield record
        else:
            raise ValueError("neither a frame nor a skippable frame")
        first = False


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per page below ``path``.

    Of pages with equal payloads of ``least_bytes`` or more, those with the
    smallest id are responses and the others revisits of it; all smaller ones
    are responses.  A null payload is empty, a null url is ''; a null id comes
    last; repeated rows are all written; other columns are not read.  Payloads are
    equal if their SHA-256 and SHA-1 are, as records that share a SHA-1 can be
    made on purpose.
    """
    text = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].alias("url"), text.alias("html"),
                        F.unhex(F.sha1(text.cast("binary"))).alias("sha"), F.unhex(F.sha2(text, 256)).alias("sha2"))
    firsts = (rows.where(F.octet_length("html") >= least_bytes).groupBy("sha2", "sha")
              .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select(F.col("sha2").alias("same2"), F.col("sha").alias("same1"), "first"))
    same = ((rows["sha2"] == firsts["same2"]) & (rows["sha"] == firsts["same1"])
            & ~rows["id"].eqNullSafe(firsts["first"]))
    marked = rows.join(firsts, same, "left").select(
        "id", "url", "html", "sha", "first", F.col("same1").isNotNull().alias("again"))

    def run(batches):
        records, size, chunks, archive = [], 0, 0, Archive()
        for batch in batches:
            for i, url, html, sha, first, again in zip(*(c.to_pylist() for c in batch.columns)):
                payload = html.encode()
                records.append(make_record(i, url, payload, base64.b32encode(sha).decode(), first, again, date))
                size += len(payload)
                if size >= CHUNK_BYTES:
                    yield row(archive, records)
                    records, size, chunks = [], 0, chunks + 1
                    if chunks % ARCHIVE_CHUNKS == 0:  # the sink begins another file
                        archive = Archive()
        if records:
            yield row(archive, records)

    def row(archive, records):
        return pa.RecordBatch.from_arrays([pa.array([archive.chunk(records)], pa.binary())], ["value"])

    (map_arrow(marked, run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", ARCHIVE_CHUNKS).text(path))


def _read(spark: SparkSession, path: str, pattern: str, parse, kinds: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """``parse(record, file)`` of every record of the files, in rows of ``kinds``; an error names the file."""
    bound_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, _, t in kinds], [k for k, _, _ in kinds])

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    rows = []
                    for record in read_archive(data.as_buffer()):
                        rows.append(parse(record, name))
                        if len(rows) == 200:
                            yield batch_of(rows)
                            rows = []
                except ValueError as e:
                    raise ValueError(f"{name}: {e}") from e
                yield batch_of(rows)

    return map_arrow(files, run, ", ".join(f"{k} {t}" for k, t, _ in kinds))


def read_records(spark: SparkSession, path: str, pattern: str = "*.zst") -> DataFrame:
    """All records of the Zstandard archives below ``path`` whose names match ``pattern``.

    ``file, record_id, record_type, date, target_uri, content_type, refers_to,
    payload_digest, headers`` (map), ``status, http_headers`` (of HTTP messages,
    else null), ``payload``.  Records of WARC/1.0 and 1.1 and of any type; a
    malformed archive or record is an error that names the file.
    """
    text = [(k, "string", pa.string()) for k in ("file", "record_id", "record_type", "date", "target_uri", "content_type",
                                                 "refers_to", "payload_digest")]
    pairs = ("map<string,string>", pa.map_(pa.string(), pa.string()))
    kinds = [*text, ("headers", *pairs), ("status", "int", pa.int32()), ("http_headers", *pairs), ("payload", "binary", pa.binary())]

    def parse(record, name):
        r = parse_any(record)
        return r | {"file": name, "headers": list(r["headers"].items()),
                    "http_headers": None if r["http_headers"] is None else list(r["http_headers"].items())}

    return _read(spark, path, pattern, parse, kinds)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, pattern: str = "part-*") -> DataFrame:
    """The pages of all archives below ``path`` that :func:`write_archives` wrote.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` and,
    with ``with_payload``, ``payload`` (null for revisits).  A malformed
    archive or record is an error that names the file.
    """
    kinds = [("page_id", "bigint", pa.int64()), ("payload_bytes", "bigint", pa.int64()), ("payload_digest", "string", pa.string()),
             ("record_type", "string", pa.string()), ("refers_to", "bigint", pa.int64())]
    kinds += [("payload", "binary", pa.binary())] * with_payload
    return _read(spark, path, pattern, lambda record, _: parse_record(record), kinds)
