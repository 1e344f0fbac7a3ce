"""Zstandard WARC archives: writer and validating reader.

An archive is one value of a ``content`` column beside its ``path`` (the columns of Spark's
``binaryFile`` source, so files on disk are read with ``spark.read.format("binaryFile")``).  It
starts with a skippable frame that holds the Zstandard dictionary, followed by one frame per
WARC record, so every record can be decoded on its own.

Writing: records are compressed with a dictionary trained on a bounded sample of the records of
that archive; an archive is closed when it holds ``archive_bytes`` of raw records (a larger
single record gets an archive of its own), so a task holds one archive at a time whatever the
number of pages.  Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the
smallest id becomes a response and the others revisit it.

Reading: the dictionary is loaded from the leading skippable frame (stored plain or itself
compressed), each frame is decoded separately, and the version line, the mandatory headers, the
content length, the record end, the HTTP head, the payload length and the payload digest are
checked.  A bad record is reported in ``error`` (the rest of the archive is still read if the
frame itself could be decoded); ``strict=True`` fails instead.

Defined cases: a null payload is the empty payload; a null url gives a record without target
URI; null ids give a record without ``X-Page-Id`` and never count as the smallest id; equal rows
(same id, same payload) are all responses if their id is the smallest; an empty table gives no
archive; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_SCHEMA = "path string, content binary"
RECORD_SCHEMA = ("path string, record_id string, record_type string, target_uri string, page_id long, "
                 "payload_bytes long, payload_digest string, refers_to long, payload binary, error string")


# ---------------------------------------------------------------- which record is a revisit

def with_record_types(pages: DataFrame, id_col: str, payload_col: str, uri_col: str,
                      min_bytes: int = 100) -> DataFrame:
    """Rows (page_id, uri, payload, digest, refers_to); refers_to is null for responses.

    Only ids and digests are shuffled by digest (pre-aggregated, so copies cost one row per
    task); payloads are joined by id, which is not skewed.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(uri_col).cast("string").alias("uri"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    slim = rows.filter(F.octet_length("payload") >= min_bytes).select(
        "page_id", F.sha2("payload", 256).alias("digest"))
    firsts = (slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
              .filter(F.col("first") < F.col("last")).select("digest", "first"))
    revisits = (slim.join(firsts, "digest").filter(F.col("page_id") > F.col("first"))
                .select("page_id", "digest", F.col("first").alias("refers_to")).distinct())
    return (rows.withColumn("digest", F.sha2("payload", 256))
            .join(revisits, ["page_id", "digest"], "left")
            .select("page_id", "uri", "payload", "digest", "refers_to"))


# ---------------------------------------------------------------- writer

def _clean(value: str) -> str:
    """Header values stay on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(f'{page_id}:{digest}'.encode()).hexdigest()[:32])}>"


def build_record(page_id, uri, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode()
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int, samples: int = 256, sample_bytes: int = 4096):
    """A dictionary from evenly spread records, or None if they are too few to train one."""
    step = max(1, len(records) // samples)
    part = [r[:sample_bytes] for r in records[::step]]
    if len(part) < 8 or sum(map(len, part)) < 8 * size:
        return None
    try:
        return zstandard.train_dictionary(size, part, k=200, d=6)
    except zstandard.ZstdError:
        return None


def build_archive(records: list[bytes], dictionary_bytes: int = 16384, level: int = 3) -> bytes:
    trained = train_dictionary(records, dictionary_bytes)
    out = []
    if trained is not None:
        packed = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
        out += [DICTIONARY_FRAME.to_bytes(4, "little"), len(packed).to_bytes(4, "little"), packed]
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
    out += [packer.compress(r) for r in records]
    return b"".join(out)


def archives(typed: DataFrame, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 8 << 20) -> DataFrame:
    """Archives (path, content) of the rows of :func:`with_record_types`."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def closed():
            return pa.RecordBatch.from_pydict({"path": [f"pages-{task:06d}-{n:06d}.warc.zst"],
                                               "content": pa.array([build_archive(held)], pa.binary())})
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "uri", "payload", "digest", "refers_to"))):
                held.append(build_record(*(v.as_py() for v in row), date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield closed()
                    n, held, size = n + 1, [], 0
        if held:
            yield closed()

    return typed.mapInArrow(write, ARCHIVE_SCHEMA)


# ---------------------------------------------------------------- reader

def split_dictionary(content: bytes) -> tuple[bytes | None, int]:
    """The dictionary of the leading skippable frame and where the records begin."""
    if len(content) >= 8 and int.from_bytes(content[:4], "little") == DICTIONARY_FRAME:
        end = 8 + int.from_bytes(content[4:8], "little")
        if end > len(content):
            raise ValueError("dictionary frame is longer than the archive")
        data = content[8:end]
        if data[:4] == ZSTD_MAGIC:
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        return data, end
    return None, 0


def frames(content: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """Every frame's content; skippable frames between records are passed over."""
    dictionary, at = split_dictionary(content)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    unpacker = zstandard.ZstdDecompressor(dict_data=data)
    while at < len(content):
        if len(content) - at >= 8 and 0x184D2A50 <= int.from_bytes(content[at:at + 4], "little") <= 0x184D2A5F:
            at += 8 + int.from_bytes(content[at + 4:at + 8], "little")
            continue
        frame, out = unpacker.decompressobj(), []
        while not frame.eof:
            if at >= len(content):
                raise ValueError("archive ends inside a frame")
            piece = content[at:at + step]
            out.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(out)


def _headers(lines: list[str]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line!r}")
        if name.lower() in found:
            raise ValueError(f"header {name} is repeated")
        found[name.lower()] = value.strip()
    return found


def _whole_number(text: str | None, what: str) -> int:
    if text is None or not re.fullmatch(r"[0-9]+", text):
        raise ValueError(f"{what} is not a whole number: {text!r}")
    return int(text)


def parse_record(raw: bytes) -> dict:
    """Fields of one record; ValueError says what is wrong with it."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("record has no end of headers")
    first, *lines = raw[:end].decode("utf-8").split("\r\n")
    if first not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"bad version line {first!r}")
    head = _headers(lines)
    for name in MANDATORY:
        if name not in head:
            raise ValueError(f"header {name} is missing")
    length = _whole_number(head["content-length"], "content-length")
    block = raw[end + 4:end + 4 + length]
    if len(block) != length or raw[end + 4 + length:] != b"\r\n\r\n":
        raise ValueError("content-length does not match the record")
    kind = head["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected record type {kind!r}")
    cut = block.find(b"\r\n\r\n")
    if cut < 0 or not block.startswith(b"HTTP/"):
        raise ValueError("block is not an HTTP message")
    http = _headers(block[:cut].decode("utf-8").split("\r\n")[1:])
    payload, stated = block[cut + 4:], _whole_number(http.get("content-length"), "HTTP content-length")
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if not re.fullmatch(r"[0-9a-f]{64}", digest):
        raise ValueError("payload digest is missing or not SHA-256")
    if _whole_number(head.get("x-payload-length", http.get("content-length")), "payload length") != stated:
        raise ValueError("payload lengths disagree")
    if kind == "response":
        if len(payload) != stated:
            raise ValueError("payload is not as long as stated")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload does not match its digest")
    elif payload or "warc-refers-to" not in head or "warc-profile" not in head:
        raise ValueError("revisit has a payload, no profile or nothing to refer to")
    number = lambda name: int(head[name]) if name in head else None
    return {"record_id": head["warc-record-id"], "record_type": kind, "target_uri": head.get("warc-target-uri"),
            "page_id": number("x-page-id"), "payload_bytes": stated, "payload_digest": digest,
            "refers_to": number("x-refers-to-page-id") if kind == "revisit" else None,
            "payload": payload if kind == "response" else None, "error": None}


def read_archives(files: DataFrame, with_payload: bool = True, strict: bool = True) -> DataFrame:
    """One row per record of the archives in files (path, content); see RECORD_SCHEMA."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in RECORD_SCHEMA.split(", ")])

    def records(path, content):
        try:
            for raw in frames(content):
                try:
                    row = parse_record(raw)
                except (ValueError, UnicodeDecodeError) as e:
                    if strict:
                        raise ValueError(f"{path}: {e}") from e
                    row = {"error": str(e)}
                if not with_payload:
                    row["payload"] = None
                yield {"path": path} | row
        except (ValueError, zstandard.ZstdError) as e:
            if strict:
                raise ValueError(f"{path}: {e}") from e
            yield {"path": path, "error": str(e)}

    def parse(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for row in records(path.as_py(), content.as_py()):
                    held.append({n: row.get(n) for n in names})
                    size += len(row.get("payload") or b"") + 500
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.select("path", "content").mapInArrow(parse, RECORD_SCHEMA)
