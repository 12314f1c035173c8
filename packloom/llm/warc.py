"""WARC archives: a writer with revisit records, and a salvage reader that recovers what damaged archives still hold.

Archives are ``.warc.gz`` files of one gzip member a record (``gzip=False``: plain ``.warc``). A task writes
to files named by itself and only the manifest rows of finished tasks name the archives, so that repeated
or lost tasks leave nothing that is read twice. The reader takes any writer's archives and checks what WARC requires of a record (gzip checksum and
length, version line, header syntax, Content-Length, closing CRLFs), and its digests where they can be read. A gzip member may hold many records; they
are read as a stream, and of a member that breaks off all but the last one before the break stay. Where a check fails, it searches for the next gzip member
whose content begins with a version line, or for the next version line of a plain archive, that passes the same
checks; the bytes between are logged as one quarantined gap, and reading goes on.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm._store import cut, make_dir, open_read, open_write

MIN_SHARED_BYTES = 1000
ROLL_BYTES = 64 << 20
BLOCK = 1 << 20
STEP = 1 << 16
_GZIP = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/[01]\.\d+\r\n")

RECORD_SCHEMA = (
    "archive string, start long, end long, kind string, reason string, record_type string, record_id long, "
    "target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary, record_uri string"
)


def record_uri(page_id: int | None) -> str:
    """A version 8 UUID that carries the 64 bits of ``page_id``; the nil UUID for null."""
    if page_id is None:
        return f"<urn:uuid:{uuid.UUID(int=0)}>"
    bits = page_id & (2**64 - 1)
    value = (bits >> 32) << 96 | 8 << 76 | 2 << 62 | (bits & 0xFFFFFFFF)
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(uri: str | None) -> int | None:
    try:
        value = uuid.UUID((uri or "").strip("<>").removeprefix("urn:uuid:")).int
    except ValueError:
        return None
    if not value:
        return None
    bits = (value >> 96) << 32 | (value & 0xFFFFFFFF)
    if value != (bits >> 32) << 96 | 8 << 76 | 2 << 62 | (bits & 0xFFFFFFFF):
        return None  # another writer's
    return bits - 2**64 if bits >= 2**63 else bits


def encode_record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record: a response with its payload, or (with ``refers_to``) a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_uri(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_uri(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Short(ValueError):
    """The data end within a record that needs ``need`` bytes at least."""

    def __init__(self, why: str, need: int):
        super().__init__(why)
        self.need = need


def read_digest(value: str | None) -> tuple[str, bytes] | None:
    """Algorithm and bytes of a labelled digest in base32 or hex; None if it isn't one."""
    name, _, text = (value or "").partition(":")
    name, text = name.strip().lower().replace("-", ""), text.strip()
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return None
    size = hashlib.new(name).digest_size
    try:
        raw = bytes.fromhex(text) if len(text) == 2 * size else base64.b32decode(text.rstrip("=").upper() + "=" * (-len(text.rstrip("=")) % 8))
    except ValueError:
        return None
    return (name, raw) if len(raw) == size else None


def _matches(digest: tuple[str, bytes], data: bytes) -> bool:
    return hashlib.new(digest[0], data).digest() == digest[1]


def _dechunked(data: bytes) -> bytes:
    """The body that chunks carry; what isn't chunked ends it."""
    out, at = [], 0
    while m := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(data, at):
        size = int(m[1], 16)
        if not size:
            break
        out.append(data[m.end() : m.end() + size])
        at = m.end() + size + 2
    return b"".join(out)


def parse_record(data: bytes | bytearray, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` and where it ends; ValueError names the check that failed."""
    m = _VERSION.match(bytes(data[at : at + 16]))
    if not m:
        raise _Short("no version line", 16) if len(data) - at < 16 else ValueError("no version line")
    first = at + m.end()
    stop = data.find(b"\r\n\r\n", first)
    last = stop if stop >= 0 else max(first, data.rfind(b"\r\n", first))
    fields, name = {}, ""
    for line in bytes(data[first:last]).split(b"\r\n") if last > first else []:
        if name and line[:1] in (b" ", b"\t"):  # a folded line
            fields[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without colon")
        name = key.strip().lower().decode("latin-1")
        fields[name] = value.strip().decode("utf-8", "replace")
    if stop < 0:
        raise _Short("no end of header", 2 * (len(data) - at))
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise ValueError("no content length")
    begin, end = stop + 4, stop + 4 + int(size)
    if len(data) < end + 4:
        raise _Short("record doesn't end where its length says", end + 4 - at)
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record doesn't end where its length says")
    block = bytes(data[begin:end])
    revisit = fields.get("warc-type") == "revisit"
    head, payload = b"", block
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
    digest, whole = read_digest(fields.get("warc-payload-digest")), read_digest(fields.get("warc-block-digest"))
    if whole and not _matches(whole, block):
        raise ValueError("block doesn't match its digest")
    partial = "warc-truncated" in fields or "warc-segment-number" in fields  # the digest is of more than this record
    if digest and not revisit and not partial and not _matches(digest, payload):
        if not re.search(rb"(?im)^transfer-encoding:.*chunked", head) or not _matches(digest, _dechunked(payload)):
            raise ValueError("payload doesn't match its digest")
    return {
        "record_type": fields.get("warc-type"),
        "record_id": page_of(fields.get("warc-record-id")),
        "record_uri": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "payload_bytes": len(payload) if not revisit else int(length[1]) if length else None,
        "payload_digest": digest and ("" if digest[0] == "sha1" else digest[0] + ":") + digest[1].hex(),
        "refers_to": page_of(fields.get("warc-refers-to")) if revisit else None,
        "payload": None if revisit else payload,
    }, end + 4


class _Window:
    """A file seen through a buffer that is dropped behind the reader: memory is bounded by one record."""

    def __init__(self, file, begin: int = 0):
        self.file, self.base, self.data, self.over = file, begin, b"", False
        file.seek(begin)

    def fill(self, upto: int) -> None:
        while not self.over and self.base + len(self.data) < upto:
            more = self.file.read(max(BLOCK, upto - self.base - len(self.data)))
            self.over = not more
            self.data += more

    def peek(self, at: int, n: int) -> bytes:
        """``n`` bytes at ``at``, without holding those before."""
        here = self.base + len(self.data)
        if at + n <= here or self.over:
            return self.data[at - self.base : at - self.base + n]
        try:
            self.file.seek(at)
            return self.file.read(n)
        except (OSError, ValueError, OverflowError):
            return b""  # beyond the file
        finally:
            self.file.seek(here)

    def drop(self, to: int) -> None:
        self.data, self.base = self.data[to - self.base :], to

    def ends(self, at: int) -> bool:
        self.fill(at + 1)
        return at >= self.base + len(self.data)


def _member(w: _Window, at: int) -> Iterator[tuple[dict, int]]:
    """The records of the gzip member at ``at``, each with a place up to which the file is read; the last one's is the member's end.

    A record is given when the next one is whole or the member has ended and passed its check, so that the only record of a damaged member never is.
    """
    d, data, pos, held, need = zlib.decompressobj(31), bytearray(), at, None, 1
    while not d.eof:
        w.fill(pos + STEP)
        chunk = w.data[pos - w.base : pos - w.base + STEP]
        if not chunk:
            raise ValueError("member is cut off")
        before, broken = d.copy() if pos > at else zlib.decompressobj(31), None
        try:
            data += d.decompress(chunk)
        except zlib.error as e:
            broken = ValueError(f"gzip check failed: {str(e)[:60]}")
            with contextlib.suppress(zlib.error):  # what inflates before the break
                for i in range(len(chunk)):
                    data += before.decompress(chunk[i : i + 1])
        began, pos = pos, pos + len(chunk) - len(d.unused_data)
        while data and (d.eof or len(data) >= need):
            try:
                record, used = parse_record(data)
            except _Short as e:
                if d.eof:
                    raise
                need = e.need
                break
            if held is not None:
                yield held, began
            held, need = record, 1
            del data[:used]
        if broken:
            raise broken
    if held is None:
        raise ValueError("member holds no record")
    yield held, pos


def _plain_header(w: _Window, at: int) -> tuple[int, int]:
    """Where the block of the record at ``at`` begins, and its length. The search goes on as long as each line looks like a header's."""
    step = 1 << 16
    w.fill(at + step)
    m = _VERSION.match(w.data, at - w.base)
    if not m:
        raise ValueError("no version line")
    done = m.end() + w.base
    while True:
        stop = w.data.find(b"\r\n\r\n", done - w.base)
        last = stop if stop >= 0 else w.data.rfind(b"\r\n", done - w.base)
        if last >= 0:
            lines = w.data[done - w.base : last].split(b"\r\n")
            if any(b":" not in x for x in lines if x and x[:1] not in b" \t"):
                raise ValueError("header line without colon")
            if stop >= 0:
                break
            done = last + w.base
        if w.over:
            raise ValueError("no end of header")
        step *= 2
        w.fill(w.base + len(w.data) + step)
    m = re.search(rb"(?im)^content-length[ \t]*:[ \t]*(\d{1,18})[ \t]*\r$", w.data[at - w.base : stop + 2])
    if not m:
        raise ValueError("no content length")
    return stop + 4 + w.base, int(m[1])


def _records(w: _Window, at: int, gz: bool) -> Iterator[tuple[dict, int]]:
    if gz:
        yield from _member(w, at)
        return
    begin, size = _plain_header(w, at)
    if w.peek(begin + size, 4) != b"\r\n\r\n":  # before the bytes are held: a damaged length may name any number
        raise ValueError("record doesn't end where its length says")
    w.fill(begin + size + 4)
    record, end = parse_record(w.data[at - w.base : begin + size + 4 - w.base])
    yield record, at + end


def _next_start(w: _Window, at: int, gz: bool) -> int:
    """The first place from ``at`` on that may begin a record; the end of the file if there is none."""
    while True:
        if w.ends(at):
            return w.base + len(w.data)
        w.fill(at + BLOCK)
        if gz:
            i = w.data.find(_GZIP, at - w.base)
        else:
            m = _VERSION.search(w.data, at - w.base)
            i = m.start() if m else -1
        if i >= 0:
            return w.base + i
        at = max(at, w.base + len(w.data) - 16) if not w.over else w.base + len(w.data)
        w.drop(min(at, w.base + len(w.data)))
        if w.over:
            return w.base + len(w.data)
        w.fill(w.base + len(w.data) + BLOCK)


def salvage(file, name: str) -> Iterator[dict]:
    """All sound records of an archive in order (kind ``record``), and the bytes between them (kind ``gap``) with the check that failed."""
    first = file.read(4)
    gz = not re.match(rb"WARC", first) and not name.endswith(".warc")
    w, at, gap, why = _Window(file), 0, None, None
    while not w.ends(at):
        try:
            for record, end in _records(w, at, gz):
                if gap is not None:
                    yield {"archive": name, "start": gap, "end": at, "kind": "gap", "reason": why}
                    gap = None
                yield {"archive": name, "start": at, "end": end, "kind": "record", **record}
                at = end
                w.drop(at)
        except ValueError as e:
            if gap is None:
                gap, why = at, str(e)
            at = _next_start(w, at + 1, gz)
    if gap is not None:
        yield {"archive": name, "start": gap, "end": at, "kind": "gap", "reason": why}


def with_revisits(pages: DataFrame, min_bytes: int = MIN_SHARED_BYTES) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): of equal payloads of at least ``min_bytes``, all but the largest page_id refer to that.

    Null html is an empty payload. A null page_id never is referred to; rows that share the largest page_id are all responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    big = F.length("payload") >= min_bytes
    shared = rows.where(big).groupBy("sha1").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first_id IS NOT NULL")
    shared = cut(shared.select("sha1", "first_id"))  # a table of its own: a join with it can be split where a digest is hot
    refers = F.when(big & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(shared, "sha1", "left").select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def write_archives(records: DataFrame, folder: str, gzip: bool = True, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write rows of ``with_revisits`` below ``folder``, a folder that executors and driver share; return the manifest (archive, bytes, records)."""
    make_dir(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, size, n, done = "", None, 0, 0, []
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to")]
            for i in range(batch.num_rows):
                page, url, payload, sha1, refers = (c[i].as_py() for c in cols)
                data = encode_record(page, url, payload, sha1, refers)
                if gzip:
                    z = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = z.compress(data) + z.flush()
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc" + ".gz" * gzip
                    out, size, n = open_write(name), 0, 0
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    out.close()
                    done.append((name, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["archive", "bytes", "records"])

    return cut(records.mapInArrow(write, "archive string, bytes long, records long"))


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives named in the column ``archive``; a task reads whole archives as streams.

    Kind ``record`` has the record's fields; kind ``gap`` the quarantined bytes [start, end) and the reason. An empty archive gives no rows.
    """
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    if not with_payload:
        names.remove("payload")
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in RECORD_SCHEMA.split(", ") if x.split()[0] in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, size = [], 0
                with open_read(name) as file:
                    for r in salvage(file, name):
                        size += len(r.get("payload") or b"") if with_payload else 64
                        rows.append({k: r.get(k) for k in names})
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = max(1, archives.count())
    dealt = archives.select("archive").repartition(min(n, 10_000))
    return dealt.mapInArrow(read, ", ".join(x for x in RECORD_SCHEMA.split(", ") if x.split()[0] in names))
