"""WARC archives on shared storage, with a reader that salvages damaged ones.

Every record is a gzip member of its own (plain archives are read as well). The reader
checks each record of any type: the member's checksum, version line, length and the digests it has. After a
failed check it searches for the next offset at which a whole valid record begins - a gzip
member or a version line -, logs the bytes between as quarantined and goes on, so damage
costs only the records it hits.

Pages with equal payloads (SHA-1, length and a 64-bit hash agree) are stored once: the page with the largest id
is the response, the others are revisit records that name it. A manifest table lists the
archives that tasks committed; files of failed attempts are not in it.

Defined cases: a null html is an empty payload; a null url is written empty; pages without
an id are records without one, and revisit the largest id of their payload if there is
one; rows with equal id and payload are responses alike; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder, stored
from tidemark.operators.skew import attach

ARCHIVE_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_CHUNK = 1 << 16


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}') if page_id is not None else uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = DATE) -> bytes:
    """One WARC record, uncompressed; with ``refers_to`` a revisit record without payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


class Damaged(ValueError):
    """The bytes at an offset are not one whole valid record."""


#: Fields that a record has once; a second one is the head of the next record after a cut.
ONCE = set(
    "warc-record-id content-length warc-date warc-type content-type warc-block-digest warc-payload-digest warc-ip-address "
    "warc-refers-to warc-target-uri warc-truncated warc-warcinfo-id warc-filename warc-profile warc-identified-payload-type "
    "warc-segment-number warc-segment-origin-id warc-segment-total-length x-payload-length x-page-id x-refers-to-page-id".split()
)
_HASHES = {"sha1", "sha256", "sha512", "md5"}


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Fields by lower-case name; of a repeated one the first, continued lines joined."""
    out: dict[str, str] = {}
    name = ""
    for line in lines:
        text = line.decode()
        if text[:1] in (" ", "\t") and name:
            out[name] += " " + text.strip()
            continue
        name, mark, value = text.partition(":")
        name = name.strip().lower()
        if not mark or not name or (name in ONCE and name in out):
            raise Damaged("headers")
        out.setdefault(name, value.strip())
    return out


def _agrees(stated: str | None, content: bytes) -> bool | None:
    """Whether content has a stated digest (base 32 or hex); none if it is absent or of another kind."""
    kind, mark, value = (stated or "").partition(":")
    if not mark or kind.lower() not in _HASHES:
        return None
    raw = hashlib.new(kind.lower(), content).digest()
    return value.lower().rstrip("=") in (raw.hex(), base64.b32encode(raw).decode().lower().rstrip("="))


def _joined_chunks(body: bytes) -> bytes:
    """Body of a chunked transfer; what is not chunked is left."""
    out, at = [], 0
    while at < len(body):
        size, mark, _ = body[at : at + 64].partition(b"\r\n")
        try:
            n = int(size.split(b";")[0], 16)
        except ValueError:
            return body
        at += len(size) + len(mark)
        if not n:
            break
        out.append(body[at : at + n])
        at += n + 2
    return b"".join(out)


def parse(content: bytes) -> dict:
    """Headers and payload of one whole record; raises ``Damaged`` if any check fails.

    Digests are checked where the record has them. The payload of HTTP messages is their body,
    that of other records the block; a revisit record has none, so its length may be unknown.
    """
    head, mark, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/1."):
        raise Damaged("no version line")
    try:
        fields = _fields(lines[1:])
        length = int(fields["content-length"])
        kind = fields["warc-type"].lower()
        known = {k: int(fields[h]) if h in fields else None for k, h in (("page_id", "x-page-id"), ("refers_to", "x-refers-to-page-id"))}
        stated = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
    except (KeyError, ValueError) as e:
        raise Damaged("headers") from e
    block = rest[:length]
    if length < 0 or len(block) != length or rest[length:] != b"\r\n\r\n":
        raise Damaged("length")
    whole = _agrees(fields.get("warc-block-digest"), block)
    if whole is False:
        raise Damaged("block digest")
    given = fields.get("warc-payload-digest")
    out = {"type": kind, "digest": given.removeprefix("sha1:") if given else None, "bytes": stated, **known}
    if kind == "revisit":
        return out
    http = fields.get("content-type", "").lower().startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    part = "warc-segment-number" in fields or "warc-truncated" in fields  # the digest may be that of the whole
    # some crawlers state the digest of the joined chunks; a good block digest covers the payload as well
    if whole is None and not part and _agrees(given, payload) is False and _agrees(given, _joined_chunks(payload)) is False:
        raise Damaged("payload digest")
    if stated is not None and stated != len(payload):
        raise Damaged("payload length")
    return out | {"bytes": len(payload), "digest": out["digest"] or digest(payload), "payload": payload}


def _read_at(f, at: int, n: int) -> bytes:
    f.seek(at)
    return f.read(n)


def _gzip_record(f, at: int) -> tuple[dict, int]:
    unpacker, out, pos = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            chunk = _read_at(f, pos, _CHUNK)
            if not chunk:
                raise Damaged("cut off")
            pos += len(chunk)
            out.append(unpacker.decompress(chunk))
            if len(out) == 1 and not b"WARC/1.".startswith(out[0][:7]):
                raise Damaged("no version line")
    except zlib.error as e:
        raise Damaged("member") from e
    return parse(b"".join(out)), pos - len(unpacker.unused_data)


def _plain_record(f, at: int) -> tuple[dict, int]:
    head, pos = b"", at
    while b"\r\n\r\n" not in head:
        chunk = _read_at(f, pos, _CHUNK)
        if not chunk or len(head) > 1 << 20:
            raise Damaged("cut off")
        head, pos = head + chunk, pos + len(chunk)
    top, _, _ = head.partition(b"\r\n\r\n")
    length = next((x[15:].strip() for x in top.split(b"\r\n") if x.lower().startswith(b"content-length:")), b"")
    if not length.isdigit():
        raise Damaged("headers")
    total = len(top) + 4 + int(length) + 4
    return parse(_read_at(f, at, total)), at + total


def _record_at(f, at: int) -> tuple[dict, int]:
    start = _read_at(f, at, 7)
    if start[:3] == b"\x1f\x8b\x08":
        return _gzip_record(f, at)
    if start == b"WARC/1.":
        return _plain_record(f, at)
    raise Damaged("no member or version line")


def _next_valid(f, at: int, size: int) -> int:
    """First offset from ``at`` on where a whole valid record begins, or the size."""
    pos = at
    while pos < size:
        window = _read_at(f, pos, _CHUNK + 7)
        seek = 0
        while True:
            hits = [i for i in (window.find(b"\x1f\x8b\x08", seek), window.find(b"WARC/1.", seek)) if i >= 0]
            if not hits or min(hits) >= _CHUNK:
                break
            try:
                _record_at(f, pos + min(hits))
                return pos + min(hits)
            except Damaged:
                seek = min(hits) + 1
        pos += _CHUNK
    return size


def salvage(f, size: int) -> Iterator[tuple[int, int, dict | str]]:
    """(offset, length, record) of all valid records, and (offset, length, reason) of the gaps between."""
    at = 0
    while at < size:
        try:
            found, end = _record_at(f, at)
        except Damaged as e:
            found, end = str(e), _next_valid(f, at + 1, size)
        yield at, end - at, found
        at = end


MANIFEST = "path string, n_records bigint, n_bytes bigint"


def _writer(folder: str):
    def run(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        out = None
        done = []

        def close():
            out.close()
            done.append((f"{folder}/{name}", count, size))

        for batch in batches:
            for page_id, url, html, target in zip(*(batch.column(c) for c in ("page_id", "url", "html", "target")), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                packed = member(record(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), target.as_py()))
                out.write(packed)
                count, size = count + 1, size + len(packed)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        columns = list(zip(*done, strict=True)) if done else [[], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        names = ["path", "n_records", "n_bytes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) below ``folder``; returns the manifest.

    Equal payloads of at least ``least_bytes`` are stored once.
    """
    rows = pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
    same = {"sha": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html"), "also": F.xxhash64("html")}
    keys = list(same)
    rows = rows.withColumns(same)
    largest = rows.groupBy(*keys).agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    largest = largest.where((F.col("n") > 1) & (F.col("bytes") >= least_bytes)).drop("n")
    rows = attach(rows, largest, keys)
    target = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    rows = rows.select("page_id", "url", "html", target.alias("target"))
    return stored(rows.mapInArrow(_writer(folder), MANIFEST), "warc-manifest")


RECORDS = (
    "path string, offset bigint, length bigint, page_id bigint, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, gap string"
)


def _reader(batches):
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [{"string": pa.string(), "bigint": pa.int64()}[c.split()[1]] for c in RECORDS.split(", ")]

    def pack(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, root = pafs.FileSystem.from_uri(path)
            rows = []
            with fs.open_input_file(root) as f:
                for at, n, found in salvage(f, f.size()):
                    if isinstance(found, str):
                        rows.append((path, at, n, None, None, None, None, None, found))
                    else:
                        values = (found[k] for k in ("page_id", "bytes", "digest", "type", "refers_to"))
                        rows.append((path, at, n, *values, None))
                    if len(rows) == 4096:
                        yield pack(rows)
                        rows = []
            if rows:
                yield pack(rows)


def read(manifest: DataFrame) -> DataFrame:
    """Records of the archives of a manifest (``path``), and a row with ``gap`` for each quarantined byte range."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(parts).mapInArrow(_reader, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read the archives back."""
    found = read(write(pages, shared_folder(pages.sparkSession, "warc")))
    return found.where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
