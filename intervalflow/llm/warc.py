"""WARC records in ZIP-packaged archives.

An archive is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, one gzip member for each record, and
``indexes/index.jsonl``, one line for each record with its place.  A reader needs no extraction: it parses the end-of-central-directory
record, the ZIP64 records where sizes or counts ask for them, and the central directory; a stored member's bytes lie in the archive as
they are, so a record is one range read at the member's place plus the record's offset.

Tasks write whole archives of bounded size under names of their own; a manifest table, committed by Spark, lists those of the tasks
that succeeded, so archives of lost attempts are never read.  Files are opened through Arrow's file systems, local or not.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import open_path as _open
from .storage import qualified, stage

MIN_REVISIT = 1000                  # payloads below this are never stored as revisits
ARCHIVE_BYTES = 128 << 20           # an archive is closed beyond this
READ_BYTES = 4 << 20                # neighbouring records are read together up to this
GZIP_LEVEL = 1
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
_EOCD, _EOCD64, _LOC64, _CENTRAL, _LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF
PLAN = "page_id long, url string, payload binary, digest string, refers_to long"
READ = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
        "payload binary, archive string, offset long, length long")


# ---------------------------------------------------------------- ZIP

class ZipWriter:
    """Stored members, streamed: sizes follow each member in a data descriptor.  ``zip64`` forces the 64-bit records; else they
    are written where a size, an offset or the number of members needs them."""

    def __init__(self, sink, zip64: bool = False) -> None:
        self.sink, self.zip64, self.at, self.members = sink, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def member(self, name: str, chunks) -> None:
        start, raw = self.at, name.encode()
        # The 64-bit extra field in the local header makes the descriptor's sizes 64-bit.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", _LOCAL, 45, 0x0808, 0, 0, 0x21, 0, _MAX32, _MAX32, len(raw), len(extra)) + raw + extra)
        crc = size = 0
        for chunk in chunks:
            crc, size = zlib.crc32(chunk, crc), size + len(chunk)
            self._put(chunk)
        self._put(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.members.append((raw, start, crc, size))

    def close(self) -> None:
        begin = self.at
        for raw, start, crc, size in self.members:
            wide = [x for x in (size, size, start) if self.zip64 or x >= _MAX32]
            big_size, big_start = self.zip64 or size >= _MAX32, self.zip64 or start >= _MAX32
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            n = _MAX32 if big_size else size
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, n, n, len(raw), len(extra), 0, 0, 0, 0,
                                  _MAX32 if big_start else start) + raw + extra)
        length, count = self.at - begin, len(self.members)
        if self.zip64 or begin >= _MAX32 or length >= _MAX32 or count >= _MAX16:
            end = self.at
            self._put(struct.pack("<IQHHIIQQQQ", _EOCD64, 44, 45, 45, 0, 0, count, count, length, begin))
            self._put(struct.pack("<IIQI", _LOC64, 0, end, 1))
            count, length, begin = _MAX16, _MAX32, _MAX32
        self._put(struct.pack("<IHHHHIIH", _EOCD, 0, 0, count, count, length, begin, 0))


def zip_members(file, size: int) -> dict[str, tuple[int, int, int]]:
    """``{name: (place of the first byte, length, compression method)}`` of an archive; ``file`` reads ranges by ``read_at(n, offset)``."""
    tail_at = max(0, size - 65557)
    tail = file.read_at(size - tail_at, tail_at)
    end = len(tail)
    while True:
        end = tail.rfind(struct.pack("<I", _EOCD), 0, end)
        if end < 0:
            raise ValueError("no end of central directory: not a ZIP archive")
        if len(tail) - end >= 22 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    count, length, begin = struct.unpack_from("<HII", tail, end + 10)
    if count == _MAX16 or length == _MAX32 or begin == _MAX32:
        mark, _, place, _ = struct.unpack("<IIQI", file.read_at(20, tail_at + end - 20))
        if mark != _LOC64:
            raise ValueError("the ZIP64 locator is missing")
        mark, _, _, _, _, _, _, count, length, begin = struct.unpack("<IQHHIIQQQQ", file.read_at(56, place))
        if mark != _EOCD64:
            raise ValueError("the ZIP64 end of central directory is missing")
    directory, at, out = file.read_at(length, begin), 0, {}
    for _ in range(count):
        if struct.unpack_from("<I", directory, at)[0] != _CENTRAL:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n_name].decode()
        x, stop = at + 46 + n_name, at + 46 + n_name + n_extra
        while x + 4 <= stop:
            kind, n = struct.unpack_from("<HH", directory, x)
            if kind == 1:       # the 64-bit values stand in this order, each only where its 32-bit field is full
                wide = iter(struct.unpack_from(f"<{n // 8}Q", directory, x + 4))
                plain = next(wide) if plain == _MAX32 else plain
                packed = next(wide) if packed == _MAX32 else packed
                local = next(wide) if local == _MAX32 else local
            x += 4 + n
        n_name2, n_extra2 = struct.unpack("<HH", file.read_at(4, local + 26))
        out[name] = (local + 30 + n_name2 + n_extra2, packed, method)
        at += 46 + n_name + n_extra + n_note
    return out


# ---------------------------------------------------------------- WARC

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record.  A revisit has the HTTP header, with the full payload's length, and no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", *([f"WARC-Target-URI: {target}"] if url is not None else []),
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """``(page_id, url, type, payload_bytes, digest, refers_to, payload or None)`` of a record; a response's payload is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    name = fields["WARC-Record-ID"][10:-1]
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {name}: the payload does not match its length or digest")
    refers = fields.get("WARC-Refers-To")
    return (int(name) if name else None, fields.get("WARC-Target-URI"), fields["WARC-Type"], length, digest,
            int(refers[10:-1]) if refers else None, payload if whole else None)


# ---------------------------------------------------------------- Spark

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows of ``PLAN``: each page's payload, its digest, and the page it refers to if it is a revisit.

    Of equal payloads of ``MIN_REVISIT`` bytes or more, the page with the largest id is the response.  A null payload is empty; a page
    with a null id is always a response; rows that repeat that largest id are all responses."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Copies are counted before the shuffle; only payloads that occur twice go on to the join.
    first = (rows.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull())
             .groupBy("digest").agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least")).where("keeper <> least").drop("least"))
    # The staged table lets both sides of the join shuffle on their own, so adaptive execution can split a payload with many copies.
    return rows.join(stage(first, "keepers"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("keeper"), F.col("keeper")).alias("refers_to"))


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False, level: int = GZIP_LEVEL) -> DataFrame:
    """Write ``PLAN`` rows into archives below ``folder``, a folder that all executors share; the result is the staged manifest
    ``(archive, bytes, records)``."""
    folder = qualified(plan.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base)
        index: list[bytes] = []

        def records() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in range(5)))

        todo = records()
        ahead = next(todo, None)
        while ahead is not None:
            name = f"part-{uuid.uuid4().hex}.wacz"
            index.clear()

            def chunks() -> Iterator[bytes]:
                nonlocal ahead
                at = 0
                while ahead is not None and at < archive_bytes:
                    raw = gzip.compress(record(*ahead), level, mtime=0)
                    index.append(json.dumps({"page_id": ahead[0], "url": ahead[1], "offset": at, "length": len(raw)}).encode() + b"\n")
                    at += len(raw)
                    yield raw
                    ahead = next(todo, None)

            with files.open_output_stream(f"{base}/{name}") as sink:
                zipped = ZipWriter(sink, zip64)
                zipped.member(DATA, chunks())
                zipped.member(INDEX, index)
                zipped.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([zipped.at]), pa.array([len(index)])],
                                             ["archive", "bytes", "records"])

    return stage(plan.mapInArrow(run, "archive string, bytes long, records long"), "manifest")


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)


def read_archives(manifest: DataFrame) -> DataFrame:
    """``READ`` rows of every record in the archives of ``manifest(archive)``; a revisit has no payload.

    Each archive's directory and index are parsed, then its records are read by range, neighbours together up to ``READ_BYTES``."""
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("archive", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _open(path)
                with files.open_input_file(name) as file:
                    members = zip_members(file, file.size())
                    for data in sorted(m for m in members if m.startswith("archive/")):
                        start, _, method = members[data]
                        if method:
                            raise ValueError(f"{path}: {data} is not stored")
                        place, n, method = members[INDEX]
                        lines = io.BytesIO(file.read_at(n, place))
                        held: list[dict] = []
                        for line in [*lines, b""]:
                            entry = json.loads(line) if line else None
                            if held and (entry is None or entry["offset"] + entry["length"] - held[0]["offset"] > READ_BYTES):
                                low = held[0]["offset"]
                                raw = file.read_at(held[-1]["offset"] + held[-1]["length"] - low, start + low)
                                yield _batch([(*parse_record(zlib.decompress(raw[e["offset"] - low:e["offset"] - low + e["length"]], 31)),
                                               path, start + e["offset"], e["length"]) for e in held], kind)
                                held = []
                            if entry is not None:
                                held.append(entry)

    # An archive a task, the number said outright: adaptive execution would join the manifest's few bytes into one task.  The manifest has
    # a row for each ``ARCHIVE_BYTES``, so numbering it is small work.
    count = manifest.count()
    numbered = manifest.select("archive", (F.row_number().over(Window.orderBy("archive")) - 1).alias("task"))
    return numbered.repartitionById(max(count, 1), "task").select("archive").mapInArrow(run, READ)


def read_record(archive: str, offset: int, length: int) -> tuple:
    """One record by its place in an archive, named as in the manifest: a single range read."""
    files, name = _open(archive)
    with files.open_input_file(name) as file:
        return parse_record(zlib.decompress(file.read_at(length, offset), 31))
