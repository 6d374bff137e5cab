"""WARC archives: writing, normalising monolithic gzip files, and reading by offset.

:func:`write_archives` lays pages down as WARC 1.1 records in files that are one
gzip stream each, as many crawlers leave them. :func:`normalise` inflates every
such stream once, front to back, rewrites each record as a gzip member of its
own and writes a sidecar index (offset, length, type, id and digest of each
member) beside the archive. :func:`read_archives` goes through the index, seeks
each member and parses it alone.

Files go to the shared folder under names that no other attempt uses; only
files that the finished job lists in its manifest are read on, so tasks that are
lost or run twice leave nothing behind that counts.

What happens in special cases:

* null html is an empty payload; a null url is written as ``urn:none``; line
  breaks in a url are percent-encoded;
* of records with equal payloads of at least ``min_revisit_bytes`` bytes, that
  with the smallest id is the response and the others are revisits of it; rows
  that repeat this smallest id with this payload are responses too;
* a null id is never the smallest unless all are null (then all are
  responses), and reads back as null;
* other columns are not carried; an empty table gives an empty result;
* a record that is cut short or a stream that is broken raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.shared import fresh_path, materialise

DATE = "2024-01-01T00:00:00Z"
ID = "urn:presslens:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Uncompressed bytes after which a writer starts its next file.
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
MANIFEST = "path string, records long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder named as Hadoop does."""
    folder = re.sub(r"^file:/+", "/", folder)
    return (pafs.LocalFileSystem(), folder) if "://" not in folder else pafs.FileSystem.from_uri(folder)


def _digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _header(fields: dict[str, str | int | None]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n").encode()


def _record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, sha1: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    fields = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": f"<{ID}{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else "urn:none",
        "WARC-Payload-Digest": f"sha1:{_digest(sha1)}",
        "WARC-Profile": None if payload is not None else REVISIT,
        "WARC-Refers-To": None if payload is not None else f"<{ID}{refers_to}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    return _header(fields) + block + b"\r\n\r\n"


def revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, n_bytes, sha1, refers_to``; a revisit has no payload.

    The smallest id of each digest is combined before its shuffle; only digests
    that occur again are joined back, so a very common payload is never
    gathered in one place.
    """
    payload = F.encode(F.coalesce(html_col, F.lit("")), "UTF-8")
    keyed = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumns(
        {"n_bytes": F.octet_length("payload").cast("long"), "sha1": F.unhex(F.sha1("payload"))}
    )
    again = (
        keyed.filter(F.col("n_bytes") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("sha1").alias("again"), "first")
    )
    joined = keyed.join(again, F.col("sha1") == F.col("again"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.withColumn("refers_to", refers).select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "n_bytes", "sha1", "refers_to"
    )


def _manifest(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["path", "records"])


def write_archives(records: DataFrame, name: str = "warc") -> DataFrame:
    """Write records as monolithic gzip files; returns the manifest ``path, records``."""
    folder = fresh_path(records.sparkSession, name)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        out, done = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                record = _record(*[batch.column(k)[row].as_py() for k in range(6)])
                if out is None:
                    fs.create_dir(root, recursive=True)
                    path = f"{root}/{uuid.uuid4().hex}.mono.warc.gz"
                    out, gz, size, count = fs.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                    out.write(gz.compress(_header({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "Content-Type": "application/warc-fields", "Content-Length": 0}) + b"\r\n\r\n"))
                out.write(gz.compress(record))
                size, count = size + len(record), count + 1
                if size >= FILE_BYTES:
                    out.write(gz.flush())
                    out.close()
                    done.append((path, count))
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((path, count))
        yield _manifest(done)

    return materialise(records.mapInArrow(write, MANIFEST), f"{name}-manifest")


def stream_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(fields, block, whole record) of each record of an inflated stream, holding one record at a time."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            chunk = next(chunks, None)
            if chunk is None:
                return False
            held.extend(chunk)
        return True

    while fill(1):
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not fill(len(held) + 1):
                raise ValueError("a WARC header is cut short")
            end = held.find(b"\r\n\r\n")
        lines = held[:end].decode("utf-8").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        if not lines[0].startswith("WARC/") or not fill(end + 4 + length + 4):
            raise ValueError("a WARC record is cut short")
        record = bytes(held[: end + 4 + length + 4])
        yield fields, record[end + 4 : -4], record
        del held[: len(record)]


def inflate(source) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, piece by piece."""
    gz = zlib.decompressobj(31)
    while data := source.read(READ_BYTES):
        while data:
            yield gz.decompress(data, READ_BYTES)
            while gz.unconsumed_tail:
                yield gz.decompress(gz.unconsumed_tail, READ_BYTES)
            data = gz.unused_data
            if data:
                gz = zlib.decompressobj(31)
    if not gz.eof:
        raise ValueError("a gzip stream is cut short")


def normalise(manifest: DataFrame) -> DataFrame:
    """Rewrite each listed archive with a gzip member for each record, with a sidecar index; returns their manifest.

    An archive is the unit of work, so writers bound its size; a record is the
    most that is held in memory.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, _ = _open(path)
                target = path.replace(".mono.warc.gz", f".{uuid.uuid4().hex}.warc.gz")
                offset = count = 0
                with fs.open_input_stream(path, compression=None) as source, fs.open_output_stream(target, compression=None) as out, fs.open_output_stream(f"{target}.idx", compression=None) as index:
                    for fields, _, record in stream_records(inflate(source)):
                        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = gz.compress(record) + gz.flush()
                        out.write(member)
                        entry = {"offset": offset, "length": len(member), "type": fields["warc-type"], "id": fields["warc-record-id"], "digest": fields.get("warc-payload-digest")}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, count = offset + len(member), count + 1
                yield _manifest([(target, count)])

    width = manifest.sparkSession.sparkContext.defaultParallelism
    return materialise(manifest.repartition(width, "path").mapInArrow(rewrite, MANIFEST), "warc-normal")


def _page(value: str) -> int | None:
    digits = value.strip("<>").removeprefix(ID)
    return int(digits) if digits else None


def parse_record(fields: dict[str, str], block: bytes) -> tuple[int | None, str | None, int, str, str, int | None]:
    """Page id, url, payload bytes, payload digest, type and referred page of a response or revisit."""
    head, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    refers = None
    if fields["warc-type"] == "response":
        if len(payload) != n_bytes or _digest(hashlib.sha1(payload).digest()) != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    else:
        refers = _page(fields["warc-refers-to"])
    url = fields["warc-target-uri"]
    return _page(fields["warc-record-id"]), None if url == "urn:none" else url, n_bytes, digest, fields["warc-type"], refers


def read_archives(manifest: DataFrame) -> DataFrame:
    """The response and revisit records of normalised archives, each found by its entry in the index."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.int64() if x.endswith(" long") else pa.string() for x in RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, _ = _open(path)
                rows = []
                with fs.open_input_stream(f"{path}.idx", compression=None, buffer_size=READ_BYTES) as index, fs.open_input_file(path) as archive:
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        if entry["type"] not in ("response", "revisit"):
                            continue
                        archive.seek(entry["offset"])
                        record = zlib.decompress(archive.read(entry["length"]), 31)
                        fields, block, _ = next(stream_records(iter([record])))
                        rows.append((*parse_record(fields, block), path, entry["offset"], entry["length"]))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    width = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(width, "path").mapInArrow(read, RECORD)
