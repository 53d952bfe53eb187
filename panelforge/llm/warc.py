"""WARC archives: writing, normalising to one gzip member per record, reading back.

1. ``write_archives``: each task writes its pages into archives of a bounded
   size. An archive is one gzip stream over the whole file, as many crawlers
   leave it; a page with the payload of an earlier page becomes a revisit.
2. ``normalise``: each archive is inflated once, as a stream; every record is
   written again as a gzip member of its own, and a sidecar index gets a line
   with the record's id, offset and length. Memory holds one record.
3. ``read_records``: the records named by the index are read at their offsets.

Files lie in a folder that all executors share and are opened through
``pyarrow.fs`` by its URI. File names are made anew for each task attempt, and
only the names in the manifests that Spark commits count, so that a lost
executor leaves at most files that nobody refers to.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import written
from panelforge.session import shared_scratch

#: Payload bytes after which a task begins the next archive.
ARCHIVE_BYTES = 8 << 20
READ_BYTES = 1 << 18
LEVEL = 1
DATE = "2000-01-01T00:00:00Z"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; its digest and size are those of the page."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", json.dumps(url or "")[1:-1]),  # control characters are escaped
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(size)),
    ]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", str(refers_to))]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload or b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    return dict(line.split(": ", 1) for line in lines)


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, whole record) of a stream of inflated bytes."""
    held, chunks = bytearray(), iter(chunks)

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill(seen + 1):
                raise ValueError("the archive ends inside a record's header")
        head = parse_head(bytes(held[:end]))
        size = end + 4 + int(head["Content-Length"]) + 4
        if not fill(size):
            raise ValueError("the archive ends inside a record")
        yield head, bytes(held[:size])
        del held[:size]


def inflated(stream) -> Iterator[bytes]:
    """Inflates a stream of one or more gzip members, in bounded pieces."""
    machine = zlib.decompressobj(31)
    data = stream.read(READ_BYTES)
    while data:
        out = machine.decompress(data, READ_BYTES)
        if out:
            yield out
        data = machine.unused_data if machine.eof else machine.unconsumed_tail
        if machine.eof:
            machine = zlib.decompressobj(31)
        data = data or stream.read(READ_BYTES)


def _archiver(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        out, machine, held, names, counts = None, None, 0, [], []

        def close() -> None:
            if out is not None:
                out.write(machine.flush())
                out.close()

        for batch in batches:
            for page_id, url, html, digest, size, refers_to in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if out is None or held >= ARCHIVE_BYTES:
                    close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, machine, held = system.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                    names.append(f"{folder}/{name}"), counts.append(0)
                payload = None if html is None else html.encode()
                out.write(machine.compress(record(page_id, url, payload, digest, size, refers_to)))
                held += len(payload or b"")
                counts[-1] += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    return run


def _digest(hexadecimal):
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = pa.array([_digest(x) for x in batch.column(3).to_pylist()], pa.string())
        yield batch.set_column(3, "digest", digests)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes ``pages`` into archives in ``folder``; returns the manifest (archive, records).

    Of pages with equal payloads of at least ``least_bytes``, that with the
    smallest id is written as a response and the others revisit it; rows that
    repeat the smallest id, and rows without an id, are responses.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("html"))
    hashed = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    # the smallest id of each payload: combined before the shuffle; very common payloads are split by the skew join
    firsts = hashed.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"))
    revisit = F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first"))
    planned = hashed.join(firsts, "digest", "left").select(
        "page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "size", F.when(revisit, F.col("first")).alias("refers_to")
    )
    schema = "page_id long, url string, html string, digest string, size long, refers_to long"
    opened(folder)[0].create_dir(opened(folder)[1], recursive=True)
    return written(planned.mapInArrow(_base32, schema).mapInArrow(_archiver(folder), "archive string, records long"), "warc-manifest")


def _one_each(manifest: DataFrame, n: int) -> DataFrame:
    return manifest.repartition(max(1, n), "archive")


def normalise(manifest: DataFrame) -> DataFrame:
    """Rewrites every archive of the manifest with one gzip member per record.

    Beside ``x.warc.gz`` lie then ``x.members.warc.gz`` and ``x.members.idx``,
    the index with a line ``record id, offset, length`` for each record. Returns
    the new manifest (archive, index, records).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            archives, indices, counts = [], [], []
            for uri in batch.column(0).to_pylist():
                system, path = opened(uri)
                stem = f"{path.removesuffix('.warc.gz')}.{uuid.uuid4().hex[:8]}.members"
                offset, count = 0, 0
                with (
                    system.open_input_stream(path, compression=None) as source,
                    system.open_output_stream(f"{stem}.warc.gz", compression=None) as out,
                    system.open_output_stream(f"{stem}.idx", compression=None) as index,
                ):
                    for head, whole in split_records(inflated(source)):
                        machine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = machine.compress(whole) + machine.flush()
                        out.write(member)
                        index.write(f"{head['WARC-Record-ID']}\t{offset}\t{len(member)}\n".encode())
                        offset, count = offset + len(member), count + 1
                folder, name = uri.rsplit("/", 1)[0], stem.rsplit("/", 1)[1]
                archives.append(f"{folder}/{name}.warc.gz"), indices.append(f"{folder}/{name}.idx"), counts.append(count)
            yield pa.RecordBatch.from_arrays([pa.array(archives, pa.string()), pa.array(indices, pa.string()), pa.array(counts, pa.int64())], ["archive", "index", "records"])

    n = manifest.count()
    return written(_one_each(manifest, n).mapInArrow(run, "archive string, index string, records long"), "warc-members")


_RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record of the normalised archives, each read at its offset in the index.

    The payload's digest and size are computed from a response's payload and
    compared with the header; a revisit has those of the page it repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, index_uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = opened(uri)
                with system.open_input_stream(opened(index_uri)[1], compression=None) as f:
                    entries = [line.split("\t") for line in f.read().decode().splitlines()]
                rows: list[tuple] = []
                held = 0
                with system.open_input_file(path) as f:
                    for record_id, offset, length in entries:
                        f.seek(int(offset))
                        whole = zlib.decompress(f.read(int(length)), 31)
                        end = whole.index(b"\r\n\r\n")
                        head = parse_head(whole[:end])
                        if head["WARC-Record-ID"] != record_id:
                            raise ValueError(f"{uri}: the index does not fit the archive at {offset}")
                        body = whole[whole.index(b"\r\n\r\n", end + 4) + 4 : -4]
                        size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind = head["WARC-Type"]
                        if kind == "response" and (len(body), payload_digest(body)) != (size, digest):
                            raise ValueError(f"{uri}: the payload at {offset} does not fit its digest")
                        page, first = head["X-Page-Id"], head.get("X-Refers-To-Page")
                        url = json.loads(f'"{head["WARC-Target-URI"]}"')
                        rows.append((int(page) if page else None, url, size, digest, kind, int(first) if first else None, body if payload and kind == "response" else None))
                        held += len(body)
                        if held >= ARCHIVE_BYTES:
                            yield _rows(rows)
                            rows, held = [], 0
                yield _rows(rows)

    return _one_each(manifest, manifest.count()).mapInArrow(run, _RECORD_SCHEMA)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in _RECORD_SCHEMA.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def round_trip(pages: DataFrame, least_bytes: int = 0, payload: bool = True) -> DataFrame:
    """The records of ``pages`` after writing, normalising and reading back.

    A null payload counts as empty; a null url is written as empty; a null id is
    kept and such a page is a response. An empty table gives an empty result.
    Other columns of ``pages`` are not archived.
    """
    folder = shared_scratch(pages.sparkSession, "warc")
    return read_records(normalise(write_archives(pages, folder, least_bytes)), payload)
