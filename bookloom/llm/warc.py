"""WARC archives: writing whole-file gzip streams, normalising them to a member per record with an index, reading."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.common import col, lists, stored, text_of
from bookloom.session import work_dir

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "path string, records long"
INDEX = "path string, index string, records long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary"
LEVEL = 5


def roles(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit): of pages with equal payloads of at least `min_bytes` bytes
    the one with the smallest id is the response, the others revisit it. Rows that share that id are responses."""
    rows = pages.select(
        col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"), text_of(payload_col).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    twice = stored(
        rows.where(F.length("payload") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL").select("digest", "first"), "payloads")
    joined = rows.join(twice, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.length("payload") >= min_bytes)
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_streams(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one gzip stream per task, all its records in it; (path, records) of the files. A task that runs again
    writes its file anew and puts it in place of the old one when it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with _written(path) as out:
            squeeze = zlib.compressobj(LEVEL, wbits=31)
            for page, url, payload, digest, refers, revisit in (row for cols in lists(batches) for row in zip(*cols, strict=True)):
                out.write(squeeze.compress(record(page, url, payload, digest, refers, revisit, date)))
                n += 1
            out.write(squeeze.flush())
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], ["path", "records"])

    return records.select("page_id", "url", "payload", "digest", "refers_to", "revisit").mapInArrow(run, FILES)


def record(page: int | None, url: str | None, payload: bytes, digest: bytes, refers: int | None, revisit: bool, date: str) -> bytes:
    sha = base64.b32encode(digest).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~' + chr(39))}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def normalise(files: DataFrame) -> DataFrame:
    """Inflate each file once as a stream, write every record as a gzip member of its own into a new file, and a
    sidecar with a line per member: offset, length, type, record id. (path, index, records) of the new files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, _ in lists(batches):
            for path in paths:
                members, index = path.removesuffix(".warc.gz") + ".members.warc.gz", path.removesuffix(".warc.gz") + ".index.jsonl"
                n = at = 0
                with _opened(path) as source, _written(members) as out, _written(index) as side:
                    for head, raw in read_records(gzip.GzipFile(fileobj=source)):
                        squeeze = zlib.compressobj(LEVEL, wbits=31)
                        member = squeeze.compress(raw) + squeeze.flush()
                        out.write(member)
                        entry = {"offset": at, "length": len(member), "type": head["warc-type"], "id": head["warc-record-id"]}
                        side.write(json.dumps(entry).encode() + b"\n")
                        n, at = n + 1, at + len(member)
                yield pa.RecordBatch.from_arrays([pa.array([members]), pa.array([index]), pa.array([n])], ["path", "index", "records"])

    return files.mapInArrow(run, INDEX)


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, the whole record as it stands) of each record in an inflated stream."""
    stream = io.BufferedReader(stream, 1 << 20)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        raw, head = [line], {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
            raw.append(line)
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]):
            raise ValueError("the stream ends inside a record")
        yield head, b"".join([*raw, b"\r\n", block, b"\r\n\r\n"])


def read_members(index: DataFrame) -> DataFrame:
    """The records of normalised files, each inflated alone from its offset in the sidecar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, sidecars, _ in lists(batches):
            for path, sidecar in zip(paths, sidecars, strict=True):
                with _opened(sidecar) as side, _opened(path) as source:
                    out, size = [], 0
                    for line in io.BufferedReader(side):
                        entry = json.loads(line)
                        source.seek(entry["offset"])
                        raw = zlib.decompress(source.read(entry["length"]), wbits=31)
                        out.append(_row(raw))
                        size += len(raw)
                        if size > 8 << 20:
                            yield _batch(out)
                            out, size = [], 0
                    yield _batch(out)

    return index.mapInArrow(run, RECORDS)


def _row(raw: bytes) -> tuple:
    (head, whole), = read_records(io.BytesIO(raw))
    block = whole[len(whole) - 4 - int(head["content-length"]): len(whole) - 4]
    payload = block[block.index(b"\r\n\r\n") + 4:]
    sha = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and sha != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError(f"{head['warc-record-id']}: the payload does not have its digest")
    number = lambda name: int(n) if (n := head.get(name, "<urn:page:>")[10:-1]) else None
    return number("warc-record-id"), head.get("warc-target-uri"), head["warc-type"], number("warc-refers-to"), sha, payload


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload"])


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path: local, or any that Arrow reaches by its URI."""
    return fs.FileSystem.from_uri(path)


@contextmanager
def _opened(path: str):
    system, name = _place(path)
    with system.open_input_file(name) as file:
        yield file


@contextmanager
def _written(path: str):
    """A file that appears under its name only when it is whole."""
    system, name = _place(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    draft = f"{name}.{uuid.uuid4().hex}.draft"
    with system.open_output_stream(draft, compression=None) as file:
        yield file
    system.move(draft, name)


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, **columns) -> DataFrame:
    """Write the pages as whole-file streams, normalise them: (path, index, records) of the normalised files.

    A null payload is empty, a null url is left out, pages without id get a record without number (a response unless
    an equal payload has an id), repeated rows are a record each; an empty table gives files without records.
    Other columns are not looked at.
    """
    folder = folder or work_dir(pages.sparkSession, "warc")
    files = stored(write_streams(roles(pages, min_bytes, **columns), folder), "files")
    n = max(1, files.count())
    return stored(normalise(files.repartition(n)), "members")


def read_archive(index: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) per record; a revisit has the size of the
    payload it refers to."""
    read = read_members(index.repartition(max(1, index.count()))).withColumn("bytes", F.length("payload").cast("long"))
    records = stored(read.drop("payload"), "records")
    full = stored(records.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("bytes").alias("full")), "payloads")
    joined = records.join(full, "payload_digest", "left")
    return joined.select("page_id", "url", F.when(F.col("record_type") == "revisit", F.col("full")).otherwise(F.col("bytes")).alias("payload_bytes"),
                         "payload_digest", "record_type", "refers_to")
