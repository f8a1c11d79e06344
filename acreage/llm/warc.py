"""WARC archives: write them as one gzip stream, and normalise such files to one member per record with an offset index."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.llm.common import stored, whole_text
from acreage.session import scratch_path

#: Payload bytes after which a task starts its next archive, and bytes that are read and inflated at a time.
ARCHIVE_BYTES, CHUNK = 64 << 20, 1 << 20
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def build(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """One record; fields that are None are left out, and control characters in values are escaped."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {quote(v, safe=''.join(map(chr, range(32, 127))))}" for k, v in fields.items() if v is not None]]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    own = {
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": "sha1:" + digest(payload),
        "WARC-Payload-Length": str(len(payload)),
        "WARC-Page-Id": page_id,
        "Content-Type": "application/http; msgtype=response",
    }
    head = HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        return build("response", own, head + payload)
    return build("revisit", own | {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to), "WARC-Refers-To-Page-Id": refers_to}, head)


# --- files ------------------------------------------------------------------------------------------------------------


class Output:
    """A file that appears under its name only when it is whole, so that a task that is lost or run twice leaves no part."""

    def __init__(self, path: str):
        self.system, self.path = fs.FileSystem.from_uri(path)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.stream, self.at = self.system.open_output_stream(self.part, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.part, self.path)


def inflated(path: str) -> Iterator[bytes]:
    """A gzip file in pieces of bounded size, whether it has one member or many."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place, compression=None) as f:
        stream = zlib.decompressobj(31)
        while data := f.read(CHUNK):
            while data:
                yield stream.decompress(data, CHUNK)
                data = stream.unconsumed_tail
                if stream.eof:
                    data, stream = stream.unused_data, zlib.decompressobj(31)
        yield stream.flush()


@dataclass
class Record:
    """Header of a record and its block, which is read once and in pieces."""

    raw: bytes
    block: Iterator[bytes]
    fields: dict[str, str] = field(init=False)

    def __post_init__(self):
        lines = self.raw.decode("utf-8", "replace").split("\r\n")
        self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def records(pieces: Iterator[bytes]) -> Iterator[Record]:
    """The records of an inflated archive, in order. Blank lines between records are skipped."""
    held = bytearray()

    def more() -> bool:
        for p in pieces:
            if p:
                held.extend(p)
                return True
        return False

    while True:
        while held[:2] == b"\r\n" or len(held) < 2:
            if held[:2] == b"\r\n":
                del held[:2]
            elif not more():
                if held.strip():
                    raise ValueError("an archive ends inside a record")
                return
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not more():
                raise ValueError("an archive ends inside a header")
        raw = bytes(held[:end])
        del held[: end + 4]
        length = re.search(rb"(?im)^content-length:\s*([0-9]+)", raw)
        if not raw.startswith(b"WARC/") or not length:
            raise ValueError("not a record header")
        left = int(length[1])

        def block() -> Iterator[bytes]:
            nonlocal left
            while left:
                if not held and not more():
                    raise ValueError("an archive ends inside a block")
                piece = bytes(held[:left])
                del held[:left]
                left -= len(piece)
                yield piece

        r = Record(raw, block())
        yield r
        for _ in r.block:
            pass


# --- jobs -------------------------------------------------------------------------------------------------------------


def _task_id() -> int:
    return TaskContext.get().partitionId()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of whole-file gzip streams in ``folder``; returns their names and record counts.

    ``pages``: id string, url string, payload binary, refers_to string, revisit boolean. Each task streams its rows into
    archives of about ``ARCHIVE_BYTES`` of payload; it holds one batch of rows at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, squeeze, size, n, made = None, None, 0, 0, []

        def finish() -> None:
            nonlocal out
            out.write(squeeze.flush())
            out.close()
            made.append((name, n))
            out = None

        for b in batches:
            for row in b.to_pylist():
                if out is None:
                    name, size, n = f"{_task_id():06d}-{len(made):04d}.warc.gz", 0, 0
                    out, squeeze = Output(f"{folder}/{name}"), zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(squeeze.compress(build("warcinfo", {"WARC-Record-ID": record_id(name), "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")))
                out.write(squeeze.compress(page_record(row["id"], row["url"], row["payload"], row["refers_to"], row["revisit"])))
                size, n = size + len(row["payload"]), n + 1
                if size >= ARCHIVE_BYTES:
                    finish()
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["archive", "n_records"])

    return stored(pages.mapInArrow(run, "archive string, n_records bigint"), "archives")


def normalise_file(source: str, target: str) -> int:
    """Inflate one archive once, write each record as a gzip member of its own, and ``target``.idx beside it.

    The index has a JSON line per record: offset and length of the member, record id, type and page id. Memory is bounded by
    ``CHUNK``, however long a record is.
    """
    out, index, n = Output(target), Output(target + ".idx"), 0
    for r in records(inflated(source)):
        start, squeeze = out.at, zlib.compressobj(6, zlib.DEFLATED, 31)
        out.write(squeeze.compress(r.raw + b"\r\n\r\n"))
        for piece in r.block:
            out.write(squeeze.compress(piece))
        out.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
        f = r.fields
        line = {"offset": start, "length": out.at - start, "id": f.get("warc-record-id"), "type": f.get("warc-type"), "page_id": f.get("warc-page-id")}
        index.write(json.dumps(line).encode() + b"\n")
        n += 1
    out.close()
    index.close()
    return n


def _each_archive(archives: DataFrame) -> DataFrame:
    """One task per archive; the number is given, so that small rows are not put together again."""
    return archives.select("archive").repartition(max(1, archives.count()))


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Normalise every named archive of one folder into another; returns names and record counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column("archive").to_pylist():
                n = normalise_file(f"{source}/{name}", f"{target}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "n_records"])

    return stored(_each_archive(archives).mapInArrow(run, "archive string, n_records bigint"), "normalised")


def read_member(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one member; the payload of a response must have the digest that its header names."""
    r = next(records(iter([zlib.decompress(data, 31)])))
    head, _, payload = b"".join(r.block).partition(b"\r\n\r\n")
    if r.fields.get("warc-type") == "response" and r.fields.get("warc-payload-digest") != "sha1:" + digest(payload):
        raise ValueError(f"payload of {r.fields.get('warc-record-id')} does not have its digest")
    return r.fields, payload


def read_archives(archives: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Page records of normalised archives, each reached by its entry in the index: see ``RECORDS``, and ``payload`` if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())])
        if payload:
            schema = schema.append(pa.field("payload", pa.binary()))
        for b in batches:
            for name in b.column("archive").to_pylist():
                system, path = fs.FileSystem.from_uri(f"{folder}/{name}")
                rows, size = [], 0
                with system.open_input_stream(path + ".idx", compression=None) as f:
                    index = f.read().splitlines()
                with system.open_input_file(path) as f:
                    for line in map(json.loads, index):
                        if line["type"] not in ("response", "revisit"):
                            continue
                        f.seek(line["offset"])
                        head, body = read_member(f.read(line["length"]))
                        revisit = line["type"] == "revisit"
                        n, sha = (int(head["warc-payload-length"]), head["warc-payload-digest"][5:]) if revisit else (len(body), digest(body))
                        row = {"page_id": head.get("warc-page-id"), "url": head.get("warc-target-uri"), "record_type": line["type"], "payload_bytes": n, "payload_digest": sha, "refers_to": head.get("warc-refers-to-page-id")}
                        rows.append(row | ({"payload": None if revisit else body} if payload else {}))
                        size += len(body) * payload
                        if len(rows) >= 10_000 or size >= ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _each_archive(archives).mapInArrow(run, RECORDS + ", payload binary" * payload)


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Pages as :func:`write_archives` takes them: of equal payloads of ``least`` bytes or more the largest key is the response.

    Pages are not shuffled: only digests are, and the keys of digests found twice are stored and joined; that side is
    broadcast if Spark finds it small, else joined by a shuffle that splits a payload on many pages. Null keys come last and
    repeated rows of the largest key are all responses.
    """
    p = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("url"), whole_text(html).cast("binary").alias("payload"))
    p = p.withColumn("n", F.length("payload")).withColumn("sha", F.sha1("payload"))
    twice = p.filter(F.col("n") >= least).groupBy("sha", "n").agg(F.max("k").alias("first"), F.count("*").alias("c"))
    twice = stored(twice.filter("c > 1 and first is not null").select("sha", "n", "first"), "equal")
    j = p.join(twice, ["sha", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first"))
    return j.select(F.col("k").cast("string").alias("id"), "url", "payload", F.when(revisit, F.col("first").cast("string")).alias("refers_to"), revisit.alias("revisit"))


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> tuple[DataFrame, str]:
    """Write ``pages`` as monolithic archives, normalise them, and return the names and the folder of the normalised ones."""
    folder = folder or scratch_path(spark, "warc")
    written = write_archives(with_revisits(pages, key, url, html, least), f"{folder}/whole")
    return normalise(written, f"{folder}/whole", f"{folder}/records"), f"{folder}/records"
