"""WARC bundles in seekable Zstandard: independent frames, a footer seek table, and an index.

A bundle is a sequence of Zstandard frames, each holding some whole WARC 1.1
records, and a last skippable frame with the seek table of the public seekable
format (compressed and uncompressed size of every frame, number of frames).
Record ids map to (frame, offset in the frame's uncompressed bytes), so one
record costs one read of the footer and one frame.

A record whose payload another record with a smaller id has already is written
as ``revisit``, with the id it refers to and no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import group_min, table, work_dir

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Uncompressed bytes after which a frame ends, compressed bytes after which a bundle ends, and the level.
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 64 << 20, 3


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, kind: str, payload: bytes, size: int, sha: str, refers_to: int | None) -> bytes:
    """One WARC record. Line breaks in a URL are percent-encoded, as headers end at them."""
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{sha}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(buf: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and body of the record at ``at``, and where the next one starts."""
    end = buf.index(b"\r\n\r\n", at)
    lines = buf[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(head["Content-Length"])
    return head, buf[end + 4:end + 4 + n], end + 8 + n


class BundleWriter:
    """Collects records into frames; ``close`` returns the file's bytes and its index rows."""

    def __init__(self, level: int = LEVEL):
        self.z = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.total = 0
        self.index: list[tuple[int | None, int, int, int]] = []

    def add(self, page_id: int | None, record: bytes) -> None:
        self.index.append((page_id, len(self.sizes), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.open:
            data = b"".join(self.open)
            frame = self.z.compress(data)
            self.frames.append(frame)
            self.sizes.append((len(frame), len(data)))
            self.total += len(frame)
            self.open, self.filled = [], 0

    def close(self) -> bytes:
        self._end_frame()
        entries = b"".join(struct.pack("<II", c, u) for c, u in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        table_ = struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer
        return b"".join(self.frames) + table_


class BundleReader:
    """Reads frames of an open random-access file by its seek table."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        f.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        f.seek(size - 9 - n * width)
        raw = f.read(n * width)
        self.offsets, self.sizes, at = [], [], 0
        for k in range(n):
            c, u = struct.unpack_from("<II", raw, k * width)
            self.offsets.append((at, c))
            self.sizes.append(u)
            at += c

    def frame(self, k: int) -> bytes:
        at, c = self.offsets[k]
        self.f.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.f.read(c), max_output_size=self.sizes[k])

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        head, body, _ = parse_record(self.frame(frame), offset)
        return head, body

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for k in range(len(self.offsets)):
            buf, at = self.frame(k), 0
            while at < len(buf):
                head, body, at = parse_record(buf, at)
                yield head, body


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _store(folder: str, name: str, data: bytes) -> str:
    where, path = _file_system(folder)
    where.create_dir(path, recursive=True)
    with where.open_output_stream(f"{path}/{name}", compression=None) as f:
        f.write(data)
    return f"{folder}/{name}"


INDEX = "page_id long, bundle string, frame int, offset long, length long"


def _write(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        # each attempt of a task has its own files; the index names those of the attempt that counts
        part, attempt, k, w = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, BundleWriter()

        def done() -> pd.DataFrame:
            path = _store(folder, f"bundle-{part:06d}-{k:04d}-{attempt}.warc.zst", w.close())
            rows = pd.DataFrame(w.index, columns=["page_id", "frame", "offset", "length"])
            rows["page_id"] = rows["page_id"].astype("Int64")
            rows.insert(1, "bundle", path)
            return rows

        for pdf in batches:
            for page_id, url, html, first in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["first_id"]):
                payload = (html or "").encode("utf-8", "surrogatepass")
                own = None if pd.isna(page_id) else int(page_id)
                refers = int(first) if own is not None and not pd.isna(first) and int(first) != own else None
                w.add(own, record_bytes(own, url, "response" if refers is None else "revisit", payload, len(payload), digest(payload), refers))
                if w.total >= BUNDLE_BYTES:
                    yield done()
                    k, w = k + 1, BundleWriter()
        if w.index:
            yield done()
    return run


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as bundles below ``folder``; returns the index of the records.

    The payload is the html in UTF-8 (NULL: empty). Of records with equal
    payloads of at least ``min_bytes`` bytes, that with the least page_id is
    the response, the others revisit it. Rows that repeat the least page_id are
    all responses, and so is a row with a NULL page_id. ``folder`` is a path or
    URI that every executor can write.
    """
    html = F.coalesce("html", F.lit(""))
    key = F.when((F.octet_length(html) >= min_bytes) & F.col("page_id").isNotNull(), F.sha1(html.cast("binary")))
    ids = table(pages.select(F.col("page_id").cast("long").alias("page_id"), key.alias("sha")), "warc-keys")
    first = group_min(ids, "sha", "page_id", "first_id")
    # only the revisits travel; a page is matched by its id and payload
    later = first.where("first_id < page_id").groupBy("page_id", "sha").agg(F.min("first_id").alias("first_id"))
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", key.alias("sha"))
            .join(later, ["page_id", "sha"], "left").select("page_id", "url", "html", "first_id"))
    return table(rows.mapInPandas(_write(folder), INDEX), "warc-index")


RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, content binary"


def _id(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    size = 0

    def out() -> pd.DataFrame:
        pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")])
        pdf["page_id"], pdf["refers_to"] = pdf["page_id"].astype("Int64"), pdf["refers_to"].astype("Int64")
        return pdf

    for pdf in batches:
        for bundle in pdf["bundle"]:
            where, path = _file_system(bundle)
            with where.open_input_file(path) as f:
                for head, body in BundleReader(f).records():
                    kind, sha = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (digest(body) != sha or len(body) != int(head["X-Payload-Length"])):
                        raise ValueError(f"{bundle}: payload of {head['WARC-Record-ID']} does not match its digest")
                    rows.append((_id(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind, sha, int(head["X-Payload-Length"]),
                                 _id(head.get("WARC-Refers-To")), body))
                    size += len(body)
                    if size > 4 << 20 or len(rows) >= 5000:
                        yield out()
                        rows, size = [], 0
    if rows:
        yield out()


def read_warc(index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` names, with checked payloads."""
    bundles = table(index.select("bundle").distinct(), "warc-bundles")
    count = bundles.count()
    # a bundle is a task's work; its row is so small that the engine would read all of them in one
    n = max(1, min(count, max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // 8)))
    return bundles.repartition(n, F.xxhash64("bundle")).mapInPandas(_read, RECORD)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    index = write_warc(pages, work_dir(spark, "warc"))
    return read_warc(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
