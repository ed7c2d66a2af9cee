"""Web archives with a two-level capture index.

Archives are WARC 1.1 files of one gzip member per record. The index sorts captures by
reversed-host URL key and page id into shards of compressed blocks; a shard's directory
keeps the first key of each block. A lookup finds the shard among the shards' first keys,
the block in the shard's directory and the capture in the block by binary search, and then
reads just the record's byte range.

Files go to ``spark.checkpoint.dir`` through Arrow's file systems (local, HDFS, S3, GCS).
A task writes under a name of its own and hands on what it wrote, so a repeated task
leaves an unread file behind and no half-written one is ever read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.llm.common import file_system, narrowed, slices
from quillcast.session import scratch_dir, written

#: Captures per block.
BLOCK = 1000
#: Records that one task of a lookup reads.
READS = 5000
#: Archive files that a lookup keeps open.
OPEN_FILES = 64
RECORD_ID = "urn:quillcast:page:"

CAPTURE = "url_key string, page long, file string, start long, size long"
LOOKUP = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: ``org,example,blog)/a?b=1``."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text if "://" in text else f"//{text}")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return text
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + query


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, original: bool) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if original else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if page is None else page}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if not original:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{RECORD_ID}{refers_to}>",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record; header names in lower case."""

    def headers(part: bytes) -> dict[str, str]:
        lines = part.decode().split("\r\n")[1:]
        return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, headers(http), payload


def _page(urn: str) -> int | None:
    value = urn.strip("<>").removeprefix(RECORD_ID)
    return int(value) if value else None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)


CAPTURES = pa.schema([("url_key", pa.string()), ("page", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())])
SHARDS = pa.schema([("url_key", pa.string()), ("page", pa.int64()), ("file", pa.string()), ("directory", pa.string()), ("rows", pa.int64())])
FOUND = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _key(url: str, page: int | None) -> tuple[str, bool, int]:
    """In Spark's order: nulls first."""
    return (url, page is not None, page or 0)


def write_archives(pages: DataFrame, base: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row and return the captures (url_key, page, file, start, size).

    Only digests that occur more than once are joined back, and the payload is written
    where it is read, so neither payloads nor repeated ones are gathered anywhere.
    """
    rows = narrowed(pages, page=id_col, url=url_col, html=html_col).withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    repeated = rows.groupBy("digest").agg(F.max("page").alias("latest"), F.count("*").alias("n")).where("n > 1").select("digest", "latest")
    joined = rows.join(written(repeated, "repeated"), "digest", "left").select("page", "url", "html", F.coalesce("latest", "page").alias("latest"))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        system.create_dir(f"{folder}/archive", recursive=True)
        name, at, out = f"archive/{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in slices(batches):
                captures = []
                for page, url, html, latest in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    if out is None:
                        out = system.open_output_stream(f"{folder}/{name}", compression=None)
                        member = gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n", 6, mtime=0)
                        out.write(member)
                        at = len(member)
                    member = gzip.compress(record(page, url, (html or "").encode(), latest, page == latest), 6, mtime=0)
                    out.write(member)
                    captures.append((url_key(url), page, name, at, len(member)))
                    at += len(member)
                yield _batch(captures, CAPTURES)
        finally:
            if out is not None:
                out.close()

    return written(joined.mapInArrow(archived, CAPTURE), "captures")


def write_index(captures: DataFrame, base: str, block: int = BLOCK) -> DataFrame:
    """Sort the captures into shards of compressed blocks; returns a row per shard.

    Shards are ranges of (url_key, page), so one host or URL with many captures spreads
    over as many shards as it needs.
    """

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        system.create_dir(f"{folder}/index", recursive=True)
        name = f"index/{uuid.uuid4().hex}"
        directory, pending, first, rows, at, out = [], [], None, 0, 0, None

        def flush(count: int) -> None:
            nonlocal at
            lines, pending[:] = pending[:count], pending[count:]
            member = gzip.compress(json.dumps(lines, ensure_ascii=False).encode(), 6, mtime=0)
            out.write(member)
            directory.append([lines[0][0], lines[0][1], at, len(member)])
            at += len(member)

        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = system.open_output_stream(f"{folder}/{name}.gz", compression=None)
            pending += map(list, zip(*(column.to_pylist() for column in batch.columns), strict=True))
            first = first or pending[0][:2]
            rows += batch.num_rows
            while len(pending) >= block:
                flush(block)
        if out is not None:
            if pending:
                flush(len(pending))
            out.close()
            with system.open_output_stream(f"{folder}/{name}.directory", compression=None) as side:
                side.write(json.dumps(directory, ensure_ascii=False).encode())
            yield _batch([(*first, f"{name}.gz", f"{name}.directory", rows)], SHARDS)

    ranged = captures.repartitionByRange("url_key", "page").sortWithinPartitions("url_key", "page", "file", "start")
    return written(ranged.mapInArrow(indexed, "url_key string, page long, file string, directory string, rows long"), "shards")


class Shard:
    """Lookups in one shard; holds its directory and the block read last."""

    def __init__(self, system: pafs.FileSystem, folder: str, file: str, directory: str):
        self.system, self.file = system, f"{folder}/{file}"
        with system.open_input_stream(f"{folder}/{directory}", compression=None) as stream:
            self.directory = json.loads(stream.read())
        self.firsts = [_key(url, page) for url, page, _, _ in self.directory]
        self.at, self.block, self.keys = None, [], []

    def _load(self, number: int) -> None:
        if number != self.at:
            _, _, start, size = self.directory[number]
            with self.system.open_input_file(self.file) as stream:
                self.block = json.loads(gzip.decompress(stream.read_at(size, start)))
            self.at, self.keys = number, [_key(line[0], line[1]) for line in self.block]

    def find(self, key: tuple[str, bool, int]) -> Iterator[list]:
        """All captures under the key, over block borders."""
        number = max(0, bisect_left(self.firsts, key) - 1)
        while number < len(self.directory) and self.firsts[number] <= key:
            self._load(number)
            yield from self.block[bisect_left(self.keys, key) : bisect_right(self.keys, key)]
            number += 1


def lookup(wanted: DataFrame, shards: DataFrame, base: str) -> DataFrame:
    """Records of the (url_key, page) in ``wanted``, read back from the archives.

    The shards' first keys, one row per task of the index, go to every task. Keys are
    dealt out by ranges of their own, so tasks read neighbouring blocks once.
    """
    index = shards.collect()
    tops = sorted(((_key(row["url_key"], row["page"]), row["file"], row["directory"]) for row in index), key=lambda top: top[0])
    tasks = -(-sum(row["rows"] for row in index) // READS) or 1

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        firsts = [top[0] for top in tops]
        files: dict[str, object] = {}
        shard, current = None, None
        for batch in batches:
            rows = []
            for url, page in zip(batch.column("url_key").to_pylist(), batch.column("page").to_pylist(), strict=True):
                place = bisect_right(firsts, _key(url, page)) - 1
                if place < 0:
                    continue
                if place != current:
                    shard, current = Shard(system, folder, *tops[place][1:]), place
                for _, _, file, start, size in shard.find(_key(url, page)):
                    if file not in files:
                        while len(files) >= OPEN_FILES:
                            files.pop(next(iter(files))).close()
                        files[file] = system.open_input_file(f"{folder}/{file}")
                    warc, http, payload = parse(gzip.decompress(files[file].read_at(size, start)))
                    stated = warc["warc-payload-digest"].removeprefix("sha1:")
                    original = warc["warc-type"] == "response"
                    if original and payload_digest(payload) != stated:
                        raise ValueError(f"damaged record in {file} at {start}")
                    refers_to = None if original else _page(warc["warc-refers-to"])
                    rows.append((_page(warc["warc-record-id"]), len(payload) if original else int(http["content-length"]), stated, warc["warc-type"], refers_to))
            yield _batch(rows, FOUND)
        for file in files.values():
            file.close()

    ranged = wanted.repartitionByRange(tasks, "url_key", "page").sortWithinPartitions("url_key", "page")
    return ranged.mapInArrow(found, LOOKUP)


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per row, read back.

    Of records with equal payloads the one with the largest page id is the response and
    the others revisit it; rows that repeat that id with the same payload are responses,
    too. Null html is an empty payload, a null url the empty key. A null page id revisits
    a payload that has an id elsewhere; otherwise it is a response. Repeated rows come back
    repeated; an empty table gives no rows; other columns are ignored.
    """
    base = scratch_dir(spark, "warc")
    shards = write_index(write_archives(pages, base, id_col, url_col, html_col), base)
    key = F.udf(url_key, "string", useArrow=True)
    wanted = narrowed(pages, page=id_col, url=url_col).select(key("url").alias("url_key"), "page").distinct()
    return lookup(wanted, shards, base)
