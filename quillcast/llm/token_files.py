"""Token ids in compressed binary files, in ascending order of document id.

A file is ``MAGIC``, the code words of its blocks one after the other, a footer (deflated
JSON), the footer's length as four little-endian bytes, and ``MAGIC`` again. The ids of all
documents of a file form one stream, cut into blocks of ``PLACES`` ids; the last block is filled
up with zeros. The footer has per document its id and number of ids, and per block the
length of its code and the crc32 of its ids as little-endian unsigned 16-bit integers.
Blocks are coded by ``range_coder`` and decode on their own. Ids must be below 65,536.

Each task writes a file under a name of its own; the manifest names those that count.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.llm import range_coder, tokens
from quillcast.llm.common import file_system, narrowed, slices
from quillcast.session import scratch_dir, written

MAGIC = b"QTC1"
#: Ids per block, and blocks coded together.
PLACES, LANES = 1024, 4096


class Writer:
    """Writes documents' ids one after the other; holds at most ``PLACES * LANES`` ids."""

    def __init__(self, out: pa.NativeFile):
        self.out = out
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self.documents: list[list] = []
        self.blocks: list[list[int]] = []
        self.total = 0
        out.write(MAGIC)

    def add(self, document: object, ids: np.ndarray) -> None:
        if len(ids) and ids.max() >= 1 << 16:
            raise ValueError("ids of 65,536 or more do not fit this format")
        self.documents.append([document, len(ids)])
        self.total += len(ids)
        ids = ids.astype("<u2")
        while len(ids):
            some = ids[: PLACES * LANES - self.waiting]
            self.pending.append(some)
            self.waiting += len(some)
            ids = ids[len(some) :]
            if self.waiting == PLACES * LANES:
                self._flush()

    def _flush(self) -> None:
        stream = np.concatenate(self.pending)
        stream = np.concatenate((stream, np.zeros(-len(stream) % PLACES, dtype="<u2"))).reshape(-1, PLACES)
        for ids, code in zip(stream, range_coder.encode(np.ascontiguousarray(stream.T)), strict=True):
            self.out.write(code)
            self.blocks.append([len(code), zlib.crc32(ids.tobytes())])
        self.pending, self.waiting = [], 0

    def close(self) -> None:
        if self.waiting:
            self._flush()
        footer = zlib.compress(json.dumps({"documents": self.documents, "blocks": self.blocks}).encode())
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()


def read(system: pafs.FileSystem, path: str) -> Iterator[tuple[object, int, np.ndarray, bool]]:
    """(document, place in the file, ids, whether the document ends here), in order.

    A document may come in parts; no more than ``PLACES * LANES`` ids are held.
    """
    with system.open_input_file(path) as file:
        size = file.size()
        (length,) = struct.unpack("<I", file.read_at(4, size - 8))
        if file.read_at(4, size - 4) != MAGIC or file.read_at(4, 0) != MAGIC:
            raise ValueError(f"{path} is not whole")
        footer = json.loads(zlib.decompress(file.read_at(length, size - 8 - length)))
        documents = iter(footer["documents"])
        document, left = next(documents, (None, 0))
        at, place = len(MAGIC), 0
        for begin in range(0, len(footer["blocks"]), LANES):
            some = footer["blocks"][begin : begin + LANES]
            data = file.read_at(sum(length for length, _ in some), at)
            codes, cut = [], 0
            for length, _ in some:
                codes.append(data[cut : cut + length])
                cut += length
            at += cut
            stream = np.ascontiguousarray(range_coder.decode(codes, PLACES).T)
            for ids, (_, crc) in zip(stream, some, strict=True):
                if zlib.crc32(ids.astype("<u2").tobytes()) != crc:
                    raise ValueError(f"damaged block in {path}")
            flat, used = stream.ravel(), 0
            while document is not None or left:
                part = flat[used : used + left]
                used += len(part)
                left -= len(part)
                yield document, place, part, not left
                place += len(part)
                if left:
                    break
                document, left = next(documents, (None, 0))


MANIFEST = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_tokens", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write(docs: DataFrame, base: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, glued: bool = False) -> DataFrame:
    """Tokenise and write all documents; returns the manifest (part, file, n_tokens), parts in order.

    Files hold ranges of (id, hash of the text), so an id that many rows share is split, too.
    """

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, glued)
        system, folder = file_system(base)
        system.create_dir(folder, recursive=True)
        name, writer = f"{uuid.uuid4().hex}.ids", None
        ending = np.array([end_id], dtype="<u4")
        for batch in slices(batches):
            writer = writer or Writer(system.open_output_stream(f"{folder}/{name}", compression=None))
            for document, ids in zip(batch.column("id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                writer.add([document], np.concatenate((np.frombuffer(ids, dtype="<u4"), ending)))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "file": name, "n_tokens": writer.total}], schema=MANIFEST)

    rows = narrowed(docs, id=id_col, text=text_col).withColumn("hash", F.xxhash64("text"))
    ranged = rows.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash").select("id", "text")
    return written(ranged.mapInArrow(filed, "part long, file string, n_tokens long"), "manifest")


def read_back(spark: SparkSession, manifest: DataFrame, base: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document; start counts the ids of all before it.

    The manifest has one row per file, as many as the writing job had tasks.
    """
    files, start = [], 0
    for row in sorted(manifest.collect(), key=lambda row: row["part"]):
        files.append((row["file"], start))
        start += row["n_tokens"]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                rows, crc, begin = [], 0, None
                for (document,), place, ids, done in read(system, f"{folder}/{file}"):
                    begin = place if begin is None else begin
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    if done:
                        rows.append({"doc_id": document, "start": first + begin, "n_tokens": place + len(ids) - begin, "ids_crc32": crc})
                        crc, begin = 0, None
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=FOUND)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=FOUND)

    named = spark.createDataFrame(files, "file string, first long").repartition(max(1, len(files)))
    return named.mapInArrow(described, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, glued: bool = False) -> DataFrame:
    """Write ``docs`` as token files and describe every document from the files.

    Documents follow each other by ascending id, null ids first; rows that share an id
    follow each other by the hash of their texts. Null and empty texts have the end id alone.
    Repeated rows come back repeated; an empty table gives no rows and no files. Other
    columns are ignored.
    """
    base = scratch_dir(spark, "token-files")
    return read_back(spark, write(docs, base, tokenizer, id_col, text_col, end_id, glued), base)
