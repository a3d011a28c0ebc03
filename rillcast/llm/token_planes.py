"""Token ids in files of shuffled planes (operator 2).

A file holds, after a magic number, the chunks: each is a block of a fixed
number of ids (the last one may be shorter), taken apart into 4 byte planes or
32 bit planes, every plane one zstandard frame. Behind the chunks stands the
index: offset, number of ids and plane sizes of each chunk, and id, presence
and length of each document; then the index' offset and the magic number.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillcast.llm.storage import new_folder, open_input, open_output
from rillcast.llm.token_counts import BATCH_BYTES, LONG_BYTES, balanced, pieces
from rillcast.sources.staged import stage

MAGIC = b"IDPLANE1"
TAIL = struct.Struct("<QQ8s")
BLOCK = 1 << 16
INDEX_SCHEMA = "part int, file string, n_docs long, n_ids long"


def to_planes(ids: np.ndarray, kind: str) -> np.ndarray:
    """Planes of ids, one per row: byte or bit k of all ids, one after another."""
    columns = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return np.ascontiguousarray(columns.T)
    bits = np.unpackbits(columns, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int, kind: str) -> np.ndarray:
    if kind == "bit":
        bits = np.unpackbits(planes, axis=1, count=n, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class PlaneWriter:
    """Writes ids as they come; holds one block of ids and the documents' lengths."""

    def __init__(self, stream, kind: str = "byte", block: int = BLOCK, level: int = 1):
        if kind not in ("byte", "bit"):
            raise ValueError("planes are of kind byte or bit")
        self.stream, self.kind, self.block = stream, kind, block
        self.packer = zstandard.ZstdCompressor(level=level)
        self.held, self.n_held, self.n_ids, self.at = [], 0, 0, len(MAGIC)
        self.chunks: list[tuple[int, int, list[int]]] = []
        self.doc_ids: list[np.ndarray] = []
        self.present: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        stream.write(MAGIC)

    def _chunk(self, ids: np.ndarray) -> None:
        frames = [self.packer.compress(p) for p in to_planes(ids, self.kind)]
        self.chunks.append((self.at, len(ids), [len(f) for f in frames]))
        for f in frames:
            self.stream.write(f)
            self.at += len(f)

    def ids(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block:
            held = np.concatenate(self.held)
            whole = len(held) // self.block * self.block
            for a in range(0, whole, self.block):
                self._chunk(held[a : a + self.block])
            self.held, self.n_held = [held[whole:]], len(held) - whole

    def documents(self, doc_ids: np.ndarray, present: np.ndarray, lengths: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.present.append(present)
        self.lengths.append(lengths)

    def close(self) -> int:
        """Write what is left and the index; returns the number of documents."""
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        columns = [np.concatenate([np.empty(0, kind), *parts]) for kind, parts in (("<i8", self.doc_ids), ("u1", self.present), ("<i8", self.lengths))]
        head = json.dumps({"kind": self.kind, "block": self.block, "chunks": self.chunks, "n_docs": len(columns[0])}).encode()
        body = self.packer.compress(struct.pack("<Q", len(head)) + head + b"".join(c.tobytes() for c in columns))
        self.stream.write(body)
        self.stream.write(TAIL.pack(self.at, len(body), MAGIC))
        return len(columns[0])


class PlaneFile:
    """Reads a file of planes by its index, any range of ids at a time."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        at, length, magic = TAIL.unpack(self._bytes(size - TAIL.size, TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of id planes")
        body = zstandard.ZstdDecompressor().decompress(self._bytes(at, length))
        (n,) = struct.unpack_from("<Q", body)
        head = json.loads(body[8 : 8 + n])
        self.kind, self.block, self.chunks, docs = head["kind"], head["block"], head["chunks"], head["n_docs"]
        self.doc_ids = np.frombuffer(body, "<i8", docs, 8 + n)
        self.present = np.frombuffer(body, "u1", docs, 8 + n + 8 * docs)
        self.lengths = np.frombuffer(body, "<i8", docs, 8 + n + 9 * docs)

    def _bytes(self, at: int, length: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(length)

    def chunk(self, k: int) -> np.ndarray:
        at, n, sizes = self.chunks[k]
        data, planes, a = self._bytes(at, sum(sizes)), [], 0
        for size in sizes:
            planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[a : a + size]), np.uint8))
            a += size
        return from_planes(np.stack(planes), n, self.kind)

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids start to start + n, from the chunks that hold them."""
        if n <= 0:
            return np.empty(0, "<u4")
        first, last = start // self.block, (start + n - 1) // self.block
        ids = np.concatenate([self.chunk(k) for k in range(first, last + 1)])
        return ids[start - first * self.block :][:n]


def write_planes(
    docs: DataFrame, path: str, folder: str | None = None, end_id: int | None = 2, kind: str = "byte", block: int = BLOCK,
) -> DataFrame:
    """Encode all texts and write their ids in ascending doc_id order; returns the table of files.

    The texts are dealt by ranges of doc_id (equal ids further by a digest of
    the text), one file per range, so reading the files by ``part`` gives the
    global order. Every attempt of a task writes a file of its own name and
    only the returned names count: a lost task leaves nothing half-written in
    the result. Memory holds one batch and the lengths of a file's documents.

    Null texts count as empty (only the end id); null doc_ids come first and
    are kept; repeated rows are written as often as they occur; an empty table
    gives no files; other columns are ignored.
    """
    folder = folder or new_folder(docs.sparkSession, "planes")

    def write(batches) -> Iterator[pa.RecordBatch]:
        from rillcast.llm.words import WordEncoder

        encoder = WordEncoder(path)
        part, writer, stream = TaskContext.get().partitionId(), None, None
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.planes"
        for doc_ids, texts, lengths in balanced(batches, BATCH_BYTES):
            if writer is None:
                stream = open_output(name)
                writer = PlaneWriter(stream, kind, block)
            end = [] if end_id is None else [end_id]
            if len(texts) == 1 and lengths[0] > LONG_BYTES:
                n = 0
                for piece in pieces(texts[0].as_py(), LONG_BYTES):
                    ids, _ = encoder.encode(pa.array([piece]))
                    writer.ids(ids)
                    n += len(ids)
                writer.ids(np.array(end, np.uint32))
                counts = np.array([n + len(end)])
            else:
                ids, counts = encoder.encode(texts)
                if end:
                    ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                writer.ids(ids)
            writer.documents(doc_ids.fill_null(0).to_numpy(), doc_ids.is_valid().to_numpy(zero_copy_only=False).astype("u1"), counts)
        if writer is not None:
            n_docs = writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name], "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())}
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return stage(dealt.select("doc_id", "text").mapInArrow(write, INDEX_SCHEMA))


def read_planes(files: DataFrame) -> DataFrame:
    """Documents of the written files: doc_id, start, n_tokens and ids_crc32, read chunk by chunk.

    ``start`` counts the ids of all documents before; the sums over files run
    on one row per file.
    """
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("base", F.coalesce(before, F.lit(0)).cast("long"))

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(row["file"]) as stream:
                    planes = PlaneFile(stream)
                    ends = np.cumsum(planes.lengths)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(planes.doc_ids, mask=planes.present == 0),
                            pa.array(row["base"] + ends - planes.lengths, pa.int64()),
                            pa.array(planes.lengths, pa.int64()),
                            pa.array(checksums(planes, ends), pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    dealt = placed.select("part", "file", "base").repartitionByRange(max(1, files.count()), "part")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def checksums(planes: PlaneFile, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each document's ids as little-endian 32-bit integers; one chunk is held at a time."""
    out = np.zeros(len(ends), np.int64)
    doc, done = 0, 0
    for k in range(len(planes.chunks)):
        data = memoryview(planes.chunk(k)).cast("B")
        n, at = len(data) // 4, 0
        while doc < len(ends) and at < n:
            upto = min(n, int(ends[doc]) - done)
            out[doc] = zlib.crc32(data[4 * at : 4 * upto], int(out[doc]))
            at = upto
            if done + upto == ends[doc]:
                doc += 1
                while doc < len(ends) and planes.lengths[doc] == 0:
                    doc += 1
        done += n
    return out
