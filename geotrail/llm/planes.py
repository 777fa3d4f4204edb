"""Operator 1: token-ID binary output with bit-plane shuffling.

``write_token_files`` encodes every text and writes the ids in ascending
``doc_id`` order as plane files; ``read_token_files`` reads them back.

File format (little-endian), one file per range partition::

    8 bytes  magic "IDPLANE1"
    blocks   each: up to ``block_ids`` ids as uint32, transposed into 4 byte planes
             (or 32 bit planes), every plane its own zstandard frame
    index    zstandard frame: uint64 table (n_blocks x (2 + planes)):
             file offset, ids in the block, compressed size of each plane
    docs     zstandard frame: int64 table (n_docs x 3): has id, doc_id, n_tokens
    trailer  8 x uint64: planes, block_ids, n_ids, n_docs, n_blocks, index offset, docs offset, docs size
    8 bytes  magic "IDPLANE1"

Token ids sit in a small range, so after the transpose the high planes are
nearly constant and the low ones compress on their own statistics. The chunk
index makes any block readable without its predecessors.

The texts are range-partitioned on ``doc_id`` (sampled bounds; the text hash
breaks ties, so repeated ids also spread) and each task streams its
documents through one block buffer: memory is one block plus the document
table of the file. A task writes under an attempt-unique name and renames;
the manifest (Parquet, Spark's commit protocol) names only files of
successful attempts, so retries and lost executors leave no wrong file in use.

Edge cases: null or empty text has only the end id; null ids sort first;
repeated rows are separate documents in text-hash order; an empty table gives
an empty manifest and no rows; texts of any length span as many blocks as needed.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geotrail.llm.common import materialize, select_docs, small_batches, text_column
from geotrail.sources.store import scratch_path

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
LEVEL = 3
BLOCK_BYTES = 8_000_000   # texts encoded at once: a word that many of them hold is looked up once


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Transpose ids into 4 byte planes or 32 bit planes (packed, least significant first)."""
    by = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "byte":
        return [p.tobytes() for p in by]
    return [np.packbits((by[b // 8] >> (b % 8)) & 1, bitorder="little").tobytes() for b in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        by = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
        return np.ascontiguousarray(by).view("<u4").reshape(-1)
    out = np.zeros(n, np.uint32)
    for b, p in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little").astype(np.uint32) << np.uint32(b)
    return out


def _file_system(uri: str):
    from pyarrow import fs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class PlaneWriter:
    """Streams documents' ids into one plane file."""

    def __init__(self, sink, block_ids: int = BLOCK_IDS, planes: str = "byte", level: int = LEVEL):
        import zstandard

        self.sink, self.block_ids, self.kind = sink, block_ids, planes
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.index: list[list[int]] = []
        self.docs: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.held = self.n_ids = self.n_docs = 0
        self.sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        """The next ids of the documents, as many as there are at hand."""
        self.n_ids += len(ids)
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            self._flush(False)

    def add_docs(self, doc_ids: pa.Array, sizes: np.ndarray) -> None:
        """The documents the ids belong to, in the same order."""
        has = doc_ids.is_valid().to_numpy(zero_copy_only=False)
        self.docs.append(np.stack([has, doc_ids.fill_null(0).to_numpy(), sizes], axis=1).astype("<i8"))
        self.n_docs += len(sizes)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for lo in range(0, end, self.block_ids):
            block = ids[lo : min(end, lo + self.block_ids)]
            frames = [self.zstd.compress(p) for p in to_planes(block, self.kind)]
            self.index.append([self.at, len(block), *map(len, frames)])
            for f in frames:
                self.sink.write(f)
                self.at += len(f)
        self.parts, self.held = ([ids[end:].copy()], len(ids) - end) if end < len(ids) else ([], 0)

    def close(self) -> None:
        self._flush(True)
        n_planes = 4 if self.kind == "byte" else 32
        index = self.zstd.compress(np.array(self.index, "<u8").reshape(-1, 2 + n_planes).tobytes())
        docs = self.zstd.compress(np.concatenate([np.zeros((0, 3), "<i8"), *self.docs]).tobytes())
        self.sink.write(index)
        self.sink.write(docs)
        tail = (n_planes, self.block_ids, self.n_ids, self.n_docs, len(self.index), self.at, self.at + len(index), len(docs))
        self.sink.write(struct.pack("<8Q", *tail) + MAGIC)


class PlaneReader:
    """Random access to the blocks of one plane file through its chunk index."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        tail = self._read(size - 72, 72)
        if tail[64:] != MAGIC:
            raise ValueError("not a plane file")
        planes, self.block_ids, self.n_ids, n_docs, n_blocks, index_at, docs_at, docs_size = struct.unpack("<8Q", tail[:64])
        width = 2 + planes
        self.index = np.frombuffer(self.zstd.decompress(self._read(index_at, docs_at - index_at), max_output_size=max(1, n_blocks * width * 8)), "<u8").reshape(-1, width)
        self.docs = np.frombuffer(self.zstd.decompress(self._read(docs_at, docs_size), max_output_size=max(1, n_docs * 24)), "<i8").reshape(-1, 3)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(int(at))
        return self.source.read(int(n))

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = (int(x) for x in self.index[k])
        raw, planes, lo = self._read(at, sum(sizes)), [], 0
        width = n if len(sizes) == 4 else (n + 7) // 8
        for s in sizes:
            planes.append(self.zstd.decompress(raw[lo : lo + s], max_output_size=max(1, width)))
            lo += s
        return from_planes(planes, n)

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, n_tokens, pieces of its ids) in file order; a piece never spans blocks."""
        state = {"k": -1, "block": np.zeros(0, np.uint32), "pos": 0}

        def pieces(n: int) -> Iterator[np.ndarray]:
            while n:
                if state["pos"] == len(state["block"]):
                    state["k"] += 1
                    state["block"], state["pos"] = self.block(state["k"]), 0
                part = state["block"][state["pos"] : state["pos"] + n]
                state["pos"] += len(part)
                n -= len(part)
                yield part

        for has, doc_id, n in self.docs:
            yield (int(doc_id) if has else None), int(n), pieces(int(n))


def doc_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(doc_id, text) columns of some batches at a time, joined while their texts stay under ``BLOCK_BYTES``."""
    held, size = [], 0
    for batch in batches:
        texts = text_column(batch)
        if held and size + texts.nbytes > BLOCK_BYTES:
            yield tuple(map(pa.concat_arrays, zip(*held)))
            held, size = [], 0
        held.append((batch.column("doc_id"), texts))
        size += texts.nbytes
    if held:
        yield tuple(map(pa.concat_arrays, zip(*held)))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, block_ids: int = BLOCK_IDS, planes: str = "byte"
) -> DataFrame:
    """Encode ``doc_id, text`` rows into plane files below ``folder``; returns the manifest.

    Manifest: ``shard, path, n_ids, n_docs, n_bytes`` -- one row per file, shards in ``doc_id`` order.
    """
    from geotrail.llm.wordtable import encode_column, library_table

    small_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        sink = writer = None
        for doc_ids, texts in doc_blocks(batches):
            if writer is None:
                table = library_table(tokenizer_path)
                system, at = _file_system(f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.idp")
                system.create_dir(at.rsplit("/", 1)[0], recursive=True)
                sink = system.open_output_stream(at + ".tmp")
                writer = PlaneWriter(sink, block_ids, planes)
            sizes = [np.zeros(0, np.int64)]
            for ids, ended in encode_column(texts, table, end_id):
                writer.add(ids)
                sizes.append(ended)
            writer.add_docs(doc_ids, np.concatenate(sizes))
        if writer is not None:
            writer.close()
            sink.close()
            size = system.get_file_info(at + ".tmp").size
            system.move(at + ".tmp", at)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [at], "n_ids": [writer.n_ids], "n_docs": [writer.n_docs], "n_bytes": [size]}
            )

    ordered = docs.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(write, "shard long, path string, n_ids long, n_docs long, n_bytes long")


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32, shard``."""
    n_shards = max(1, manifest.count())
    # one row per file: the running total over shards is the first id's position of each file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, _ = _file_system(folder)
                with system.open_input_file(row["path"]) as source:
                    out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "shard": []}
                    at = row["base"]
                    for doc_id, n, pieces in PlaneReader(source, row["n_bytes"]).documents():
                        crc = 0
                        for part in pieces:
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        for k, v in zip(out, (doc_id, at, n, crc, row["shard"])):
                            out[k].append(v)
                        at += n
                        if len(out["start"]) >= 20_000:
                            yield _digest(out)
                            out = {k: [] for k in out}
                    if out["start"]:
                        yield _digest(out)

    # a fixed partition number, which adaptive execution leaves alone: the rows are tiny, the files are not
    return placed.repartitionByRange(n_shards, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"
    )


def _digest(out: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))


def token_file_digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int, **options) -> DataFrame:
    """Write the files below the shared checkpoint folder, read them back, return the per-document digest."""
    folder = scratch_path(spark, "token-files")
    manifest = materialize(write_token_files(select_docs(docs), folder, tokenizer_path, end_id, **options), "token-manifest")
    return read_token_files(spark, manifest, folder)
