"""Token ids in fixed-width bit-packed segments with block offsets.

Each row of the output table is one self-contained segment of consecutive documents; Spark writes the rows, so
any store Spark reaches holds them and its commit protocol covers retries and lost executors.

Segment (little-endian)::

    "BITP" | u16 version | u16 bits | u32 documents | u32 blocks | u64 ids
    i64 x documents            document ids (``_NO_ID`` for null)
    u64 x (documents + 1)      first id of each document within the segment, then the number of ids
    u64 x (blocks + 1)         byte offset of each block within the data, then its end
    data                       blocks of ``BLOCK`` ids, each id in ``bits`` bits, each block byte-aligned

Order: ascending document id (null first), equal ids by text hash and text.  Empty tables give no segment, a null or
empty text only its end id.  Columns beside ``doc_id`` and ``text`` are not read, so their names don't matter.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Emitter, bound_batches, gathered
from millrace.llm.encoding import word_encoder
from millrace.session import scratch_path

BLOCK = 4096
SEGMENT_IDS = 1 << 20
_HEAD = "<4sHHIIQ"
_NO_ID = -(1 << 63)
_SEGMENTS = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])
_SEGMENTS_DDL = "part int, segment int, before long, n_ids long, payload binary"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, lowest bit first, padded to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(each.ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes, without a loop over ids."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    held = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    at = np.arange(count, dtype=np.int64) * bits
    byte = at >> 3
    wide = np.zeros(count, np.uint64)
    for i in range((bits + 14) // 8):
        wide |= held[byte + i].astype(np.uint64) << np.uint64(8 * i)
    return ((wide >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def write_segment(doc_ids: list[int | None], docs: list[np.ndarray], bits: int) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    blocks = [pack(ids[i:i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    starts = np.cumsum([0, *map(len, docs)]).astype("<u8")
    ends = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    named = np.array([_NO_ID if d is None else d for d in doc_ids], "<i8")
    return b"".join([struct.pack(_HEAD, b"BITP", 1, bits, len(docs), len(blocks), len(ids)), named.tobytes(), starts.tobytes(), ends.tobytes(), *blocks])


class Segment:
    """Random access to one segment: only the blocks that hold the asked ids are unpacked."""

    def __init__(self, payload: bytes):
        magic, version, self.bits, n, blocks, self.n_ids = struct.unpack_from(_HEAD, payload)
        if (magic, version) != (b"BITP", 1):
            raise ValueError("not a packed segment")
        at = struct.calcsize(_HEAD)
        self.doc_ids = np.frombuffer(payload, "<i8", n, at)
        self.starts = np.frombuffer(payload, "<u8", n + 1, at := at + 8 * n).astype(np.int64)
        self.offsets = np.frombuffer(payload, "<u8", blocks + 1, at := at + 8 * (n + 1)).astype(np.int64)
        self.data = memoryview(payload)[at + 8 * (blocks + 1):]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive) of the segment."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (end - 1) // BLOCK
        parts = [
            unpack(self.data[self.offsets[b]:self.offsets[b + 1]], min(BLOCK, self.n_ids - b * BLOCK), self.bits)
            for b in range(first, last + 1)
        ]
        return np.concatenate(parts)[start - first * BLOCK:end - first * BLOCK]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _writer(path: str, end_id: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(path), TaskContext.get().partitionId()
        out = Emitter(_SEGMENTS, rows=8)
        names, docs, held, before, number = [], [], 0, 0, 0
        end = np.array([end_id], np.uint32)
        bits = max(encoder.bits, end_id.bit_length())
        for batch in gathered(batches):
            for doc_id, own in zip(batch.column(0).to_pylist(), encoder.encode_batch(batch.column(1)), strict=True):
                ids = np.concatenate([own, end])
                names.append(doc_id)
                docs.append(ids)
                held += len(ids)
                if held >= SEGMENT_IDS:
                    payload = write_segment(names, docs, bits)
                    yield from out.add(part, number, before, held, payload, size=len(payload))
                    names, docs, held, before, number = [], [], 0, before + held, number + 1
        if docs:
            yield from out.add(part, number, before, held, write_segment(names, docs, bits))
        yield from out.flush()

    return segments


def write_packed(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encode every text and write its ids, then ``end_id``, as segments in ascending ``doc_id`` order.

    One exchange deals the documents out by ranges of (doc_id, text hash), so a document id that many rows share
    is split as well; a task holds one segment at a time.  ``tokenizer`` names a file every executor has.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    ordered = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text")
    ordered.select("doc_id", "text").mapInArrow(_writer(tokenizer, end_id), _SEGMENTS_DDL).write.mode("overwrite").parquet(path)


_TOLD = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Emitter(_TOLD)
    for batch in batches:
        for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held = Segment(payload.as_py())
            for i, doc_id in enumerate(held.doc_ids.tolist()):
                ids = held.document(i)
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                yield from out.add(None if doc_id == _NO_ID else doc_id, base + int(held.starts[i]), len(ids), crc)
    yield from out.flush()


def read_packed(spark, path: str) -> DataFrame:
    """Segments with ``base``, the number of ids in all segments before each.

    The running total goes over one row per written part, not per document.  That table has at most
    ``spark.sql.shuffle.partitions`` rows (the write's tasks) of two numbers, so it is broadcast and no payload moves.
    """
    files = spark.read.schema(_SEGMENTS_DDL).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    run = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.join(F.broadcast(parts.select("part", run.alias("base"))), "part").select(
        (F.col("base") + F.col("before")).alias("base"), "part", "segment", "n_ids", "payload"
    )


def packed_digests(spark, path: str) -> DataFrame:
    """Per document, from the files: its first id's position, number of ids and crc32 of the ids."""
    bound_batches(spark)
    return read_packed(spark, path).select("base", "payload").mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed_files(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write to the shared scratch folder and read the digests back."""
    path = scratch_path(docs.sparkSession, "packed-ids")
    write_packed(docs, path, tokenizer, end_id)
    return packed_digests(docs.sparkSession, path)
