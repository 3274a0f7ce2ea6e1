"""Harmonic packing of documents into sequences of a fixed capacity.

A piece of length ``n`` belongs to class ``k = capacity // n``: ``k`` pieces of that class fill one bin, whatever
their lengths.  Documents are cut so that a class wastes little: whole capacities first, then, while the rest would
leave more than ``waste`` of a bin empty, a piece of exactly the next reciprocal ``capacity // (k + 1)``.

Each task fills bins of its own documents.  Its unfinished bins (fewer than ``k`` pieces for each class, so a bounded
number whatever the input) go to a second pass that joins those of ``FAN_IN`` tasks, level by level, and the last
level, with at most one unfinished bin of each class in all, packs those pieces largest first into the fullest
sequence that still takes them.

Null and empty texts give one piece with the end id.  Rows with equal document ids are packed as separate documents.
Empty tables give no piece.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Emitter, bound_batches, gathered
from millrace.llm.encoding import word_encoder
from millrace.llm.packed_ids import pack, unpack
from millrace.session import open_writers, scratch_path

CAPACITY = 2048
WASTE = 1 / 64
FAN_IN = 64

_DDL = (
    "doc_id long, start long, length int, doc_tokens long, bits int, ids binary, sequence_id long, offset int, "
    "worker int, leftover boolean"
)
_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("bits", pa.int32()),
    ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int32()), ("worker", pa.int32()), ("leftover", pa.bool_()),
])


def cuts(length: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    done, rest = [capacity] * (length // capacity), length % capacity
    while rest:
        k = capacity // rest
        if k * rest >= capacity * (1 - waste):
            return [*done, rest]
        done.append(capacity // (k + 1))
        rest -= done[-1]
    return done


class _Bins:
    """Open bins of one task by class, and the output rows of the full ones."""

    def __init__(self, capacity: int, level: int):
        self.capacity, self.level = capacity, level
        self.open: dict[int, list[tuple]] = {}
        self.worker, self.made = TaskContext.get().partitionId(), 0
        self.out = Emitter(_PIECES, rows=10_000)

    def close(self, pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        """One sequence of these pieces."""
        number, at = (self.level << 56) | (self.worker << 32) | self.made, 0
        self.made += 1
        for piece in pieces:
            yield from self.out.add(*piece, number, at, self.worker, False, size=len(piece[5]))
            at += piece[2]

    def put(self, piece: tuple) -> Iterator[pa.RecordBatch]:
        k = self.capacity // piece[2]
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            yield from self.close(self.open.pop(k))

    def best_fit(self) -> Iterator[pa.RecordBatch]:
        """What is left, largest first, each piece into the fullest sequence that takes it."""
        rest = sorted((p for held in self.open.values() for p in held), key=lambda p: (-p[2], p[0] is not None, p[0] or 0, p[1]))
        bins: list[list] = []
        for piece in rest:
            fits = [b for b in bins if b[0] + piece[2] <= self.capacity]
            target = max(fits, key=lambda b: b[0], default=None)
            if target is None:
                bins.append(target := [0, []])
            target[0] += piece[2]
            target[1].append(piece)
        for _, pieces in bins:
            yield from self.close(pieces)

    def leave(self) -> Iterator[pa.RecordBatch]:
        for held in self.open.values():
            for piece in held:
                yield from self.out.add(*piece, None, None, self.worker, True, size=len(piece[5]))


def _cutter(path: str, end_id: int, capacity: int, waste: float):
    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = word_encoder(path), _Bins(capacity, 0)
        bits, end = max(encoder.bits, end_id.bit_length()), np.array([end_id], np.uint32)
        for batch in gathered(batches):
            for doc_id, own in zip(batch.column(0).to_pylist(), encoder.encode_batch(batch.column(1)), strict=True):
                ids, at = np.concatenate([own, end]), 0
                for n in cuts(len(ids), capacity, waste):
                    yield from bins.put((doc_id, at, n, len(ids), bits, pack(ids[at:at + n], bits)))
                    at += n
        yield from bins.leave()
        yield from bins.out.flush()

    return first_level


def _joiner(capacity: int, level: int, last: bool):
    def next_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _Bins(capacity, level)
        for batch in batches:
            for piece in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                yield from bins.put(piece)
        yield from bins.best_fit() if last else bins.leave()
        yield from bins.out.flush()

    return next_level


def _kept(pieces: DataFrame) -> DataFrame:
    """Write pieces with leftovers in a folder of their own, so that later levels read only those."""
    spark = pieces.sparkSession
    path = scratch_path(spark, "packing") + "/pieces"
    with open_writers(spark, 2):
        pieces.write.partitionBy("leftover").parquet(path)
    return spark.read.schema(pieces.schema).parquet(path)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, waste: float = WASTE) -> DataFrame:
    """Pieces with their packed ids, sequence and offset: the sequences themselves, one row per piece.

    The first level is one scan without an exchange, written once because full bins and leftovers both come from
    it.  Only leftovers move afterwards.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    cut = docs.select("doc_id", "text").mapInArrow(_cutter(tokenizer, end_id, capacity, waste), _DDL)
    level = _kept(cut)
    full = [level.where(~F.col("leftover"))]
    rest = level.where("leftover")
    workers = rest.agg(F.max("worker")).first()[0]
    number = 1
    while workers is not None:
        groups = -(-(workers + 1) // FAN_IN)
        dealt = rest.repartition(groups, F.expr(f"worker div {FAN_IN}")) if groups > 1 else rest.coalesce(1)
        joined = dealt.select(*_PIECES.names[:6]).mapInArrow(_joiner(capacity, number, groups == 1), _DDL)
        level = _kept(joined)
        full.append(level.where(~F.col("leftover")))
        rest = level.where("leftover")
        workers = rest.agg(F.max("worker")).first()[0]
        number += 1
    out = full[0]
    for more in full[1:]:
        out = out.union(more)
    return out.drop("worker", "leftover")


_TOLD = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, bits = batch.column("length").to_pylist(), batch.column("bits").to_pylist()
        crcs = [
            zlib.crc32(unpack(ids.as_buffer(), n, b).astype("<u4").tobytes())
            for ids, n, b in zip(batch.column("ids"), lengths, bits, strict=True)
        ]
        by_name = {"ids_crc32": pa.array(crcs, pa.int64())}
        yield pa.RecordBatch.from_arrays(
            [by_name[f.name] if f.name in by_name else batch.column(f.name).cast(f.type) for f in _TOLD], schema=_TOLD
        )


def packing_digests(packed: DataFrame) -> DataFrame:
    """Where each piece lies, and the crc32 of its ids."""
    return packed.mapInArrow(
        _digests, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
