"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path

#: Rows of one Arrow batch.  Texts are long, so Spark's 10,000 would hold hundreds of megabytes in a worker.
BATCH_ROWS = 500
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS``; a smaller setting of the session stays."""
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, so no later step computes it again.

    The copy survives lost executors, and its schema is the written one, so no file is opened to learn it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> list[bytes | None]:
    """Values of a string column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def slices(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in slices of about a megabyte, cut before ASCII white space, so that no word is cut."""
    start, end = 0, len(text)
    while end - start > size:
        cut = start + size
        while cut < end and text[cut] not in b" \t\n\r\x0b\x0c":
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def gathered(batches: Iterator[pa.RecordBatch], size: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive batches put together up to about ``size`` bytes, so that work per batch pays; one larger stays alone."""
    held, total = [], 0
    for batch in batches:
        if held and total + batch.nbytes > size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
        if batch.num_rows:
            held.append(batch)
            total += batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Emitter:
    """Collects output rows as columns and hands them on as Arrow batches of bounded rows and bytes."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, size: int = 16 << 20):
        self.schema, self.rows, self.size = schema, rows, size
        self._clear()

    def _clear(self):
        self.columns, self.held = [[] for _ in self.schema.names], 0

    def add(self, *values, size: int = 0) -> Iterator[pa.RecordBatch]:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.held += size
        if len(self.columns[0]) >= self.rows or self.held >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self._clear()


def mix(x: np.ndarray) -> np.ndarray:
    """The published splitmix64 finaliser on unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
