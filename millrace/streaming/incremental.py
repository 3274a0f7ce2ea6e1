"""Incremental file processing with Structured Streaming.

The streaming twin of the ledger: the checkpoint remembers which files were
read, and a run with ``availableNow`` processes what is new and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.functions.text import full_match
from millrace.sources.text import parse_fields


def stream_lines(
    spark: SparkSession,
    root: str,
    *,
    line_sep: str = "\n",
    name_regex: str | None = None,
    files_per_batch: int | None = None,
    provenance: bool = False,
) -> DataFrame:
    """New lines under a growing folder as a stream of ``value`` (and ``_file_path``)."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if line_sep != "\n":
        reader = reader.option("lineSep", line_sep)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = reader.text(root)
    if name_regex:
        df = df.filter(full_match(F.col("_metadata.file_name"), name_regex))
    cols = [F.col("value")]
    if provenance:
        cols.append(F.col("_metadata.file_path").alias("_file_path"))
    return df.select(*cols)


def stream_delimited(
    spark: SparkSession, root: str, fields: Sequence[str] | T.StructType | str, sep: str = ",", regex: bool = False,
    **options,
) -> DataFrame:
    return parse_fields(stream_lines(spark, root, **options), fields, sep, regex)


class _Rows(StreamingQueryListener):
    """Rows read by one run of a query, over all its portions (Spark's own progress list holds only the last ones)."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, Event] = {}

    def onQueryStarted(self, event):  # noqa: N802
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event):  # noqa: N802
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.ended.setdefault(str(event.runId), Event()).set()


#: Seconds to wait for a finished query's last event.
EVENTS_AFTER = 30.0


def _counted(stream: DataFrame, start: Callable[[], StreamingQuery]) -> int:
    """Run a query to its end; events of a query arrive in order, its end last."""
    spark, seen = stream.sparkSession, _Rows()
    spark.streams.addListener(seen)
    try:
        query = start()
        query.awaitTermination()
        run = str(query.runId)
        if seen.ended.setdefault(run, Event()).wait(EVENTS_AFTER):
            return seen.rows.get(run, 0)
        # Spark drops listener events when its queue is full; the query's own last reports then tell what it read.
        told = {r["batchId"]: r["numInputRows"] for r in query.recentProgress}
        return max(sum(told.values()), seen.rows.get(run, 0))
    finally:
        spark.streams.removeListener(seen)


def append_available(stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> int:
    """Process everything new into a file sink, exactly once; returns the rows read."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return _counted(stream, lambda: writer.start(target))


def convert_available(
    stream: DataFrame, convert: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, fmt: str = "parquet"
) -> int:
    """Run a batch transformation (also a group-by) on each new portion; returns the rows read.

    Each portion goes to ``<target>/batch=<n>`` and overwrites that folder, so
    a portion repeated after a failure leaves the same result.
    """

    def write(batch: DataFrame, number: int) -> None:
        convert(batch).write.format(fmt).mode("overwrite").save(f"{target.rstrip('/')}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return _counted(stream, writer.start)
