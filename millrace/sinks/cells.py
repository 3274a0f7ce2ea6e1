"""Wide-column sinks: put, bulk files and delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.cells import CellColumn, delete_rows, region_of, row_key, scan, sort_for_bulk, to_cells
from millrace.operators.project import unique_key
from millrace.sinks.keyed import KeyedTable
from millrace.sources.file_index import FileIndex


def put(
    df: DataFrame, path: str, key_rule: str, layout: Sequence[CellColumn], ts: Column, *, sep: str = ",",
    unique: bool = False, mode: str = "append",
) -> None:
    """Rows as cells appended to a cell table; a row without key is skipped.

    No shuffle: cells are written where the rows are.  ``unique`` gives every
    row a key of its own.
    """
    key = row_key(key_rule, df)
    to_cells(df, unique_key(key) if unique else key, layout, ts, sep).write.mode(mode).parquet(path)


def write_bulk(
    cells: DataFrame, path: str, partitions: int | None = None, mode: str = "errorifexists", splits: Sequence[str] | None = None,
    index: bool = True, bloom: bool = False,
) -> None:
    """Sorted cell files, one set per key range, with their index (``read_bulk`` opens only files that can hold a key).

    ``splits`` are the target's own split points: each of its ranges gets files of its own, in folders ``region=<number>``,
    and a range with most of the cells is cut further by sampled ranges below it.  Ranges of sorted files tell which
    file can hold a key; ``bloom`` also spares reads of absent keys, for another pass over the keys.
    """
    if splits is None:
        sort_for_bulk(cells, partitions).write.mode(mode).parquet(path)
    else:
        placed = cells.withColumn("region", region_of(F.col("row_key"), splits))
        sort_for_bulk(placed, partitions, first="region").write.mode(mode).partitionBy("region").parquet(path)
    if index:
        bulk_index(cells.sparkSession, path, splits is not None).update(bloom)


def bulk_index(spark: SparkSession, path: str, regions: bool = False) -> FileIndex:
    """The index of cell files by row key and time."""
    return FileIndex(spark, path, "row_key", ["ts"], depth=int(regions))


def read_bulk(
    spark: SparkSession, path: str, *, row_keys: Sequence[str] | None = None, start_row: str | None = None, stop_row: str | None = None,
    min_ts=None, max_ts=None, at_ts=None, regions: bool = False, **conditions,
) -> DataFrame:
    """``operators.cells.scan`` over bulk files, opening only those whose zone map and Bloom filter let the rows pass.

    ``row_keys`` asks for single rows.  Files written by others, which have no index entry, are read as well.
    """
    if at_ts is not None:
        times = (at_ts, None)
    else:
        times = (min_ts, max_ts)
    index = bulk_index(spark, path, regions)
    names = index.candidates(row_keys, start_row, stop_row, {"ts": times} if any(t is not None for t in times) else None)
    if names:
        cells = index.open(names)
    else:
        cells = index.open(index.files()[:1]).limit(0)
    if row_keys is not None:
        cells = cells.where(F.col("row_key").isin(*row_keys) if row_keys else F.lit(False))
    cells = cells.select("row_key", "family", "qualifier", "ts", "value")
    return scan(cells, start_row=start_row, stop_row=stop_row, min_ts=min_ts, max_ts=max_ts, at_ts=at_ts, **conditions)


def delete(cells: DataFrame, df: DataFrame, key_rule: str) -> DataFrame:
    """Cells without the rows that ``df`` names by the key rule."""
    return delete_rows(cells, _named(df, key_rule))


def delete_in(cells: KeyedTable, df: DataFrame, key_rule: str) -> int:
    """Delete the rows that ``df`` names from a cell table that is kept by ``row_key``; untouched files stay."""
    return cells.delete(_named(df, key_rule))


def _named(df: DataFrame, key_rule: str) -> DataFrame:
    return df.select(row_key(key_rule, df).alias("row_key")).filter(F.col("row_key").isNotNull())
