"""Latest row per key, row windows and anti/semi selections on keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.text import field
from millrace.session import scratch_path


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns of every key.

    Equal ``order`` values are decided by the remaining columns.  Asking for
    rank 1 only lets Spark keep one candidate per key and task before the
    shuffle (a window group limit), so a hot key arrives as one row per task
    and is never sorted as one group.
    """
    unordered = (T.MapType, T.VariantType)
    rest = [
        f.name for f in df.schema.fields
        if f.name not in keys and f.name not in order and not isinstance(f.dataType, unordered)
    ]
    ranked = Window.partitionBy(*[field(k) for k in keys]).orderBy(*[field(c).desc() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def without(df: DataFrame, seen: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key is not in ``seen``.

    ``seen`` is reduced to distinct keys first; whether it is broadcast is
    decided by Spark from its measured size, and a hot key on the left side is
    split by adaptive skew handling.
    """
    return _select(df, seen, keys, "left_anti", null_safe)


def within(df: DataFrame, seen: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key is in ``seen``."""
    return _select(df, seen, keys, "left_semi", null_safe)


def _select(df: DataFrame, seen: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    right = seen.select(*[field(k) for k in keys]).distinct()
    if not null_safe:
        return df.join(right, list(keys), how)
    renamed = right.toDF(*[f"_k{i}" for i in range(len(keys))])
    cond: Column | None = None
    for i, k in enumerate(keys):
        one = field(k).eqNullSafe(F.col(f"_k{i}"))
        cond = one if cond is None else cond & one
    return df.join(renamed, cond, how)


def row_window(
    df: DataFrame, order: Sequence[str | Column], limit: int, offset: int = 0, deep: bool = False
) -> DataFrame:
    """Rows ``offset .. offset + limit`` of a total order (a page, not a way to split a table).

    Lazy, it is Spark's top-k, which brings the page and all rows before it to
    one task.  For a ``deep`` page, which the caller states, the table is sorted
    by ranges into the shared scratch folder, each row gets its number within
    its range, and the numbers of the ranges are added up, so only the page
    itself is read.
    """
    if not deep:
        page = df.orderBy(*order)
        return (page.offset(offset) if offset else page).limit(limit)
    spark = df.sparkSession
    path = scratch_path(spark, "page") + "/rows"
    within_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_range": F.spark_partition_id(), "_at": within_range})
        .write.parquet(path)
    )
    stored = spark.read.parquet(path)
    # one number per range, of which there are at most spark.sql.shuffle.partitions
    counts = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    start, wanted = 0, []
    for number, n in sorted(tuple(r) for r in counts):
        low, high = max(offset - start, 0), min(offset + limit - start, n)
        if low < high:
            wanted.append((F.col("_range") == number) & (F.col("_at") >= low) & (F.col("_at") < high))
        start += n
    if not wanted:
        return stored.limit(0).drop("_range", "_at")
    page = stored.filter(reduce(lambda a, b: a | b, wanted))
    return page.orderBy("_range", "_at").drop("_range", "_at")
