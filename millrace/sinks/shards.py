"""Hash-sharded outputs."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.slots import int_slot, segments, shard_of, string_slot
from millrace.functions.text import field
from millrace.operators.rowops import REASON, VALID, mark_valid, rejected_rows, valid_rows
from millrace.session import open_writers, scratch_path
from millrace.sinks.jdbc import write_table
from millrace.sources.jdbc import Database

NULL_KEY = "null partition key"
#: Shards written at the same time.
WRITERS = 8


@dataclass(frozen=True)
class Sharding:
    """``kind`` int or string; ``counts`` and ``lengths`` cut the 1024 slots into shards."""

    column: str
    kind: str
    counts: Sequence[int]
    lengths: Sequence[int]
    hash_slice: str = "0:8"

    @property
    def size(self) -> int:
        return len(segments(list(self.counts), list(self.lengths)))

    def has_key(self) -> Column:
        c = field(self.column)
        return (c.try_cast("bigint") if self.kind == "int" else c).isNotNull()

    def shard(self) -> Column:
        c = field(self.column)
        slot = int_slot(c) if self.kind == "int" else string_slot(c, self.hash_slice)
        return shard_of(slot, list(self.counts), list(self.lengths))


def with_shard(df: DataFrame, sharding: Sharding, name: str = "_shard") -> DataFrame:
    """Shard number per row; a null key would be shard 0."""
    return df.withColumn(name, sharding.shard())


def reject_null_keys(df: DataFrame, sharding: Sharding) -> DataFrame:
    """Rows without a key are rejected, in every kind of sharded write."""
    df = mark_valid(df)
    has_key = sharding.has_key()
    return df.withColumns(
        {VALID: field(VALID) & has_key, REASON: F.coalesce(field(REASON), F.when(~has_key, F.lit(NULL_KEY)))}
    )


def shard_counts(df: DataFrame, sharding: Sharding) -> DataFrame:
    return (
        with_shard(df, sharding)
        .groupBy(F.col("_shard").alias("shard"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def file_values(df: DataFrame) -> list[Column]:
    """Values as the sharded text files hold them: dates to the second, fractions
    with one to six decimals and no leading zero."""
    out = []
    for f in df.schema.fields:
        c = field(f.name)
        kind = f.dataType.typeName()
        if kind in ("double", "float"):
            c = F.call_function("format_number", c, F.lit(".######"))
        elif kind in ("timestamp", "timestamp_ntz", "date"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.cast("string").alias(f.name))
    return out


def _with_key(df: DataFrame, sharding: Sharding, reject_sink: Callable[[DataFrame], None]) -> DataFrame:
    """Rows with a key; the others go to the reject sink with their reason."""
    marked = reject_null_keys(df, sharding)
    reject_sink(rejected_rows(marked))
    return valid_rows(marked).select(*[field(c) for c in df.columns if c not in (VALID, REASON)])


def _kept_at(place: str, mode: str = "errorifexists") -> Callable[[DataFrame], None]:
    """Reject sink of a write that names none: a table at ``place``, with a warning, if there are rejects."""

    def sink(rejected: DataFrame) -> None:
        if not rejected.isEmpty():
            rejected.write.mode(mode).parquet(place)
            warnings.warn(f"rows with a {NULL_KEY} are in {place}", stacklevel=4)

    return sink


def write_shard_files(
    df: DataFrame, sharding: Sharding, path: str, *, sep: str = ",", names: Mapping[int, str] | None = None,
    mode: str = "errorifexists", rebalance: bool = True, reject_sink: Callable[[DataFrame], None] | None = None,
) -> None:
    """One folder per shard, ``<path>/_shard=<name>``; a large shard is spread over several files.

    Without ``rebalance`` nothing is shuffled and every task writes its own file per shard.
    Rows without a key go to ``reject_sink`` with their reason, by default a table ``<path>_rejected``.
    """
    beside = _kept_at(path.rstrip("/") + "_rejected", mode)
    keyed = with_shard(_with_key(df, sharding, reject_sink or beside), sharding)
    shard = F.col("_shard")
    if names:
        pairs = [x for k, v in names.items() for x in (F.lit(k), F.lit(v))]
        shard = F.coalesce(F.try_element_at(F.create_map(*pairs), shard), shard.cast("string"))
    line = F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in file_values(df)])
    lines = keyed.select(line.alias("value"), shard.alias("_shard"))
    if rebalance:
        lines = lines.hint("rebalance", F.col("_shard"))
    with open_writers(df.sparkSession, min(sharding.size, 32)):
        lines.write.mode(mode).partitionBy("_shard").text(path)


def write_shard_tables(
    df: DataFrame, sharding: Sharding, databases: Sequence[Database], table: str,
    reject_sink: Callable[[DataFrame], None] | None = None, **write_options,
) -> dict[int, int]:
    """Each shard's rows to its own database; returns the rows written per shard.

    Rows without a key go to ``reject_sink`` with their reason, by default a table in the scratch folder, with a warning.

    The routed rows are written once to a staging table in the shared scratch
    folder, partitioned by shard.  Each database then reads its own folder, so
    the input is not recomputed per shard and a lost executor only repeats a
    small read.
    """
    if len(databases) != sharding.size:
        raise ValueError(f"{sharding.size} shards but {len(databases)} databases")
    spark = df.sparkSession
    staged = scratch_path(spark, "shards") + "/rows"
    aside = _kept_at(scratch_path(spark, "shards") + "/rejected")
    keyed = with_shard(_with_key(df, sharding, reject_sink or aside), sharding)
    with open_writers(spark, min(sharding.size, 8)):
        keyed.write.partitionBy("_shard").parquet(staged)
    rows = spark.read.schema(keyed.schema).parquet(staged)
    counts = {r["_shard"]: r["count"] for r in rows.groupBy("_shard").count().collect()}
    def write(i: int) -> None:
        write_table(rows.filter(F.col("_shard") == i).drop("_shard"), databases[i], table, **write_options)

    # One Spark job per shard, several at a time, as each waits on its own database.
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, [i for i in range(len(databases)) if counts.get(i)]))
    return {i: counts.get(i, 0) for i in range(len(databases))}
