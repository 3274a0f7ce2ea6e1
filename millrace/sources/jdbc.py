"""JDBC scans: each strategy is a list of predicates or queries for Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import collect_small
from millrace.sources.quantiles import quantile_query
from millrace.sources.ranges import bind, hash_predicates, kind_of, point_predicates, range_predicates


@dataclass(frozen=True)
class Database:
    """Connection of a JDBC source or sink; properties stay out of logs and reprs."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    fetch_size: int = 10_000
    session_init: str | None = None

    def options(self) -> dict[str, str]:
        out = {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}
        if self.session_init:
            out["sessionInitStatement"] = self.session_init
        return out


def _relation(table_or_query: str) -> str:
    """Table name, or a query as a derived table; ``$CONDITIONS`` is filled by Spark's predicates."""
    text = table_or_query.strip().rstrip(";")
    if text.lower().startswith(("select", "with")):
        return f"({text.replace('$CONDITIONS', '1 = 1')}) src"
    return text


def read_table(
    spark: SparkSession, db: Database, table_or_query: str, predicates: Sequence[str] = (), where: str | None = None
) -> DataFrame:
    """One partition per predicate; ``where`` is pushed to the database by Spark."""
    properties = {k: v for k, v in db.options().items() if k != "url"}
    relation = _relation(table_or_query)
    if predicates:
        df = spark.read.jdbc(db.url, relation, predicates=list(predicates), properties=properties)
    else:
        df = spark.read.jdbc(db.url, relation, properties=properties)
    return df.where(where) if where else df


def read_by_range(
    spark: SparkSession,
    db: Database,
    table_or_query: str,
    column: str,
    kind: str | None,
    partitions: int,
    bounds: tuple | None = None,
    where: str | None = None,
    dialect: str = "ansi",
    even: bool = False,
) -> DataFrame:
    """Ranges between min and max of the split column, found by one aggregate query.

    Without ``kind`` the type of the bounds decides.  With ``even`` the source gives the points where a range's share
    of the rows ends, in its own order: right for skewed keys and for text under any collation.
    """
    if even:
        found = read_table(spark, db, quantile_query(_relation(table_or_query), column, partitions))
        points = [r[0] for r in collect_small(found, partitions, "split points")]
        return read_table(spark, db, table_or_query, point_predicates(column, points, dialect), where)
    if bounds is None:
        source = read_table(spark, db, f"select min({column}) lo, max({column}) hi from {_relation(table_or_query)}")
        bounds = tuple(collect_small(source, 1, "bounds")[0])
    kind = kind or kind_of(bounds[1])
    return read_table(
        spark, db, table_or_query, range_predicates(column, kind, *bounds, partitions, dialect), where
    )


def read_by_hash(
    spark: SparkSession, db: Database, table_or_query: str, column: str, partitions: int, where: str | None = None
) -> DataFrame:
    """Even shares of the rows by key remainder (in place of counting and paging)."""
    return read_table(spark, db, table_or_query, hash_predicates(column, partitions), where)


def read_partitions(spark: SparkSession, db: Database, table: str, names: Sequence[str], query: str | None = None):
    """One read per named partition: ``t partition(p)``, or a query with ``{SRC_TABLE}``."""
    relations = [f"{table} partition({p})" for p in names]
    queries = [query.replace("{SRC_TABLE}", r) for r in relations] if query else [f"select * from {r}" for r in relations]
    return _union([read_table(spark, db, q) for q in queries])


def read_parameterised(
    spark: SparkSession, db: Database, relation: str, condition: str, parameters: DataFrame | Sequence[Mapping]
) -> DataFrame:
    """The rows of ``relation`` that meet ``condition`` for each parameter row, one split per row.

    ``condition`` holds ``{NAME}`` macros or ``?`` marks.  Rows come to the
    driver partition by partition and stay there only as the text of their
    split, as every split of a database read does.
    """
    if isinstance(parameters, DataFrame):
        parameters = (r.asDict() for r in parameters.toLocalIterator())
    return read_table(spark, db, relation, [bind(condition, p) for p in parameters])


def read_shards(
    spark: SparkSession, shards: Mapping[str, Database], table_or_query: str, shard_column: str = "_shard", **ranges
) -> DataFrame:
    """The same query on every shard, appended; ``ranges`` split each shard's read further."""
    frames = []
    for name, db in shards.items():
        df = read_by_range(spark, db, table_or_query, **ranges) if ranges else read_table(spark, db, table_or_query)
        frames.append(df.withColumn(shard_column, F.lit(name)))
    return _union(frames)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("nothing to read")
    return reduce(lambda a, b: a.unionByName(b), frames)
