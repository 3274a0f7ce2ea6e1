"""Accepted and rejected rows, counted and written in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import field
from millrace.operators.rowops import REASON, VALID, is_valid, rejected_rows, valid_rows
from millrace.session import open_writers


@dataclass(frozen=True)
class RunCounts:
    """Run totals of the source side, and the rows given to the sink.

    ``input == output + filtered``; a projection stores ``output`` rows, a
    group-by one row per group.  ``stored`` is None in a validate-only run.
    """

    input: int
    output: int
    filtered: int
    stored: int | None = None


def count_rows(marked: DataFrame) -> DataFrame:
    """Validate-only run: input, accepted and rejected rows, nothing stored."""
    ok = is_valid().cast("bigint")
    return marked.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.coalesce(F.sum(ok), F.lit(0)).cast("bigint").alias("valid_rows"),
        F.coalesce(F.sum(1 - ok), F.lit(0)).cast("bigint").alias("rejected_rows"),
    )


def write_split(marked: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", **options) -> None:
    """Accepted and rejected rows to ``<path>/_valid=true`` and ``<path>/_valid=false``.

    One write, so the input is computed once and nothing is cached or sorted.
    Accepted rows carry an empty reject reason.
    """
    with open_writers(marked.sparkSession, 2):
        marked.withColumn(VALID, is_valid()).write.format(fmt).options(**options).partitionBy(VALID).mode(mode).save(path)


def read_split(spark, path: str, schema=None, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """The two halves of ``write_split``; each reads its own folder only."""
    reader = spark.read.format(fmt)
    both = (reader.schema(schema) if schema is not None else reader).load(path)
    return valid_rows(both), rejected_rows(both)


def reject_lines(marked: DataFrame, sep: str = ",") -> DataFrame:
    """Rejected rows as text lines ``reason<tab>fields`` for a reject file."""
    data = [c for c in marked.columns if c not in (VALID, REASON)]
    text = F.concat_ws(sep, *[F.coalesce(field(c).cast("string"), F.lit("")) for c in data])
    return marked.filter(~is_valid()).select(
        F.concat_ws("\t", F.coalesce(field(REASON), F.lit("")), text).alias("value")
    )
