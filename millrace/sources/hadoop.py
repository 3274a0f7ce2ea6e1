"""Sequence files, and table formats that need the Hive classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace.sources.text import parse_fields
from millrace.functions.text import field

_TEXT = "org.apache.hadoop.io.Text"
_INT = "org.apache.hadoop.io.IntWritable"


def read_sequence_lines(spark: SparkSession, path: str, key_class: str = _INT) -> DataFrame:
    """Values of a sequence file as ``value``; Spark has no DataFrame source for the format."""
    pairs = spark.sparkContext.sequenceFile(path, key_class, _TEXT)
    lines = T.StructType([T.StructField("value", T.StringType())])
    return spark.createDataFrame(pairs.map(lambda kv: (kv[1],)), lines, verifySchema=False)


def read_sequence(
    spark: SparkSession,
    path: str,
    fields: Sequence[str] | T.StructType | str,
    sep: str = ",",
    regex: bool = False,
    key_class: str = _INT,
) -> DataFrame:
    """Sequence file whose values are delimited lines."""
    return parse_fields(read_sequence_lines(spark, path, key_class), fields, sep, regex)


def require_hive(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "hive":
        raise RuntimeError("this table format needs a session with Hive support")


def read_rc(spark: SparkSession, table: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Catalog table stored as RCFile; columns renamed by position when ``fields`` is given."""
    require_hive(spark)
    df = spark.table(table)
    if not fields:
        return df
    return df.select(*[field(c).alias(f) for c, f in zip(df.columns, fields)])


def read_query(spark: SparkSession, query: str) -> DataFrame:
    """Any catalog query as a source, planned and read in parallel like the rest of the job."""
    return spark.sql(query)
