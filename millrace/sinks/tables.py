"""Catalog and lake tables: DDL, dynamic partitions, replacement and deletion by key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import PySparkException

from millrace.functions.text import field
from millrace.operators.latest import without
from millrace.plans.spec import SpecError
from millrace.sinks.keyed import KeyedTable
from millrace.sinks.text import max_records
from millrace.sources.hadoop import require_hive


def split_statements(text: str) -> list[str]:
    """Text cut at ``;``, except within quotes."""
    return re.findall(r"(?:'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|[^;])+", text, re.DOTALL)


def run_statements(spark: SparkSession, statements: str | Sequence) -> list[str]:
    """Statements before a write: text separated by ``;`` or ``(sql, ignore_errors)`` pairs.

    Returns the messages of ignored errors.
    """
    if isinstance(statements, str):
        statements = [(s.strip(), False) for s in split_statements(statements) if s.strip()]
    ignored = []
    for item in statements:
        sql, lenient = item if isinstance(item, tuple) else (item, False)
        try:
            spark.sql(sql)
        except PySparkException as e:
            if not lenient:
                raise
            ignored.append(f"{sql}: {e.getCondition()}")
    return ignored


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value brought together into files of the advisory size.

    The rebalance hint merges small values and splits a value that holds most
    of the rows, both from measured sizes.
    """
    return df.hint("rebalance", *[field(c) for c in partition_by]) if partition_by else df.hint("rebalance")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    fmt: str = "parquet",
    max_rows_per_file: int | None = None,
    mode: str = "errorifexists",
    replace_partitions: bool = False,
    rebalance: bool = True,
    **options,
) -> None:
    """``k=v`` folders; with ``replace_partitions`` only the partitions present in ``df`` are replaced.

    The rebalance costs one shuffle of the output and saves a file per task and
    partition value; turn it off where each task holds few values already.
    """
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise SpecError(f"partition fields {missing} are not in the data")
    out = balanced(df, partition_by) if rebalance else df
    writer = out.write.format(fmt).options(**options, **max_records(max_rows_per_file)).partitionBy(*partition_by)
    if replace_partitions:
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).save(path)


def insert_into(
    df: DataFrame,
    table: str,
    *,
    ddl: str | Sequence | None = None,
    overwrite: bool = False,
    replace_partitions: bool = False,
) -> None:
    """Insert by column name into a catalog table, after optional DDL.

    New partitions of a registered table are added by the insert itself.
    """
    spark = df.sparkSession
    if ddl:
        run_statements(spark, ddl)
    target = spark.table(table).columns
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise SpecError(f"table {table} needs columns {missing}")
    writer = df.select(*[field(c) for c in target]).write
    if replace_partitions:
        writer, overwrite = writer.option("partitionOverwriteMode", "dynamic"), True
    writer.insertInto(table, overwrite=overwrite)


def ensure_table(spark: SparkSession, table: str, df: DataFrame, *, fmt: str = "parquet", location: str | None = None,
                 partition_by: Sequence[str] = (), truncate: bool = False) -> None:
    """Create schema and table when absent; otherwise empty the table if asked."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{parts}{place}")
    elif truncate:
        insert_into(spark.createDataFrame([], spark.table(table).schema), table, overwrite=True)


def write_rc_table(df: DataFrame, table: str, location: str | None = None) -> None:
    """Catalog table stored as RCFile (needs Hive support)."""
    spark = df.sparkSession
    require_hive(spark)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) STORED AS RCFILE{place}")
    df.write.insertInto(table)


def delete_by_key(target: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target without rows whose key occurs in ``keys``; write it to a new version of the table."""
    return without(target, keys, columns)


def replace_by_key(target: DataFrame, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target with all rows of the given keys exchanged for ``rows``."""
    return without(target, rows, columns).unionByName(rows)


def replace_file_rows(rows: DataFrame, path: str, id_column: str = "file_id") -> KeyedTable:
    """Rows of reprocessed files replace their earlier version, in a table kept by file id.

    Only data files that hold an earlier version are touched, and their number follows the rows, not the source files.
    """
    table = KeyedTable(rows.sparkSession, path, [id_column])
    if not table.version():
        return table.create(rows)
    table.replace(rows)
    return table
