"""JDBC sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.jdbc import Database


def execute_statements(spark: SparkSession, db: Database, statements: Sequence) -> list[str]:
    """Control statements on the target: ``sql`` or ``(sql, ignore_errors)``; returns ignored messages."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in db.properties.items():
        properties.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(db.url, properties)
    ignored = []
    try:
        for item in statements:
            sql, lenient = item if isinstance(item, tuple) else (item, False)
            statement = connection.createStatement()
            try:
                statement.execute(sql)
            except Exception as e:
                if not lenient:
                    raise
                ignored.append(f"{sql}: {type(e).__name__}")
            finally:
                statement.close()
    finally:
        connection.close()
    return ignored


def write_table(
    df: DataFrame,
    db: Database,
    table: str,
    *,
    mode: str = "append",
    batch_size: int = 10_000,
    connections: int | None = None,
    truncate: bool = False,
    pre_sql: Sequence = (),
) -> None:
    """Batched inserts; ``connections`` bounds how many tasks write at once."""
    if pre_sql:
        execute_statements(df.sparkSession, db, pre_sql)
    writer = df.write.format("jdbc").options(**db.options()).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size)).option("truncate", str(truncate).lower())
    if connections:
        writer = writer.option("numPartitions", str(connections))
    writer.mode(mode).save()
