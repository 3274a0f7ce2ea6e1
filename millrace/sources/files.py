"""File selection and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.text import full_match

def select_by_name(
    df: DataFrame,
    regex: str | None = None,
    include: bool = True,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Keep rows by the name of their file: a full-match regex (or its negation), or a name list.

    The conditions use file metadata only, so Spark drops whole files before
    reading them.  Hidden files (leading ``_`` or ``.``) are never listed.
    """
    name = F.col("_metadata.file_name")
    if regex:
        match = full_match(name, regex)
        df = df.filter(match if include else ~match)
    if names is not None:
        df = df.filter(name.isin(*names) if names else F.lit(False))
    return df


def manifest(
    spark: SparkSession,
    root: str,
    regex: str | None = None,
    exclude_roots: Sequence[str] = (),
    include: bool = True,
) -> DataFrame:
    """Files under ``root`` as ``(path, name, size, modified)``; contents are not read.

    ``exclude_roots`` are nested folders that belong to other collection rules.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    out = files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    if regex:
        match = full_match(F.col("name"), regex)
        out = out.filter(match if include else ~match)
    for other in exclude_roots:
        plain = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
        out = out.filter(~plain.startswith("/" + other.split(":", 1)[-1].strip("/") + "/"))
    return out


def paths_from_query(spark: SparkSession, query: str | DataFrame, column: str | None = None) -> list[str]:
    """File list from a query.

    Spark's readers take their paths from the driver, so the list is fetched
    partition by partition and held as text; a ledger run goes through longer
    lists in portions.
    """
    df = spark.sql(query) if isinstance(query, str) else query
    return sorted(r[0] for r in df.select(column or df.columns[0]).distinct().toLocalIterator() if r[0])
