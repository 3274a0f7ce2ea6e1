"""Delimited text: separators, charsets, skipped head lines and file provenance."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace.session import collect_small
from millrace.sources.files import select_by_name

# Charsets Spark decodes itself; others are decoded by Python.
_JVM_CHARSETS = ("US-ASCII", "ISO-8859-1", "UTF-8")


def decode_bytes(raw: Column, charset: str) -> Column:
    """Bytes of a line as text; bytes that are no text in the charset become U+FFFD."""
    if charset.upper() in _JVM_CHARSETS and charset.upper() != "UTF-8":
        return F.decode(raw, charset.upper())
    "".encode(charset)

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode(charset, "replace"))

    return decode(raw)


def _skip_head(lines: DataFrame, count: int) -> DataFrame:
    """Drop the first ``count`` lines of every file, in one pass and without a shuffle.

    The first split of a file is read by one task in file order, so counting
    its lines there is exact.  Head lines that reach beyond the first split are
    an error and are not mistaken for data.
    """
    schema = T.StructType([f for f in lines.schema.fields if not f.name.startswith("_at_")])
    names = schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen, whole = None, 0, True

        def check():
            if current is not None and seen < count and not whole:
                raise ValueError(f"the {count} head lines do not fit in the first split of a file: read with skip_in='any split'")

        for batch in batches:
            key = batch.column("_at_file").to_numpy(zero_copy_only=False)
            start = batch.column("_at_start").to_numpy(zero_copy_only=False)
            full = batch.column("_at_whole").to_numpy(zero_copy_only=False)
            keep = np.ones(len(key), dtype=bool)
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(start) != 0)) + 1
            bounds = [0, *edges.tolist(), len(key)] if len(key) else [0]
            for lo, hi in zip(bounds, bounds[1:]):
                if start[lo] != 0:
                    continue
                if current != key[lo]:
                    check()
                    current, seen, whole = key[lo], 0, bool(full[lo])
                drop = min(hi - lo, max(count - seen, 0))
                keep[lo:lo + drop] = False
                seen += hi - lo
            out = batch.select(names)
            yield out if keep.all() else out.filter(pa.array(keep))
        check()

    return lines.mapInArrow(work, schema)


#: Blocks that hold head lines; about one a file.
_HEAD_BLOCKS = 1_000_000


def _skip_anywhere(lines: DataFrame, count: int) -> DataFrame:
    """Drop the first ``count`` lines of every file, wherever its splits cut them.

    Lines are counted by block, blocks before each are summed up by file, and the few blocks that lie in a head tell how
    many of their first lines go.  The counting pass runs when the read is set up and keeps nothing but numbers.
    """
    schema = T.StructType([f for f in lines.schema.fields if not f.name.startswith("_at_")])
    names = schema.fieldNames()
    blocks = lines.groupBy("_at_file", "_at_start").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("_at_file").orderBy("_at_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    heads = blocks.withColumn("before", before).where(F.col("before") < count)
    told = collect_small(heads, _HEAD_BLOCKS, "blocks with head lines")
    skips = {(r["_at_file"], r["_at_start"]): min(count - r["before"], r["n"]) for r in told}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, left = None, 0
        for batch in batches:
            key = batch.column("_at_file").to_numpy(zero_copy_only=False)
            start = batch.column("_at_start").to_numpy(zero_copy_only=False)
            keep = np.ones(len(key), dtype=bool)
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(start) != 0)) + 1
            bounds = [0, *edges.tolist(), len(key)] if len(key) else [0]
            for lo, hi in zip(bounds, bounds[1:]):
                now = (int(key[lo]), int(start[lo]))
                if now != block:
                    block, left = now, skips.get(now, 0)
                drop = min(hi - lo, left)
                keep[lo:lo + drop] = False
                left -= drop
            out = batch.select(names)
            yield out if keep.all() else out.filter(pa.array(keep))

    return lines.mapInArrow(work, schema)


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    line_sep: str = "\n",
    charset: str | None = None,
    skip_lines: int = 0,
    skip_in: str = "first split",
    provenance: bool = False,
    recursive: bool = False,
    name_glob: str | None = None,
    name_regex: str | None = None,
    name_regex_include: bool = True,
    names: Sequence[str] | None = None,
    leave_out: str | None = None,
) -> DataFrame:
    """Lines as ``value`` (and ``_file_path``); compressed files are read by their suffix.

    The default separator accepts ``\\n``, ``\\r\\n`` and ``\\r``; any other is taken literally.

    ``charset`` must keep the line separator's bytes apart from other text, as
    GBK and the ISO-8859 family do: files stay splittable because each line is
    decoded by itself.

    ``skip_lines`` head lines of each file go in the same pass if they lie in its first split, else the read fails;
    with ``skip_in="any split"`` a first pass counts lines, and heads may be of any length.
    """
    if skip_in not in ("first split", "any split"):
        raise ValueError(f"unknown place of head lines {skip_in!r}")
    if charset and charset.upper().replace("_", "-").startswith(("UTF-16", "UTF-32")):
        raise ValueError("UTF-16 and UTF-32 text cannot be split by bytes: use spark.read.csv(encoding=...)")
    reader = spark.read
    if line_sep != "\n":
        reader = reader.option("lineSep", line_sep)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    df = reader.text(paths if isinstance(paths, str) else list(paths))
    df = select_by_name(df, name_regex, name_regex_include, names)
    if leave_out:
        df = select_by_name(df, leave_out, include=False)
    raw = F.col("value").cast("binary") if charset else F.col("value")
    cols = [raw.alias("value")]
    if provenance:
        cols.append(F.col("_metadata.file_path").alias("_file_path"))
    if skip_lines > 0:
        meta = F.col("_metadata")
        cols += [
            F.xxhash64(meta["file_path"]).alias("_at_file"),
            meta["file_block_start"].alias("_at_start"),
            ((meta["file_block_start"] == 0) & (meta["file_block_length"] >= meta["file_size"])).alias("_at_whole"),
        ]
    df = df.select(*cols)
    if skip_lines > 0:
        df = (_skip_anywhere if skip_in == "any split" else _skip_head)(df, skip_lines)
    if charset:
        df = df.withColumn("value", decode_bytes(F.col("value"), charset))
    return df


def parse_fields(
    lines: DataFrame, fields: Sequence[str] | T.StructType | str, sep: str = ",", regex: bool = False
) -> DataFrame:
    """Split ``value`` into named fields by position.

    Blank lines are dropped.  Missing and trailing empty fields are null, inner
    empty fields stay "", surplus fields are ignored.  A typed schema casts each
    field; what cannot be read as its type is null.
    """
    if isinstance(fields, str):
        fields = T.StructType.fromDDL(fields)
    types = (
        [(f.name, f.dataType) for f in fields.fields]
        if isinstance(fields, T.StructType)
        else [(f, T.StringType()) for f in fields]
    )
    pattern = sep if regex else re.escape(sep)
    value = F.col("value")
    others = [F.col(c) for c in lines.columns if c != "value"]
    # the line is split once, in a projection of its own, for all fields
    df = lines.filter(value.rlike(r"[^\x00-\x20]")).select(F.split(value, pattern, -1).alias("_parts"), *others)
    parts = F.col("_parts")
    if any(isinstance(dtype, T.StringType) for _, dtype in types):
        # number of fields up to the last that is not empty; looked for only when the last one is
        at = [F.when(F.get(parts, F.lit(i)) != "", F.lit(i + 1)) for i in range(len(types))]
        size = F.size(parts)
        surplus = F.array_join(F.slice(parts, F.lit(len(types) + 1), F.greatest(size, F.lit(1))), "")
        filled = F.greatest(F.lit(0), F.when(surplus != "", size), *at)
        df = df.select("*", F.when(F.element_at(parts, -1) != "", size).otherwise(filled).alias("_filled"))
    out = []
    for i, (name, dtype) in enumerate(types):
        c = F.get(parts, F.lit(i))
        c = F.when(F.col("_filled") > i, c) if isinstance(dtype, T.StringType) else c.try_cast(dtype)
        out.append(c.alias(name))
    return df.select(*out, *others)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Sequence[str] | T.StructType | str,
    sep: str = ",",
    regex: bool = False,
    **line_options,
) -> DataFrame:
    """Delimited text scan with any (also regex) field separator and any line separator."""
    return parse_fields(read_lines(spark, paths, **line_options), fields, sep, regex)


def read_plain(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, sep: str = ",", header: bool = False
) -> DataFrame:
    """Newline-separated text through the CSV reader, without quoting.

    Only the columns a query uses are parsed.  Every empty field is null.  With
    ``header`` the first line of each file is skipped.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {"sep": sep, "quote": "", "header": str(header).lower(), "enforceSchema": "true"}
    return spark.read.options(**options).schema(schema).csv(paths if isinstance(paths, str) else list(paths))
