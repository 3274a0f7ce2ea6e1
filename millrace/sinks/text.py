"""Delimited text and sequence file sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import field

# Codec names and class names a job may give.
CODECS = {
    "default": "deflate", "deflate": "deflate", "gzip": "gzip", "bzip2": "bzip2", "snappy": "snappy", "none": "none",
    "org.apache.hadoop.io.compress.DefaultCodec": "deflate",
    "org.apache.hadoop.io.compress.GzipCodec": "gzip",
    "org.apache.hadoop.io.compress.BZip2Codec": "bzip2",
    "org.apache.hadoop.io.compress.SnappyCodec": "snappy",
}
_CODEC_CLASSES = {v: k for k, v in CODECS.items() if k.startswith("org.")}

#: For a write of many small files.  Without Hadoop's native library, a ``file:`` path with checksum files starts two
#: processes (chmod) for each file; plain local files take none.  Other file systems don't look at these keys.
PLAIN_LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def codec(name: str | None) -> str:
    if not name:
        return "none"
    found = CODECS.get(name) or CODECS.get(name.lower())
    if not found:
        raise ValueError(f"unknown codec {name!r}")
    return found


def joined(columns: Sequence[str], sep: str = ",") -> Column:
    """Fields as one line; null is ""."""
    return F.concat_ws(sep, *[F.coalesce(field(c).cast("string"), F.lit("")) for c in columns])


def max_records(n: int | None) -> dict[str, str]:
    """File rolling option: -1 or None is unlimited, 0 is an error."""
    if n is None or n == -1:
        return {}
    if n <= 0:
        raise ValueError("the row limit of a file must be positive, or -1 for none")
    return {"maxRecordsPerFile": str(n), **PLAIN_LOCAL_FILES}


def write_delimited(
    df: DataFrame,
    path: str,
    *,
    sep: str = ",",
    line_sep: str = "\n",
    fields: Sequence[str] | None = None,
    column_line: bool = False,
    compression: str | None = None,
    max_rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """Text lines of the chosen fields, each ended by ``line_sep``.

    With ``column_line`` every file starts with ``COLUMN_NAMES:a,b``.
    Partition columns become ``k=v`` folders and are left out of the lines.
    """
    if not line_sep.endswith("\n"):
        raise ValueError("the line separator must end in a newline")
    names = [c for c in (fields or df.columns) if c not in partition_by]
    value = joined(names, sep)
    if column_line:
        if partition_by or max_records(max_rows_per_file):
            raise ValueError("a column line needs one file per task")
        head = F.lit("COLUMN_NAMES:" + sep.join(names) + line_sep)
        row_number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        value = F.when(row_number == 0, F.concat(head, value)).otherwise(value)
    lines = df.select(value.alias("value"), *[field(c) for c in partition_by])
    writer = lines.write.mode(mode).option("lineSep", line_sep).options(**max_records(max_rows_per_file))
    if codec(compression) != "none":
        writer = writer.option("compression", codec(compression))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)


def write_sequence(
    df: DataFrame,
    path: str,
    *,
    sep: str = ",",
    fields: Sequence[str] | None = None,
    compression: str | None = None,
    block: bool = True,
) -> None:
    """Sequence file with key 0 and the joined line as value; RECORD or BLOCK compression."""
    pairs = df.select(joined(fields or df.columns, sep)).rdd.map(lambda r: (0, r[0]))
    prefix = "mapreduce.output.fileoutputformat.compress"
    conf = {prefix: "false"}
    if codec(compression) != "none":
        conf = {
            prefix: "true",
            f"{prefix}.codec": _CODEC_CLASSES[codec(compression)],
            f"{prefix}.type": "BLOCK" if block else "RECORD",
        }
    pairs.saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.IntWritable",
        "org.apache.hadoop.io.Text",
        conf=conf,
    )


def publish_path(target: str, run: str) -> str:
    """Folder of one run under a target: results appear there when the write commits."""
    return f"{target.rstrip('/')}/batch={run}"
