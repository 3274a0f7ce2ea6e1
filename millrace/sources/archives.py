"""Members of zip and tar archives as one stream of lines.

An archive is one compressed stream, so each archive is read by one task (and
must be below 2 GiB, Spark's limit for a binary file); the archives of a folder
are read in parallel.  Members are decompressed as a stream and lines leave the
task in small batches.  Single compressed files (gz, bz2, deflate, snappy) go
through ``read_lines``.
"""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.text import full_match
from millrace.sources.files import select_by_name
from millrace.sources.text import read_lines

_BATCH = 10_000

# Fixed value: names of files that are archives.
ARCHIVE_NAMES = r".*\.(?i:zip|tar|tar\.gz|tgz|tar\.bz2)"


def _members(path: str, content: pa.Buffer) -> Iterator[tuple[str, io.BufferedIOBase]]:
    low = path.lower()
    data = pa.BufferReader(content)
    if low.endswith(".zip"):
        with zipfile.ZipFile(data) as z:
            for info in z.infolist():
                if not info.is_dir():
                    with z.open(info) as f:
                        yield info.filename, f
    elif low.endswith((".tar", ".tar.gz", ".tgz", ".tar.bz2")):
        with tarfile.open(fileobj=data, mode="r|*") as t:
            for info in t:
                if info.isfile():
                    yield info.name, t.extractfile(info)
    else:
        raise ValueError(f"{path} is no zip or tar archive")


def _rows(stream: io.BufferedIOBase, sep: bytes) -> Iterator[bytes]:
    """Rows of a member; a last row without separator counts, an empty rest doesn't."""
    if sep == b"\n":
        yield from (raw.rstrip(b"\r\n") for raw in stream)
        return
    rest = b""
    while chunk := stream.read(1 << 20):
        *whole, rest = (rest + chunk).split(sep)
        yield from whole
    if rest:
        yield rest


def read_archive_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    charset: str = "utf-8",
    line_sep: str = "\n",
    name_glob: str | None = None,
    name_regex: str | None = None,
    name_regex_include: bool = True,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Lines of all members: ``value, _file_path, _member, _line`` (line number in the member).

    Files that are no archives are left alone.
    """
    row_end = line_sep.encode(charset)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    files = reader.load(paths if isinstance(paths, str) else list(paths))
    files = files.filter(full_match(F.col("_metadata.file_name"), ARCHIVE_NAMES))
    files = select_by_name(files, name_regex, name_regex_include, names).select("path", "content")
    columns = ["value", "_file_path", "_member", "_line"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                for member, stream in _members(path.as_py(), content.as_buffer()):
                    rows: list[str] = []
                    first = 1
                    for raw in _rows(stream, row_end):
                        rows.append(raw.decode(charset, "replace"))
                        if len(rows) == _BATCH:
                            yield _lines(rows, path.as_py(), member, first, columns)
                            first += len(rows)
                            rows = []
                    if rows:
                        yield _lines(rows, path.as_py(), member, first, columns)

    return files.mapInArrow(work, "value string, _file_path string, _member string, _line bigint")


def _lines(rows: list[str], path: str, member: str, first: int, names: list[str]) -> pa.RecordBatch:
    n = len(rows)
    columns = [
        pa.array(rows, pa.string()),
        pa.array([path] * n, pa.string()),
        pa.array([member] * n, pa.string()),
        pa.array(range(first, first + n), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_mixed_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    charset: str | None = None,
    skip_lines: int = 0,
    provenance: bool = False,
    **selection,
) -> DataFrame:
    """Lines of plain and compressed files and of archive members under the same paths.

    Head lines are skipped in every file and in every archive member.
    """
    plain = read_lines(
        spark, paths, charset=charset, skip_lines=skip_lines, provenance=provenance,
        recursive=True, leave_out=ARCHIVE_NAMES, **selection,
    )
    packed = read_archive_lines(spark, paths, charset=charset or "utf-8", **selection)
    return plain.unionByName(packed.filter(F.col("_line") > skip_lines).select(*plain.columns))
