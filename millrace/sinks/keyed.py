"""Tables that change by key: merge on read, and rewriting file by file.

Layout under the table's path::

    base/<version>/*.parquet      rows; a file never changes
    deleted/<version>/*.parquet   (file, row): rows that no longer count
    versions/<version>/           one row per base file of that version: file, rows, deleted, range of the first key
    schema/                       an empty file with the schema

A deletion looks for its keys in the key columns of the files whose range can hold them, and writes the places of the
rows it finds (``_metadata.row_index``) beside the base files, which stay.  A replacement also adds files with the new
rows.  A read takes files without deleted rows as they are and removes places from the others by an anti join on (file,
row), so rows move only for files that were touched.  ``compact`` rewrites the files that have lost a share of their rows,
and no other.

A version is visible once its list of files is written whole.  A change claims the next number by creating a file that
must not exist yet: a second writer, or one that comes after a change that broke off, is refused and nothing it wrote
counts; ``release`` gives up a broken change.  Old versions can be read until ``vacuum``.

Keys compare null-safe.  Rows that share a key are deleted and replaced together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import field
from millrace.operators.latest import within
from millrace.plans.spec import SpecError
from millrace.session import collect_small, create_file, path_exists
from millrace.sources.file_index import FILES, relative_name

_FILE, _ROW = "_file", "_row"


class TableChanged(RuntimeError):
    """Another change has the next version, or broke off without it."""


class KeyedTable:
    """A table under ``path`` whose rows are deleted and replaced by ``keys``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    # --- versions

    def _names(self, folder: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def _remove(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    def version(self) -> int:
        """The latest visible version; 0 before the first."""
        numbers = sorted((int(n) for n in self._names("versions")), reverse=True)
        return next((n for n in numbers if path_exists(self.spark, f"{self.path}/versions/{n}/_SUCCESS")), 0)

    def _claim(self) -> int:
        number = self.version() + 1
        if not create_file(self.spark, f"{self.path}/claims/{number}"):
            raise TableChanged(f"version {number} of {self.path} is claimed by another change; if that broke off, release it")
        return number

    def release(self) -> None:
        """Give up a change that broke off: its claim and what it wrote."""
        number = self.version() + 1
        for name in ("base", "deleted", "versions", "claims"):
            self._remove(f"{name}/{number}")

    def files(self, version: int | None = None) -> DataFrame:
        """file, rows, deleted, low, high, nulls of every base file of a version."""
        return self.spark.read.parquet(f"{self.path}/versions/{version or self.version()}")

    def schema(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/schema").schema

    # --- reading

    def _base(self, names: Sequence[str], columns: Sequence[str] | None = None, places: bool = False) -> DataFrame:
        """Rows of base files as they were written."""
        schema = self.schema()
        if not names:
            rows = self.spark.createDataFrame([], schema)
            return rows.select(*self._wanted(columns), *([F.lit("").alias(_FILE), F.lit(0).cast("bigint").alias(_ROW)] if places else []))
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/base/{n}" for n in names])
        own = [relative_name(1).alias(_FILE), F.col("_metadata.row_index").alias(_ROW)] if places else []
        return rows.select(*self._wanted(columns), *own)

    def _wanted(self, columns: Sequence[str] | None) -> list:
        return [field(c) for c in (columns or self.schema().names)]

    def _gone(self, version: int) -> DataFrame:
        """Places that don't count in a version; those of files that are no longer listed don't matter."""
        made = [n for n in self._names("deleted") if int(n) <= version]
        return self.spark.read.schema(f"{_FILE} string, {_ROW} bigint").parquet(*[f"{self.path}/deleted/{n}" for n in made])

    def _live(self, listed: list, version: int, columns: Sequence[str] | None = None, places: bool = False) -> DataFrame:
        """Rows that count: untouched files as they are, the others without their deleted places."""
        rows = self._base([r["file"] for r in listed if not r["deleted"]], columns, places)
        touched = [r["file"] for r in listed if r["deleted"]]
        if not touched:
            return rows
        own = self._base(touched, columns, True).join(self._gone(version), [_FILE, _ROW], "left_anti")
        return rows.unionByName(own if places else own.drop(_FILE, _ROW))

    def _listed(self, version: int, condition=None) -> list:
        files = self.files(version)
        return collect_small(files.where(condition) if condition is not None else files, FILES, f"files of {self.path}")

    def read(self, version: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        version = version or self.version()
        return self._live(self._listed(version), version, columns)

    # --- changes

    def _write(self, rows: DataFrame, number: int, label: str = "") -> DataFrame:
        """New base files, evenly filled; returns their list, taken from the written key column."""
        rows.hint("rebalance").write.mode("append").parquet(f"{self.path}/base/{number}")
        first = field(self.keys[0])
        written = self.spark.read.schema(self.schema()).parquet(f"{self.path}/base/{number}")
        return written.select(relative_name(1).alias("file"), first.alias("key")).groupBy("file").agg(
            F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("deleted"), F.min("key").alias("low"), F.max("key").alias("high"),
            F.max(F.col("key").isNull()).alias("nulls"),
        )

    def _commit(self, files: DataFrame, number: int) -> int:
        files.coalesce(1).write.parquet(f"{self.path}/versions/{number}")
        return number

    def create(self, rows: DataFrame) -> KeyedTable:
        """The first version."""
        missing = [k for k in self.keys if k not in rows.columns]
        if missing or not self.keys:
            raise SpecError(f"key fields {missing} are not in the data" if missing else "a keyed table needs a key")
        if self.version():
            raise TableChanged(f"{self.path} holds a table")
        number = self._claim()
        self.spark.createDataFrame([], rows.schema).coalesce(1).write.parquet(f"{self.path}/schema")
        self._commit(self._write(rows, number), number)
        return self

    def _delete(self, keys: DataFrame, version: int, number: int) -> DataFrame:
        """Write the places of the keys' rows; returns the list of files with their new numbers of deleted rows."""
        bounds = keys.agg(F.min(field(self.keys[0])), F.max(field(self.keys[0])), F.max(field(self.keys[0]).isNull())).first()
        near = F.lit(bool(bounds[2])) & F.col("nulls")
        if bounds[0] is not None:
            near = near | ((F.col("high") >= F.lit(bounds[0])) & (F.col("low") <= F.lit(bounds[1])))
        listed = self._listed(version, near)
        held = self._live(listed, version, self.keys, places=True)
        within(held, keys, self.keys, null_safe=True).select(_FILE, _ROW).write.parquet(f"{self.path}/deleted/{number}")
        found = self.spark.read.schema(f"{_FILE} string, {_ROW} bigint").parquet(f"{self.path}/deleted/{number}")
        more = found.groupBy(F.col(_FILE).alias("file")).agg(F.count("*").alias("more"))
        files = self.files(version).join(more, "file", "left")
        return files.withColumn("deleted", F.col("deleted") + F.coalesce("more", F.lit(0).cast("bigint"))).drop("more").where("deleted < rows")

    def delete(self, keys: DataFrame) -> int:
        """Rows whose key occurs in ``keys`` go; returns the new version."""
        number = self._claim()
        return self._commit(self._delete(keys, number - 1, number), number)

    def replace(self, rows: DataFrame) -> int:
        """All rows of the given keys are exchanged for ``rows``; returns the new version."""
        number = self._claim()
        new = self._write(rows.select(*[field(f.name).cast(f.dataType).alias(f.name) for f in self.schema()]), number)
        written = self.spark.read.schema(self.schema()).parquet(f"{self.path}/base/{number}")
        return self._commit(self._delete(written, number - 1, number).unionByName(new), number)

    def append(self, rows: DataFrame) -> int:
        """Rows beside the others, whatever their keys."""
        number = self._claim()
        new = self._write(rows.select(*[field(f.name).cast(f.dataType).alias(f.name) for f in self.schema()]), number)
        return self._commit(self.files(number - 1).unionByName(new), number)

    def compact(self, share: float = 0.2) -> int:
        """Rewrite the files that lost at least ``share`` of their rows; all others keep their names."""
        number = self._claim()
        version = number - 1
        worn = F.col("deleted") >= F.greatest(F.col("rows") * share, F.lit(1))
        listed = self._listed(version, worn)
        rest = self.files(version).where(~worn)
        if not listed:
            return self._commit(rest, number)
        return self._commit(rest.unionByName(self._write(self._live(listed, version), number)), number)

    def vacuum(self) -> int:
        """Remove base files, places and lists that the latest version does not need; returns the number of files removed."""
        version = self.version()
        live = {r["file"] for r in self._listed(version)}
        old = [f"{v}/{n}" for v in self._names("base") if int(v) <= version for n in self._names(f"base/{v}") if n.endswith(".parquet")]
        gone = [n for n in old if n not in live]
        for name in gone:
            self._remove(f"base/{name}")
        used = {r["file"] for r in self._listed(version) if r["deleted"]}
        for v in self._names("deleted"):
            if int(v) <= version:
                files = self.spark.read.schema(f"{_FILE} string, {_ROW} bigint").parquet(f"{self.path}/deleted/{v}").select(_FILE).distinct()
                if not used & {r[0] for r in collect_small(files, FILES, "files with deleted rows")}:
                    self._remove(f"deleted/{v}")
        for v in self._names("versions"):
            if int(v) < version:
                self._remove(f"versions/{v}")
        return len(gone)
