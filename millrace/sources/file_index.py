"""Zone map and Bloom filter of every data file, so that reads by key open only files that can hold it.

The index lies beside the data in ``<path>/_index`` (Spark's readers leave out names with an underscore): one row per
file with its row count and the smallest and largest key and further columns, and one bitmap per Bloom block.  It is made
from the key columns alone, one file per task at most, without an exchange of rows.  Data files never change, so an
entry stays true; a file without entry is always read, and an entry without file is left out.

Parquet keeps such ranges too, but in each file's footer, so every file must be opened to learn that it can be skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.text import field
from millrace.session import collect_small, path_exists

#: Fixed value: bits of a bitmap that Spark's ``bitmap_construct_agg`` makes; a Bloom block is one of them.
BLOCK_BITS = 32_768
#: Keys of one block: 16 bits a key, of which each key sets ``PROBES``; about 1 in 700 absent keys is then let through.
BLOCK_KEYS, PROBES = 2_048, 6
#: File names that a read hands to Spark, which holds them all in the driver anyway.
FILES = 1_000_000


def relative_name(depth: int = 0) -> Column:
    """A data file's name below the table's folder; ``depth`` is the number of folders between."""
    # found for every row, so by counting slashes from the end: a pattern tries each place of a long path anew
    return F.substring_index(F.col("_metadata.file_path"), "/", -depth - 1)


def _positions(key: Column) -> list[Column]:
    """Bits of a key within its block, by two hashes."""
    one, two = (F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in (1, 2))
    return [F.pmod(one + two * i, F.lit(BLOCK_BITS)) for i in range(PROBES)]


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks.cast("bigint"))


class FileIndex:
    """The index of the Parquet files under ``path``, by ``key`` and the ranges of ``others``."""

    def __init__(self, spark: SparkSession, path: str, key: str, others: Sequence[str] = (), depth: int = 0):
        self.spark, self.path, self.key, self.others, self.depth = spark, path.rstrip("/"), key, tuple(others), depth

    def _table(self, name: str) -> DataFrame | None:
        place = f"{self.path}/_index/{name}"
        return self.spark.read.parquet(place) if path_exists(self.spark, place) else None

    def files(self) -> list[str]:
        """Names of the data files that are there, by listing and without opening any."""
        read = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        found = read.load(self.path).select("path").where(~F.col("path").contains("/_"))
        name = F.regexp_extract("path", "(?:[^/]+/){%d}[^/]+$" % self.depth, 0)
        return sorted(r[0] for r in collect_small(found.select(name), FILES, f"files under {self.path}"))

    def open(self, names: Sequence[str]) -> DataFrame:
        """The rows of these files."""
        return self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in names])

    def update(self, bloom: bool = True) -> int:
        """Index the files that have no entry; returns their number.  Without ``bloom`` only their ranges are taken."""
        known = self._table("files")
        old = set() if known is None else {r[0] for r in collect_small(known.select("file"), FILES, "indexed files")}
        new = [n for n in self.files() if n not in old]
        if not new:
            return 0
        key = field(self.key)
        rows = self.open(new).select(relative_name(self.depth).alias("file"), key.alias("key"), *[field(c).alias(c) for c in self.others])
        ranges = [x for c in self.others for x in (F.min(field(c)).alias(f"low_{c}"), F.max(field(c)).alias(f"high_{c}"))]
        told = rows.groupBy("file").agg(
            F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"),
            F.max(F.col("key").isNull()).alias("nulls"),
            (F.ceil(F.approx_count_distinct("key", 0.02) / BLOCK_KEYS) if bloom else F.lit(None)).cast("int").alias("blocks"), *ranges,
        )
        if bloom:
            told = told.withColumn("blocks", F.greatest("blocks", F.lit(1)))
            self._write_blooms(rows, told)
        told.write.mode("append").parquet(f"{self.path}/_index/files")  # last: files without an entry are always read
        return len(new)

    def _write_blooms(self, rows: DataFrame, told: DataFrame) -> None:
        # One bitmap for each probe in one pass over the keys, put together afterwards: a few rows a file.
        keys = rows.where("key is not null").select("file", "key").join(told.select("file", "blocks"), "file")
        probes = [F.bitmap_construct_agg(bit).alias(f"bits{i}") for i, bit in enumerate(_positions(F.col("key")))]
        own = keys.groupBy("file", "blocks", _block(F.col("key"), F.col("blocks")).cast("int").alias("block")).agg(*probes)
        each = own.select("file", "blocks", "block", F.explode(F.array(*[f"bits{i}" for i in range(PROBES)])).alias("bits"))
        blooms = each.groupBy("file", "blocks", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        blooms.write.mode("append").parquet(f"{self.path}/_index/bloom")

    def candidates(
        self, keys: Sequence | None = None, low=None, high=None, between: Mapping[str, tuple] | None = None
    ) -> list[str]:
        """Names of the files that can hold a key of ``keys``, or one in [low, high), and values in [from, to) of other columns.

        Bounds are values or columns without references; None leaves a side open.
        """
        there, known = self.files(), self._table("files")
        if known is None:
            return there
        lit = lambda x: x if isinstance(x, Column) else F.lit(x)
        fits = known
        if low is not None:
            fits = fits.where(F.col("high") >= lit(low))
        if high is not None:
            fits = fits.where(F.col("low") < lit(high))
        for name, (start, end) in (between or {}).items():
            if start is not None:
                fits = fits.where(field(f"high_{name}") >= lit(start))
            if end is not None:
                fits = fits.where(field(f"low_{name}") < lit(end))
        if keys is not None:
            fits = fits.join(self._holding(fits, keys), "file", "left_semi")
        wanted = {r[0] for r in collect_small(fits.select("file"), FILES, "candidate files")}
        indexed = {r[0] for r in collect_small(known.select("file"), FILES, "indexed files")}
        return [n for n in there if n in wanted or n not in indexed]

    def _holding(self, files: DataFrame, keys: Sequence) -> DataFrame:
        """Files whose zone and Bloom filter let a key pass; ``keys`` are the literals of a query, so they are few."""
        kind = files.schema["low"].dataType
        each = F.explode(F.array(*[F.lit(k).cast(kind) for k in keys])) if keys else F.explode(F.array().cast(f"array<{kind.simpleString()}>"))
        asked = files.select("file", "blocks", "low", "high", each.alias("key")).where("key between low and high")
        ranged = asked.where("blocks is null").select("file")
        asked = asked.where("blocks is not null").withColumn("block", _block(F.col("key"), F.col("blocks")).cast("int"))
        blooms = self._table("bloom")
        if blooms is None:
            return ranged.distinct()
        met = asked.join(blooms.select("file", "block", "bits"), ["file", "block"])
        for bit in _positions(F.col("key")):
            byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            met = met.where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1)
        return met.select("file").union(ranged).distinct()
