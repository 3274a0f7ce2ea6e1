"""Projections: rename, subset, last non-empty source, defaults, column functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.text import field, nonempty
from millrace.plans.spec import FieldMap, SpecError
from millrace.session import scratch_path

# Functions that may be applied to a column on its way to a sink.
COLUMN_FUNCTIONS = {
    "upper": F.upper, "lower": F.lower, "trim": F.trim, "ltrim": F.ltrim, "rtrim": F.rtrim,
    "length": F.length, "reverse": F.reverse, "md5": F.md5, "abs": F.abs, "floor": F.floor,
    "ceil": F.ceil, "year": F.year, "month": F.month, "to_date": F.to_date,
}


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def last_nonempty(sources: Sequence[str], schema: T.StructType) -> Column:
    """The last source that is neither null nor "" wins; "" only if no source has a value.

    Sources of different types are compared and returned as text.
    """
    kinds = {schema[s].dataType for s in sources}
    cols = [field(s) if len(kinds) == 1 else field(s).cast("string") for s in sources]
    if len(cols) == 1:
        return cols[0]
    if len(kinds) == 1 and not _is_text(next(iter(kinds))):
        return F.coalesce(*reversed(cols))
    return F.coalesce(*[nonempty(c) for c in reversed(cols)], *cols)


def with_default(c: Column, dtype: T.DataType, value: str) -> Column:
    """``value`` where the column is null or ""."""
    if _is_text(dtype):
        return F.coalesce(nonempty(c), F.lit(value))
    return F.coalesce(c, F.lit(value).cast(dtype))


def project(df: DataFrame, mapping: Sequence[FieldMap], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """``dest:src`` list; a dest listed more than once takes its last non-empty source.

    Rows are never merged: a mapping whose methods are all NONE is a plain
    projection without duplicate removal.
    """
    schema = df.schema
    sources: dict[str, list[str]] = {}
    casts: dict[str, str] = {}
    for m in mapping:
        if m.src not in schema.fieldNames():
            raise SpecError(f"unknown source field {m.src!r}")
        sources.setdefault(m.dest, []).append(m.src)
        if m.cast:
            casts[m.dest] = m.cast
    out = []
    for dest, srcs in sources.items():
        c = last_nonempty(srcs, schema)
        if dest in casts:
            c = c.try_cast(casts[dest])
        out.append(c.alias(dest))
    return apply_defaults(df.select(*out), defaults)


def apply_defaults(df: DataFrame, defaults: Mapping[str, str] | None) -> DataFrame:
    """One rule for every job kind: a default fills null and "" and nothing else."""
    if not defaults:
        return df
    unknown = set(defaults) - set(df.columns)
    if unknown:
        raise SpecError(f"default for unknown column {sorted(unknown)}")
    return df.withColumns(
        {c: with_default(field(c), df.schema[c].dataType, v) for c, v in defaults.items()}
    )


def split_column_function(name: str) -> tuple[str, str | None]:
    """``amount_method(abs)method`` -> (amount, abs); any other name unchanged."""
    m = re.fullmatch(r"(.+)_method\((.+)\)method", name)
    return (m.group(1), m.group(2)) if m else (name, None)


def apply_column_functions(df: DataFrame, functions: Mapping[str, str]) -> DataFrame:
    """Named function per column just before a write, from a fixed list of names."""
    unknown = set(functions.values()) - set(COLUMN_FUNCTIONS)
    if unknown:
        raise SpecError(f"column function {sorted(unknown)} is not allowed")
    return df.withColumns({c: COLUMN_FUNCTIONS[f](field(c)) for c, f in functions.items()})


def unique_key(key: Column) -> Column:
    """Key with a suffix that no other row of the run has (partition and row number)."""
    return F.concat(key, F.lit("_"), F.monotonically_increasing_id().cast("string"))


def number_rows(df: DataFrame, order: Sequence[str], column: str = "_number") -> DataFrame:
    """Rows with gapless numbers from 1 in the order of ``order``, the same in every run and after lost executors.

    Ranges of the order are sorted apart and written with each row's place in its range; a range's numbers start after
    the rows of all ranges before it, a running sum over one row per range.  Rows of equal order are told apart by a
    hash of all columns, so only equal rows could change places.
    """
    spark = df.sparkSession
    keys = [*[field(c) for c in order], F.xxhash64(*[field(c) for c in df.columns])]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    placed = ranged.withColumns({"_range": F.shiftright(at, 33), "_place": at.bitwiseAND(F.lit((1 << 33) - 1))})
    path = scratch_path(spark, "numbered") + "/rows"
    placed.write.parquet(path)  # written once: a number depends on the range a row was in
    kept = spark.read.schema(placed.schema).parquet(path)
    sizes = kept.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("_range", before.alias("_base"))
    numbered = kept.join(bases, "_range").withColumn(column, F.col("_base") + F.col("_place") + 1)
    return numbered.drop("_range", "_place", "_base")


def numbered_key(df: DataFrame, key: Column, order: Sequence[str], name: str = "row_key") -> DataFrame:
    """``df`` with a key of its own for each row, as ``unique_key`` gives, but by number and reproducible."""
    numbered = number_rows(df.withColumn(name, key), order)
    return numbered.withColumn(name, F.concat(field(name), F.lit("_"), F.col("_number").cast("string"))).drop("_number")
