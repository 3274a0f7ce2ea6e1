"""Group-by with the methods NONE, SUM, AVG, MIN, MAX and COUNT.

All methods are algebraic, so Spark aggregates each input partition before the
shuffle: a key that holds a third of the rows reaches the final stage as one
partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.numbers import number
from millrace.functions.text import field, nonempty
from millrace.operators.project import apply_defaults, project
from millrace.operators.rowops import apply_ops, valid_rows
from millrace.plans.spec import FieldMap, SpecError, is_projection

METHODS = ("NONE", "SUM", "AVG", "MIN", "MAX", "COUNT")


def _number(c: Column, dtype: T.DataType) -> Column:
    return c.cast("double") if isinstance(dtype, T.NumericType) else number(c)


def total(c: Column, dtype: T.DataType, nulls_as_zero: bool = True) -> Column:
    """Sum as double; null and non-numeric values count as 0 (SQL rule: are left out)."""
    x = _number(c, dtype)
    return F.sum(F.coalesce(x, F.lit(0.0)) if nulls_as_zero else x)


def mean(c: Column, dtype: T.DataType, nulls_as_zero: bool = True) -> Column:
    """True mean, over all rows of the group (SQL rule: over the numeric values)."""
    if nulls_as_zero:
        return total(c, dtype) / F.count(F.lit(1))
    return F.avg(_number(c, dtype))


def extreme(c: Column, dtype: T.DataType, largest: bool) -> Column:
    """Smallest or largest value.

    Typed columns use their own order.  For text the whole group decides: if
    every non-empty value is a number the order is numeric (equal numbers by
    their text) and the original text is returned, else the order is that of
    the text.  Null and "" are ignored.  Text needs sorted aggregation; where
    the numbers themselves are enough, give the field a type (in the source
    schema or as ``cast``) and it stays in hash aggregation.
    """
    best = F.max if largest else F.min
    if not isinstance(dtype, T.StringType):
        return best(c)
    s = nonempty(c)
    x = number(s)
    as_number = best(F.when(x.isNotNull(), F.struct(x.alias("x"), s.alias("s"))))
    all_numeric = F.count(s) == F.count(x)
    return F.when(all_numeric, as_number["s"]).otherwise(best(s))


def _measure(m: FieldMap, schema: T.StructType, nulls_as_zero: bool) -> Column:
    c, dtype = field(m.src), schema[m.src].dataType
    if m.cast:
        c, dtype = c.try_cast(m.cast), T.DataType.fromDDL(m.cast)
    if m.method == "SUM":
        out = total(c, dtype, nulls_as_zero)
    elif m.method == "AVG":
        out = mean(c, dtype, nulls_as_zero)
    elif m.method in ("MIN", "MAX"):
        out = extreme(c, dtype, m.method == "MAX")
    else:
        out = F.count(F.lit(1))
    return out.alias(m.dest)


def _key(m: FieldMap, schema: T.StructType, empty_as_null: bool) -> Column:
    c = field(m.src)
    if m.cast:
        return c.try_cast(m.cast).alias(m.dest)
    if empty_as_null and isinstance(schema[m.src].dataType, T.StringType):
        c = nonempty(c)
    return c.alias(m.dest)


def summarize(
    df: DataFrame,
    mapping: Sequence[FieldMap],
    *,
    defaults: Mapping[str, str] | None = None,
    post_shuffle_ops: Sequence = (),
    nulls_as_zero: bool = True,
    empty_as_null: bool = True,
    combine: str = "all",
) -> DataFrame:
    """Group by the NONE fields and aggregate the rest.

    ``post_shuffle_ops`` act on key and measure columns of each row before it is
    accumulated; group keys are read-only for them, so they run before the
    exchange with the same result and rejected rows are never shuffled.
    Without any NONE field the whole input is one group, and an empty input
    gives no row.
    """
    if is_projection(mapping):
        return project(df, mapping, defaults)
    unknown = {m.method for m in mapping} - set(METHODS)
    if unknown:
        raise SpecError(f"unknown method {sorted(unknown)}")
    dests = [m.dest for m in mapping]
    if len(set(dests)) != len(dests):
        raise SpecError("duplicate target field in a grouped job")
    keys = [m for m in mapping if m.method == "NONE"]
    measures = [m for m in mapping if m.method != "NONE"]
    if post_shuffle_ops:
        df = valid_rows(apply_ops(df, post_shuffle_ops, combine, only=[m.src for m in keys]))
    schema = df.schema
    aggs = [_measure(m, schema, nulls_as_zero) for m in measures]
    if keys:
        out = df.groupBy(*[_key(m, schema, empty_as_null) for m in keys]).agg(*aggs)
    else:
        out = df.agg(*aggs, F.count(F.lit(1)).alias("_rows")).filter("_rows > 0").drop("_rows")
    return apply_defaults(out.select(*[field(d) for d in dests]), defaults)
