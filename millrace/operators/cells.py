"""Wide-column tables as cell frames ``(row_key, family, qualifier, ts, value)``."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.rules import execute
from millrace.functions.text import field, template
from millrace.plans.spec import SpecError


@dataclass(frozen=True)
class CellColumn:
    """One cell per row: ``fields`` joined by the separator under family:qualifier."""

    family: str
    qualifier: str
    fields: tuple[str, ...]


def parse_layout(text: str) -> list[CellColumn]:
    """``[family:qualifier:[a,b]]-[family:qualifier:[c]]``."""
    out, end = [], 0
    for m in re.finditer(r"\[([^:\[\]]+):([^:\[\]]+):\[([^\[\]]+)\]\](?:-|$)", text):
        if m.start() != end:
            break
        end = m.end()
        out.append(CellColumn(m.group(1), m.group(2), tuple(f.strip() for f in m.group(3).split(","))))
    if not out or end != len(text):
        raise SpecError(f"cell layout {text!r} is not [family:qualifier:[a,b]]-[...]")
    names = [f for c in out for f in c.fields]
    if len(set(names)) != len(names):
        raise SpecError("a field is packed into more than one cell")
    return out


def row_key(rule: str, df: DataFrame) -> Column:
    """Row key from a template, or from an ``exec:`` expression (null on failure)."""
    return execute(rule, df.schema) if rule.startswith("exec:") else template(rule, df.schema)


def pack(fields: Sequence[str], sep: str = ",") -> Column:
    """Fields joined into one text value, null as ""."""
    return F.concat_ws(sep, *[F.coalesce(field(f).cast("string"), F.lit("")) for f in fields])


def unpack(value: Column, fields: Sequence[str], sep: str = ",") -> list[Column]:
    """Inverse of ``pack``: missing pieces are "", surplus separators stay in the last field."""
    if len(fields) == 1:
        return [value.alias(fields[0])]
    parts = F.split(value, re.escape(sep), len(fields))
    # the split stands outside any condition, so that it is evaluated once for all fields
    missing = F.when(value.isNotNull(), F.lit(""))
    return [F.coalesce(F.get(parts, F.lit(i)), missing).alias(f) for i, f in enumerate(fields)]


def to_cells(df: DataFrame, key: Column, layout: Sequence[CellColumn], ts: Column, sep: str = ",") -> DataFrame:
    """One cell per row and layout entry; rows whose key is null are skipped. No shuffle."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c.family).alias("family"), F.lit(c.qualifier).alias("qualifier"), pack(c.fields, sep).alias("value")
            )
            for c in layout
        ]
    )
    return (
        df.select(key.alias("row_key"), ts.alias("ts"), F.explode(cells).alias("cell"))
        .filter(F.col("row_key").isNotNull())
        .select("row_key", "cell.family", "cell.qualifier", "ts", "cell.value")
    )


def scan(
    cells: DataFrame,
    *,
    start_row: str | None = None,
    stop_row: str | None = None,
    min_ts=None,
    max_ts=None,
    at_ts=None,
    families: Sequence[str] = (),
    columns: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Row range [start, stop), time range [min, max) or exact time, families, columns.

    All are plain comparisons, so Parquet row groups outside the range are skipped.
    """
    conds = []
    if start_row is not None:
        conds.append(F.col("row_key") >= F.lit(start_row))
    if stop_row is not None:
        conds.append(F.col("row_key") < F.lit(stop_row))
    if at_ts is not None:
        conds.append(F.col("ts") == F.lit(at_ts))
    else:
        if min_ts is not None:
            conds.append(F.col("ts") >= F.lit(min_ts))
        if max_ts is not None:
            conds.append(F.col("ts") < F.lit(max_ts))
    wanted = []
    if families:
        wanted.append(F.col("family").isin(*families))
    wanted += [(F.col("family") == f) & (F.col("qualifier") == q) for f, q in columns]
    if wanted:
        conds.append(reduce(lambda a, b: a | b, wanted))
    return cells.filter(reduce(lambda a, b: a & b, conds)) if conds else cells


_COMPARE = {
    "LESS": lambda c, v: c < v,
    "LESS_OR_EQUAL": lambda c, v: c <= v,
    "EQUAL": lambda c, v: c == v,
    "NOT_EQUAL": lambda c, v: c != v,
    "GREATER_OR_EQUAL": lambda c, v: c >= v,
    "GREATER": lambda c, v: c > v,
    "NO_OP": lambda c, v: F.lit(True),
}


@dataclass(frozen=True)
class CellFilter:
    """Keep rows whose latest family:qualifier value compares as asked (by UTF-8 bytes).

    Rows without the cell are kept unless ``drop_if_missing``.  ``NO_OP`` keeps
    every row that has the cell.
    """

    family: str
    qualifier: str
    op: str
    value: str
    drop_if_missing: bool = False

    def __post_init__(self):
        if self.op not in _COMPARE:
            raise SpecError(f"unknown comparison {self.op!r}")

    @property
    def applies(self) -> Column:
        return (F.col("family") == self.family) & (F.col("qualifier") == self.qualifier)

    def passes(self, latest: Column) -> Column:
        ok = _COMPARE[self.op](latest, F.lit(self.value))
        return F.when(latest.isNull(), F.lit(not self.drop_if_missing)).otherwise(ok)


# Fixed value: the only filter type that has an effect.
VALUE_FILTER_TYPE = "17"


def parse_filters(text: str) -> list[CellFilter]:
    """``[filterType:17,family:f,qualifier:q,compareOp:EQUAL,value:v]-[...]``.

    Any other filter type is an error: a filter that was asked for is not ignored.
    """
    out = []
    for body in re.findall(r"\[([^\[\]]*)\]", text):
        parts = dict(p.split(":", 1) for p in body.split(",") if ":" in p)
        if parts.get("filterType") != VALUE_FILTER_TYPE:
            raise SpecError(f"cell filter type {parts.get('filterType')!r} is not available")
        try:
            out.append(CellFilter(parts["family"], parts["qualifier"], parts["compareOp"], parts["value"]))
        except KeyError as e:
            raise SpecError(f"cell filter {body!r} lacks {e}") from None
    if not out:
        raise SpecError(f"no cell filter in {text!r}")
    return out


def _latest(cond: Column) -> Column:
    """Value of the newest cell that meets ``cond`` (larger text on equal time)."""
    return F.max(F.when(cond, F.struct("ts", "value")))["value"]


def filter_rows(cells: DataFrame, filters: Sequence[CellFilter]) -> DataFrame:
    """Cells of the rows that pass every filter.

    Only cells of the filtered columns are aggregated.  Rows to drop are found
    and removed by an anti join; with a ``drop_if_missing`` filter the rows to
    keep are found and a semi join is used.
    """
    relevant = cells.filter(reduce(lambda a, b: a | b, [f.applies for f in filters]))
    flags = relevant.groupBy("row_key").agg(*[_latest(f.applies).alias(f"v{i}") for i, f in enumerate(filters)])
    passed = reduce(lambda a, b: a & b, [f.passes(F.col(f"v{i}")) for i, f in enumerate(filters)])
    if any(f.drop_if_missing for f in filters):
        return cells.join(flags.filter(passed).select("row_key"), "row_key", "left_semi")
    return cells.join(flags.filter(~passed).select("row_key"), "row_key", "left_anti")


def read_rows(
    cells: DataFrame,
    layout: Sequence[CellColumn],
    sep: str = ",",
    filters: Sequence[CellFilter] = (),
) -> DataFrame:
    """Rows back from cells: latest value of each layout column, unpacked to its fields.

    Value filters are decided in the same aggregation, so scan, filter and
    reshape take one shuffle on the row key.
    """
    aggs = [_latest((F.col("family") == c.family) & (F.col("qualifier") == c.qualifier)).alias(f"c{i}")
            for i, c in enumerate(layout)]
    aggs += [_latest(f.applies).alias(f"v{i}") for i, f in enumerate(filters)]
    needed = {(c.family, c.qualifier) for c in layout} | {(f.family, f.qualifier) for f in filters}
    rows = scan(cells, columns=sorted(needed)).groupBy("row_key").agg(*aggs)
    if filters:
        rows = rows.filter(reduce(lambda a, b: a & b, [f.passes(F.col(f"v{i}")) for i, f in enumerate(filters)]))
    out = [F.col("row_key")]
    present = reduce(lambda a, b: a | b, [F.col(f"c{i}").isNotNull() for i in range(len(layout))])
    for i, c in enumerate(layout):
        out += unpack(F.col(f"c{i}"), c.fields, sep)
    return rows.filter(present).select(*out)


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Cells without the rows named in ``keys.row_key``."""
    return cells.join(keys.select("row_key").distinct(), "row_key", "left_anti")


def region_of(key: Column, splits: Sequence[str]) -> Column:
    """Number of the key range a row belongs to: how many of the sorted split points are at or below its key.

    A binary search as a column, so a thousand ranges cost ten comparisons a row.
    """
    points = sorted(set(splits), key=str.encode)
    if not points:
        return F.lit(0)
    table = F.lit(points)
    steps = F.sequence(F.lit(1), F.lit(len(points).bit_length()))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(points)).alias("high"))

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        above = F.get(table, middle) <= key
        open_ = at["low"] < at["high"]
        return F.struct(
            F.when(open_ & above, middle + 1).otherwise(at["low"]).alias("low"),
            F.when(open_ & ~above, middle).otherwise(at["high"]).alias("high"),
        )

    return F.aggregate(steps, start, step, lambda at: at["low"])


def sort_for_bulk(cells: DataFrame, partitions: int | None = None, first: str | None = None) -> DataFrame:
    """Key ranges, each sorted by row, family, qualifier and newest first.

    The range covers the whole sort key: a row key with very many cells is
    spread over several ranges and the files stay in global order.  ``first``
    names a column that comes before the key.
    """
    order = [*([field(first)] if first else []), F.col("row_key"), F.col("family"), F.col("qualifier"), F.col("ts").desc()]
    ranged = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)
