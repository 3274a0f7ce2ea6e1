"""User code on rows and lines.

Column expressions are preferred; these hooks exist for what they cannot say.
They run on Arrow batches inside tasks, never on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions.text import field
from millrace.operators.rowops import REASON, VALID

_BATCH = 10_000


def flat_map_rows(
    df: DataFrame,
    recode: Callable[[dict], Iterable[dict]],
    schema: T.StructType | str,
    *,
    configure: Callable[[], object] | None = None,
    close: Callable[[], None] | None = None,
    keep_rejects: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``recode(row) -> rows`` for every row; an empty result rejects the row.

    With ``keep_rejects`` a rejected row is passed on once, marked
    ``_valid = false``, with the columns it shares with ``schema``; otherwise it
    disappears.  ``configure`` and ``close`` frame each task.  ``partitions`` deals
    the rows out first, for a small input that Spark can't split.  Rows are plain
    Python values: whole numbers stay whole also where a column has nulls.
    """
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = target.fieldNames()
    marked = T.StructType(
        [*target.fields, T.StructField(VALID, T.BooleanType()), T.StructField(REASON, T.StringType())]
    )
    arrow = to_arrow_schema(marked)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if configure:
            configure()
        try:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    made = list(recode(dict(row)))
                    out += [{**{n: r.get(n) for n in names}, VALID: True, REASON: None} for r in made]
                    if not made and keep_rejects:
                        out.append({**{n: row.get(n) for n in names}, VALID: False, REASON: "hook gave no row"})
                    if len(out) >= _BATCH:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
        finally:
            if close:
                close()

    rows = (df.repartition(partitions) if partitions else df).mapInArrow(work, marked)
    return rows if keep_rejects else rows.drop(VALID, REASON)


def map_lines(
    df: DataFrame, line: Callable[[str], str | None], column: str = "value", partitions: int | None = None
) -> DataFrame:
    """``line(text) -> text`` before parsing; null drops the line, newlines give several lines.

    ``partitions`` deals the lines out first, for a small input that Spark can't split.
    """

    @F.pandas_udf("string")
    def hook(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else line(v))

    lines = F.explode(F.split(hook(field(column)), "\n"))
    others = [field(c) for c in df.columns if c != column]
    return (df.repartition(partitions) if partitions else df).select(lines.alias(column), *others)


def prefix_with_file_name(df: DataFrame, length: int = 8, path_column: str = "_file_path") -> DataFrame:
    """Line prefixed by the first characters of its file name, as a column expression."""
    name = F.substring_index(field(path_column), "/", -1)
    return df.withColumn("value", F.concat(F.substring(name, 1, length), F.lit(","), F.col("value")))
