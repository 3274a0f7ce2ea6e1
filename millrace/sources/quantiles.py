"""Split points at quantiles of a key, so that ranges hold about as many rows however skewed the key is.

A Spark table's numbers, dates and times go through Spark's mergeable percentile sketch, in one pass with a partial
sketch in each task.  Text has no such sketch: its points are those of a uniform sample of ``PER_RANGE`` rows a range, in
Spark's order by bytes.  A database is asked for the points itself (``NTILE`` over its own order), so points and later
comparisons follow one collation, whatever it is.

Points are strictly ascending.  A value held by more rows than a range should have is one point, and one range of its
own at most; null keys go to the first range, as with even steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.text import field
from millrace.session import collect_small

#: Sketch accuracy: ranks are off by at most a 1 / ACCURACY of all rows.
ACCURACY = 10_000
#: Sampled rows for each range of a text key: a range's size then varies by about 4 %.
PER_RANGE = 600


def quantile_points(df: DataFrame, column: str, n: int) -> list:
    """Inner bounds of at most ``n`` ranges of about equal row counts."""
    if n < 2:
        return []
    key, kind = field(column), df.schema[column].dataType
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        shares = F.array(*[F.lit(i / n) for i in range(1, n)])
        found = df.agg(F.percentile_approx(key, shares, ACCURACY).alias("p"), F.min(key).alias("low")).first()
        points, low = found["p"] or [], found["low"]
    elif isinstance(kind, T.StringType):
        told = df.agg(F.count(key).alias("n"), F.min(key).alias("low")).first()
        wanted, low = n * PER_RANGE, told["low"]
        # The sample's size varies by its square root; the bound is far above.
        rate = min(1.0, wanted / max(told["n"], 1))
        sample = df.where(key.isNotNull()).select(key.alias("k")).where(F.rand(17) < rate)
        kept = sorted((r["k"] for r in collect_small(sample, 2 * wanted + 1000, "sampled keys")), key=str.encode)
        points = [kept[len(kept) * i // n] for i in range(1, n)] if kept else []
    else:
        raise ValueError(f"a key of type {kind.simpleString()} has no ranges")
    ordered = dict.fromkeys(points)
    return [p for p in ordered if p != low]


def quantile_query(relation: str, column: str, n: int) -> str:
    """SQL for the points of a source, in the source's own order: one row a range, the first range's point left out."""
    tiles = f"SELECT {column} AS k, NTILE({n}) OVER (ORDER BY {column}) AS tile FROM {relation} WHERE {column} IS NOT NULL"
    return f"SELECT DISTINCT k FROM (SELECT tile, MIN(k) AS k FROM ({tiles}) tiles GROUP BY tile) points WHERE tile > 1 AND k > (SELECT MIN({column}) FROM {relation}) ORDER BY k"
