"""Connected components of an edge table by alternating star contraction.

Each task first joins its own edges by union-find, which leaves at most one edge per node it saw.  Then large-star
(every larger neighbour moves to the smallest one) and small-star (smaller neighbours likewise) alternate until the
edges stay the same, which is when each node has one edge to the smallest node of its component.  Rounds grow with
the logarithm of the longest path.  Every round is a written table; only its row count and a checksum reach the driver.
Once no more than ``ONE_TASK`` edges are left (a few megabytes), one union-find ends the rounds with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Emitter, keep

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class UnionFind:
    """Disjoint sets of numbers; the smallest member is the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


#: Edges that a single task may join: their nodes fit in its memory many times.
ONE_TASK = 200_000
#: Nodes a task holds before it hands on its forest and starts anew.
_HELD = 2 * ONE_TASK + 1


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, sets = Emitter(_EDGES), UnionFind()

    def stars():
        for node in list(sets.parent):
            if (root := sets.find(node)) != node:
                yield from out.add(node, root)

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(a, b)
        if len(sets.parent) > _HELD:
            yield from stars()
            sets = UnionFind()
    yield from stars()
    yield from out.flush()


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (a > b)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has two whole-number columns.  Null ends and loops are left out; no edge gives no row.
    """
    a, b = edges.columns[:2]
    clean = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = keep(clean.where("a <> b").mapInArrow(_forest, "a long, b long").distinct(), "edges")
    seen = None
    while True:
        told = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        ends = told[0] <= ONE_TASK
        if ends and told[0]:
            now = keep(now.coalesce(1).mapInArrow(_forest, "a long, b long"), "edges")
        if ends or tuple(told) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b"), F.col("b")).distinct()
            )
        seen = tuple(told)
        now = keep(_stars(now), "edges")
