"""Nearest neighbours by stable projections: a kd-tree over a few Gaussian projections, and a chi-square stop.

If x has true distance d to a query, its projected squared distance is ``d^2`` times a chi-square variable with as many
degrees of freedom as projections.  A search takes vectors in the order of their projected distance, verifies each on
the original vectors, and stops when the next projected distance ``r`` satisfies ``chi2.cdf(r^2 / d_k^2) >= sure``, where
``d_k`` is the distance of the k-th best so far: a nearer vector would lie within ``r`` with at least that chance.

1. The upper kd-tree is fitted on a bounded sample (``SAMPLE`` vectors) and its leaves are cells; every vector is dealt
   to its cell, where a finer kd-tree is built over the cell's vectors.
2. Each query searches its own cell, which bounds its k-th distance.
3. It then searches every other cell whose box lies within the stopping radius of that bound, and the best of all
   cells are ranked.

Equal vectors are one entry with their ``k + 1`` smallest ids, so copies never crowd a cell and no result is lost.
Only cells that queries ask move: the queries of a cell are cut into blocks of about ``BLOCK``, and a cell of more than
``PART`` components into parts that each of its queries asks, so no task grows with the table or with a crowded cell.

Reported distances are taken from differences, so a common offset of any size costs no digits; projections are taken
about the sample's mean and in a unit that is a power of two, so that squares neither overflow nor vanish.

Null, zero and non-finite vectors take no part; vectors of another length than the query's are no candidates; rows
with the query's own id are not candidates; ties go to the smaller id.  Empty tables give no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep
from millrace.llm.vectors import matrices, usable

PROJECTIONS = 8
SURE = 0.99
SAMPLE = 40_000
CELL = 20_000
#: Components of a cell's vectors that one task holds, about.
PART = 40_000 * 64
LEAF = 64
BLOCK = 20_000


def chi_square_quantile(p: float, freedom: int) -> float:
    """Of an even number of degrees of freedom, where the distribution function has a closed form."""
    def cdf(x: float) -> float:
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, also where squares leave its range."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        gaps = np.abs(vectors - query)
        out = np.sqrt((gaps**2).sum(axis=1))
    odd = np.flatnonzero(~((out > 1e-140) & (out < 1e150)))
    if len(odd):
        largest = gaps[odd].max(axis=1)
        held = (largest > 0) & np.isfinite(largest)
        out[odd[held]] = largest[held] * np.sqrt(((gaps[odd[held]] / largest[held, None]) ** 2).sum(axis=1))
        out[odd[~held]] = largest[~held]
    return out


class Frame:
    """Centre and unit in which vectors of one length are projected."""

    def __init__(self, sample: np.ndarray, largest: float):
        self.unit = 2.0 ** math.frexp(largest)[1] if largest and not 1e-100 < largest < 1e100 else 1.0
        self.centre = (sample / self.unit).mean(axis=0) if len(sample) else np.zeros(sample.shape[1])

    def points(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors / self.unit - self.centre) @ projection(vectors.shape[1])


@cache
def projection(size: int) -> np.ndarray:
    """The Gaussian projection of vectors of one length."""
    return np.random.default_rng(10_007 + size).standard_normal((size, PROJECTIONS))


class Cells:
    """The upper kd-tree: splits at medians of the sample; the leaves are numbered cells."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.splits: list[tuple[int, float, int, int]] = []
        self.low, self.high = [], []
        self.root = self._split(sample, np.full(PROJECTIONS, -np.inf), np.full(PROJECTIONS, np.inf), cells)

    def _split(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, cells: int) -> int:
        wide = np.ptp(points, axis=0) if len(points) else np.zeros(PROJECTIONS)
        if cells < 2 or wide.max() == 0:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)
        axis = int(wide.argmax())
        at = float(np.median(points[:, axis]))
        if not (points[:, axis] < at).any():
            at = float(points[:, axis][points[:, axis] > at].min())
        under = points[:, axis] < at
        number = len(self.splits)
        self.splits.append((axis, at, 0, 0))
        left_high, right_low = high.copy(), low.copy()
        left_high[axis] = right_low[axis] = at
        left = self._split(points[under], low, left_high, cells // 2)
        self.splits[number] = (axis, at, left, self._split(points[~under], right_low, high, cells - cells // 2))
        return number

    def of(self, points: np.ndarray) -> np.ndarray:
        out, waiting = np.zeros(len(points), np.int64), [(self.root, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            axis, at, left, right = self.splits[node]
            under = points[rows, axis] < at
            waiting += [(left, rows[under]), (right, rows[~under])]
        return out

    def within(self, point: np.ndarray, radius: float) -> np.ndarray:
        """Cells whose box is no further than this from a point."""
        low, high = np.array(self.low), np.array(self.high)
        gap = np.maximum(np.maximum(low - point, point - high), 0)
        return np.flatnonzero(np.sqrt((gap**2).sum(axis=1)) <= radius)


def fine_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points by leaf, leaf ends, and each leaf's box."""
    leaves, waiting = [], [np.arange(len(points))]
    while waiting:
        rows = waiting.pop()
        own = points[rows]
        wide = np.ptp(own, axis=0)
        if len(rows) <= LEAF or wide.max() == 0:
            leaves.append(rows)
            continue
        axis, half = int(wide.argmax()), len(rows) // 2
        order = rows[np.argpartition(own[:, axis], half)]
        waiting += [order[:half], order[half:]]
    low, high = (np.array([f(points[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    return np.concatenate(leaves), np.cumsum([len(rows) for rows in leaves]), low, high


class Cell:
    """The vectors of one cell, sorted by leaf."""

    def __init__(self, vectors: np.ndarray, frame: Frame):
        points = frame.points(vectors)
        self.unit = frame.unit
        self.order, self.ends, self.low, self.high = fine_tree(points)
        self.points, self.vectors = points[self.order], vectors[self.order]
        self.centre = (self.vectors / self.unit).mean(axis=0)
        self.near = self.vectors / self.unit - self.centre
        self.norms = (self.near**2).sum(axis=1)
        #: Rounding of a squared distance taken from norms, as a part of the two norms.
        self.rounding = 4 * (vectors.shape[1] + 4) * np.finfo(np.float64).eps

    def search(self, query: np.ndarray, point: np.ndarray, k: int, bound: float, stop: float) -> tuple[np.ndarray, np.ndarray, float]:
        """Rows of the (at least) k nearest verified vectors, their distances, and the k-th distance or ``bound``.

        Leaves come in the order of their boxes' projected distance, more of them in each step; within a step only
        vectors inside the stopping radius, ``stop`` times the k-th distance, are verified.  Verification first takes
        squares from norms about the cell's centre, with bounds of their rounding, and then the exact distance of every
        vector that these bounds leave.  ``bound`` and the k-th distance are in frame units.
        """
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        gap = np.sqrt((gap**2).sum(axis=1))
        order = np.argsort(gap, kind="stable")
        own_query = query / self.unit - self.centre
        norm = own_query @ own_query
        rows, least, most, at, step, kth = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 0, 4, bound
        while at < len(order) and gap[order[at]] <= stop * kth:
            take = order[at:at + step]
            own = np.concatenate([np.arange(self.ends[i - 1] if i else 0, self.ends[i]) for i in take])
            own = own[((self.points[own] - point) ** 2).sum(axis=1) <= (stop * kth) ** 2]
            about = self.norms[own] - 2 * (self.near[own] @ own_query) + norm
            off = (self.norms[own] + norm) * self.rounding
            rows, least, most = np.concatenate([rows, own]), np.concatenate([least, about - off]), np.concatenate([most, about + off])
            if len(rows) >= k:
                edge = np.partition(most, k - 1)[k - 1]
                kth = min(kth, math.sqrt(max(edge, 0) + 1e-300))
                left = least <= edge
                rows, least, most = rows[left], least[left], most[left]
            at, step = at + step, step * 2
        return rows, distances(self.vectors[rows], query), kth


_FOUND_DDL = "query_id long, vec_id long, score double, kth double"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("kth", pa.float64())])


def _searcher(k: int, stop: float, frames: dict[int, Frame]):
    def search(data: pa.Table, queries: pa.Table) -> pa.Table:
        """Queries of one cell and block against the cell's vectors."""
        out = [[], [], [], []]
        if data.num_rows and queries.num_rows:
            ids = data.column("ids").to_pylist()
            cells = {m.shape[1]: (rows, Cell(m, frames[m.shape[1]])) for rows, m in matrices(data.column("embedding"))}
            names, bounds = queries.column("query_id").to_pylist(), queries.column("bound").to_pylist()
            for own, asked in matrices(queries.column("embedding")):
                if asked.shape[1] not in cells:
                    continue
                rows, cell = cells[asked.shape[1]]
                points = frames[asked.shape[1]].points(asked)
                for i, query, point in zip(own, asked, points, strict=True):
                    near, exact, kth = cell.search(query, point, k + 1, bounds[i], stop)
                    hits = sorted(
                        (d, v) for d, r in zip(exact.tolist(), rows[cell.order[near]].tolist(), strict=True)
                        for v in ids[r] if v != names[i]
                    )[:k]
                    for column, values in zip(out, ([names[i]] * len(hits), [v for _, v in hits], [d for d, _ in hits], [kth] * len(hits)), strict=True):
                        column += values
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND, strict=True)], schema=_FOUND)

    return search


def _dealer(trees: dict[int, Cells], frames: dict[int, Frame]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for rows, m in matrices(batch.column("embedding")):
                # cells of vectors of different lengths are never the same
                cell[rows] = trees[m.shape[1]].of(frames[m.shape[1]].points(m)) + (m.shape[1] << 32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return deal


def _spreader(trees: dict[int, Cells], frames: dict[int, Frame], stop: float):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every further cell within its stopping radius."""
        for batch in batches:
            home, kth = batch.column("cell").to_pylist(), batch.column("kth").to_pylist()
            at, cells = [], []
            for rows, m in matrices(batch.column("embedding")):
                tree, base = trees[m.shape[1]], m.shape[1] << 32
                for i, point in zip(rows.tolist(), frames[m.shape[1]].points(m), strict=True):
                    near = tree.within(point, stop * kth[i]) + base
                    near = near[near != home[i]]
                    at += [i] * len(near)
                    cells += near.tolist()
            out = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [out.column("query_id"), out.column("embedding"), out.column("kth"), pa.array(cells, pa.int64())],
                names=["query_id", "embedding", "bound", "cell"],
            )

    return spread


def nearest(vectors: DataFrame, asked: Column, k: int = 10, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which ``asked`` holds."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    stop = math.sqrt(chi_square_quantile(sure, PROJECTIONS))
    rows = vectors.where(usable()).select("vec_id", "embedding", asked.alias("asked"))
    first = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.select("vec_id", "embedding").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    entries = keep(few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")

    largest = F.max(F.array_max(F.transform("embedding", F.abs)).cast("double"))
    told = {r["n"]: r for r in entries.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("count"), largest.alias("largest")).collect()}
    total = sum(r["count"] for r in told.values())
    share = F.pmod(F.xxhash64("embedding"), F.lit(1_000_000)) / 1_000_000.0
    sample = entries.where(share < min(1.0, SAMPLE / max(total, 1))).select("embedding").toArrow().column("embedding")
    found = {m.shape[1]: m for _, m in matrices(sample)} if len(sample) else {}
    frames = {n: Frame(found.get(n, np.zeros((0, n))), r["largest"]) for n, r in told.items()}
    # A leaf of the upper tree stands on at least 16 vectors of the sample; cells beyond that are cut into parts.
    trees = {
        n: Cells(frames[n].points(found.get(n, np.zeros((0, n)))), min(-(-r["count"] // CELL), max(1, len(found.get(n, ())) // 16)))
        for n, r in told.items()
    }

    dealt = entries.mapInArrow(_dealer(trees, frames), f"embedding {kind}, ids array<long>, cell long")
    dealt = keep(dealt, "dealt")
    asking = rows.where("asked").select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    asking = keep(asking.mapInArrow(_dealer(trees, frames), f"query_id long, embedding {kind}, cell long"), "asking")
    parts = keep(dealt.groupBy("cell").agg(F.ceil(F.sum(F.size("embedding")) / PART).alias("parts")), "parts")

    def searched(queries: DataFrame) -> DataFrame:
        """Queries against their cells; only cells that are asked move, once for each block of their queries."""
        shape = queries.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).join(parts, "cell")
        shape = keep(shape, "shape")
        number = lambda column, of: F.pmod(F.xxhash64(column), F.col(of))
        every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
        data = dealt.join(shape, "cell").withColumn("part", number("embedding", "parts")).withColumn("block", every("blocks"))
        own = queries.join(shape, "cell").withColumn("block", number("query_id", "blocks")).withColumn("part", every("parts"))
        pairs = data.select("cell", "part", "block", "embedding", "ids").groupBy("cell", "part", "block").cogroup(
            own.select("cell", "part", "block", "query_id", "embedding", "bound").groupBy("cell", "part", "block")
        )
        return pairs.applyInArrow(_searcher(k, stop, frames), _FOUND_DDL)

    one = keep(searched(asking.select("query_id", "embedding", F.lit(float("inf")).alias("bound"), "cell")), "found")
    bounds = one.groupBy("query_id").agg(F.min("kth").alias("kth"))
    more = asking.join(bounds, "query_id", "left").select("query_id", "embedding", "cell", F.coalesce("kth", F.lit(float("inf"))).alias("kth"))
    more = more.mapInArrow(_spreader(trees, frames, stop), f"query_id long, embedding {kind}, bound double, cell long")
    two = searched(keep(more.select("query_id", "embedding", "bound", "cell"), "more"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = one.union(two).select("query_id", "vec_id", "score").distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
