"""Near-duplicate vectors: E8 lattice hashing in several tables with neighbour probing and exact cosine.

Each of ``TABLES`` tables projects a unit vector to eight Gaussian coordinates of width ``WIDTH``, shifts them and
decodes them to the nearest E8 lattice point, the vector's home cell.  A vector also visits the ``PROBES`` neighbouring
lattice points that are nearest next.  Two vectors meet in a cell if it is the home of one and the home or a visited
cell of the other.  At cosine 0.95 a pair fails to meet in all four tables with a chance of about 3 in 10,000 (measured
with random pairs of 64 dimensions), above it with less.

In a cell all pairs with a home vector are verified in double precision.  A pair that meets in several cells counts in
the first table and, within a table, in one cell, which both vectors' codes tell, so links are counted without ever
being emitted: a cell gives one count per vector and the edges to its smallest linked neighbourhood.  Cells of more
than ``BLOCK`` vectors are cut into blocks, and pairs of blocks are tasks of their own.

Equal vectors are one entry with a weight.  Null, zero and non-finite vectors link with nothing; vectors of different
lengths never link; rows that share an id count as vectors of their own, and as one node of a component.  Empty tables
give no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Emitter, bound_batches, keep, mix
from millrace.llm.components import components
from millrace.llm.vectors import matrices, usable

TABLES, PROBES, WIDTH = 4, 4, 1.6
THRESHOLD = 0.95
BLOCK = 2048


@cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or all 1/2 or -1/2 with evenly many minus signs."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a in (1.0, -1.0):
            for b in (1.0, -1.0):
                v = np.zeros(8)
                v[i], v[j] = a, b
                pairs.append(v)
    signs = 1.0 - 2.0 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.concatenate([np.array(pairs), signs[(signs < 0).sum(axis=1) % 2 == 0] / 2])


def _even(points: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum: round, and if the sum is odd round the worst entry the other way."""
    whole = np.rint(points)
    rest = points - whole
    odd = np.flatnonzero(whole.sum(axis=1) % 2 != 0)
    worst = np.abs(rest[odd]).argmax(axis=1)
    whole[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return whole


def decode(points: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of the even points and the even points shifted by one half."""
    even, half = _even(points), _even(points - 0.5) + 0.5
    nearer = ((points - even) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], even, half)


@cache
def _table(number: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([20_011, number, size])
    return draw.standard_normal((size, 8)) / WIDTH, draw.uniform(0, 1, 8)


def _name(points: np.ndarray, number: int, size: int) -> np.ndarray:
    """64-bit names of lattice points of one table."""
    whole = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    out = np.full(len(points), number + 1 + 1000 * size, np.uint64)
    for i in range(8):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + whole[:, i])
    return out.view(np.int64)


def codes(units: np.ndarray) -> np.ndarray:
    """Cells of unit vectors: (vectors, tables, 1 + probes), the home cell first."""
    size = units.shape[1]
    out = np.zeros((len(units), TABLES, 1 + PROBES), np.int64)
    near = neighbours()
    for t in range(TABLES):
        matrix, shift = _table(t, size)
        points = units @ matrix + shift
        home = decode(points)
        out[:, t, 0] = _name(home, t, size)
        cost = (near**2).sum(axis=1) - 2 * (points - home) @ near.T
        best = np.argpartition(cost, PROBES, axis=1)[:, :PROBES]
        for p in range(PROBES):
            out[:, t, 1 + p] = _name(home + near[best[:, p]], t, size)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each cell of each vector: cell, home, node."""
    for batch in batches:
        for rows, m in matrices(batch.column("embedding")):
            step = max(1, 20_000 // (TABLES * (1 + PROBES)))
            for at in range(0, len(rows), step):
                own = rows[at:at + step]
                cells = codes(unit(m[at:at + step])).reshape(len(own), -1)
                node = batch.column("node").take(pa.array(np.repeat(own, cells.shape[1])))
                home = np.tile(np.arange(cells.shape[1]) % (1 + PROBES) == 0, len(own))
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), pa.array(home), node], names=["cell", "home", "node"])


_OUT = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("count", pa.int64())])


def _first_meeting(cell: int, a: np.ndarray, b: np.ndarray, a_first: np.ndarray) -> np.ndarray:
    """Whether each pair's first common cell is this one.  a, b: codes of the pairs; a_first: a has the smaller node.

    Within a table a pair meets in its common home, else in the home of one that the other visits; if each visits
    the other's home, in the home of the first.
    """
    done = np.zeros(len(a), bool)
    here = np.zeros(len(a), bool)
    for t in range(TABLES):
        ha, hb = a[:, t, 0], b[:, t, 0]
        a_visits, b_visits = (a[:, t, 1:] == hb[:, None]).any(axis=1), (b[:, t, 1:] == ha[:, None]).any(axis=1)
        same = ha == hb
        at_a = ~same & b_visits & (~a_visits | a_first)
        at_b = ~same & a_visits & ~at_a
        met = same | at_a | at_b
        here |= ~done & met & (np.where(at_b, hb, ha) == cell)
        done |= met
    return here


def _links(cell: int, left: tuple, right: tuple | None, out: Emitter) -> Iterator[pa.RecordBatch]:
    """Links within one block or between two blocks of a cell."""
    def joined(k):
        return left[k] if right is None else np.concatenate([left[k], right[k]])

    home, node, weight, vectors = (joined(k) for k in range(4))
    units = unit(vectors)
    n, cut = len(node), len(left[0])
    close = np.triu(units @ units.T >= THRESHOLD, 1) if right is None else np.zeros((n, n), bool)
    if right is not None:
        close[:cut, cut:] = units[:cut] @ units[cut:].T >= THRESHOLD
    i, j = np.nonzero(close)
    some = home[i] | home[j]
    i, j = i[some], j[some]
    if not len(i):
        return
    used = np.unique(np.concatenate([i, j]))
    place = np.zeros(n, np.int64)
    place[used] = np.arange(len(used))
    known = codes(units[used])
    counts = np.zeros(n, np.int64)
    for at in range(0, len(i), 200_000):
        a, b = i[at:at + 200_000], j[at:at + 200_000]
        here = _first_meeting(cell, known[place[a]], known[place[b]], node[a] < node[b])
        np.add.at(counts, a[here], weight[b[here]])
        np.add.at(counts, b[here], weight[a[here]])
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    for x in used.tolist():
        yield from out.add(int(node[x]), int(node[label[x]]), int(counts[x]))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, low, high): each run is one block or a pair of blocks."""
    out, run, key = Emitter(_OUT), [], None

    def closed():
        if sum(len(r[0]) for r in run) < 2:
            return
        home, node, weight, side, size = (np.concatenate([r[k] for r in run]) for k in range(5))
        for length in np.unique(size):
            same = size == length
            vectors = np.concatenate([r[5][length] for r in run if length in r[5]])
            block, own = (home[same], node[same], weight[same], vectors), side[same]
            if key[1] == key[2]:
                yield from _links(key[0], block, None, out)
            elif 0 < own.sum() < len(own):
                yield from _links(key[0], *(tuple(x[own == s] for x in block) for s in (0, 1)), out)

    for batch in batches:
        column = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "low", "high", "home", "node", "weight", "side")}
        changed = [column[n][1:] != column[n][:-1] for n in ("cell", "low", "high")]
        bounds = np.concatenate([[0], np.flatnonzero(np.logical_or.reduce(changed)) + 1, [batch.num_rows]])
        sizes = np.diff(batch.column("embedding").offsets.to_numpy())
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            now = tuple(int(column[n][start]) for n in ("cell", "low", "high"))
            if now != key:
                yield from closed()
                run, key = [], now
            if end - start == 1 and start > 0 and end < batch.num_rows:
                continue  # alone in its block
            vectors = {m.shape[1]: m for _, m in matrices(batch.column("embedding").slice(start, end - start))}
            order = np.argsort(sizes[start:end], kind="stable")
            run.append((*(column[n][start:end][order] for n in ("home", "node", "weight", "side")), sizes[start:end][order], vectors))
    yield from closed()
    yield from out.flush()


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    spark = vectors.sparkSession
    bound_batches(spark)
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select("vec_id", F.when(usable(), F.col("embedding")).alias("embedding"))
    entries = rows.where("embedding is not null").groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    entries = keep(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")
    visits = entries.select("embedding", F.col("entry").alias("node")).mapInArrow(_visits, "cell long, home boolean, node long")
    visits = keep(visits, "visits")
    sizes = visits.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("any")).where("n > 1 and any")
    sizes = keep(sizes.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "sizes")
    # Vectors move only for visits to cells where they meet another one.
    met = keep(visits.join(sizes, "cell"), "met")
    dealt = met.join(entries.select(F.col("entry").alias("node"), "weight", "embedding"), "node")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "cell", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        (F.col("block") > F.col("with")).cast("int").alias("side"), "home", "node", "weight", "embedding",
    )
    tasks = dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    found = keep(tasks.mapInArrow(_verified, "node long, other long, count long"), "found")
    counts = found.groupBy("node").agg(F.sum("count").alias("links"))
    joined = components(found.where("node <> other").select("node", "other"))
    labels = keep(entries.select("entry", "node").join(joined.withColumnRenamed("node", "entry"), "entry"), "labels")
    smallest = keep(labels.groupBy("component").agg(F.min("node").alias("component_id")), "smallest")
    # Only linked entries meet their component; all others have no row here and keep their own id.
    linked = labels.select("entry", "component").join(smallest, "component").select("entry", "component_id")
    told = entries.join(counts.withColumnRenamed("node", "entry"), "entry", "left").join(linked, "entry", "left").select(
        "embedding", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "node").alias("component_id")
    )
    out = rows.join(told, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
