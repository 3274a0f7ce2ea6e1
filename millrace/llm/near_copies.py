"""Near-duplicate documents: SuperMinHash signatures, banding, exact confirmation, components.

A document's set is its distinct five-word shingles (words between ASCII white space, A-Z lower-cased; a text of
fewer words is one shingle).  Two documents are linked if ``100 * |A and B| >= 75 * |A or B|``, which is confirmed on
the full sets of 64-bit shingle hashes.

1. One scan makes each row's set size, 128-bit set key and signature.  SuperMinHash draws, for each element, a random
   permutation of the slots; the j-th slot of the permutation is offered ``j + r_j``.  All elements go through level
   ``j`` together and a document stops at the first level after which none of its slots is open.
2. Rows with equal sets are one class, so copies never meet as pairs.
3. Each of ``BANDS`` bands of ``ROWS`` slots is a bucket.  A pair with similarity 0.75 shares no bucket with a chance
   of about 2 in 10,000.
4. Each class is first compared with the hub of each of its buckets, the class that shares most buckets with others.
   A large group of near copies joins at once through the text it was copied from.
5. Buckets that still hold several components are compared inside tasks, by signatures only: large buckets are cut
   into blocks of ``BLOCK`` classes and each pair of blocks is a task's work.  Only pairs of different components leave
   a task, if their signatures agree in at least ``SIEVE`` of the slots (3.7 standard deviations below 0.75: 1 in
   10,000) and their ``LEAST`` smallest shingle hashes fit the link rule: exactly, for sets of no more shingles, else
   within 4.5 standard deviations of that sample.
6. Candidates are confirmed on the two whole texts, the most similar ``BEST`` of each class first; links are joined
   into components and candidates within one component drop out.  Each further round takes four times as many of each
   class, so all are done after a few rounds.

Null, empty and word-free texts have no shingle and link with nothing.  Rows that share a document id are one document
for the components.  Null ids: the row is its own component (null).  Empty tables give no row.  Other columns of the
documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Emitter, bound_batches, keep, mix, slices, utf8
from millrace.llm.components import components

WORDS = 5
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
SIEVE = 100 / 160
BLOCK = 1024
LEAST = 256
BEST = 4

_SALTS = mix(np.arange(1, WORDS + 3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, 2 * SLOTS + 1, 2, dtype=np.uint64) * _STEP
_UNIT = float(2.0**-53)


_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: A random 64-bit value for each byte; white space counts nothing.
_BYTES = np.where(_SPACE, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)))
_BASE = 0xF1357AEA2E62A9C5
#: Bytes hashed at once; a longer slice, which holds a long word, is hashed in pieces.
_PIECE = 4 << 20


class Shingler:
    """Sorted distinct shingle hashes of a text.

    A word's hash is the polynomial of its bytes' random values modulo 2^64, taken for all words at once from running
    sums: the sum over the word times the base's inverse power at its start.  The sum of a word that runs over the end
    of a piece is carried on to the next one, so hashes depend on the word only.
    """

    def __init__(self):
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int):
        steps = np.full(2 * n, _BASE, np.uint64), np.full(2 * n, pow(_BASE, -1, 1 << 64), np.uint64)
        for step in steps:
            step[0] = 1
        self.power, self.inverse = (np.cumprod(step) for step in steps)

    def _sums(self, part: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum, start and end of every word of a piece."""
        if len(part) >= len(self.power):
            self._grow(len(part) + 1)
        data = np.frombuffer(part, np.uint8)
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = turns[::2], turns[1::2]
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.power[:len(data)], out=run[1:])
        return (run[ends] - run[starts]) * self.inverse[starts], starts, ends

    def _words(self, part: bytes) -> np.ndarray:
        out, carried, held = [], 0, 0  # sum and length of a word that runs on
        for at in range(0, len(part) or 1, _PIECE):
            piece = part[at:at + _PIECE]
            sums, starts, ends = self._sums(piece)
            sizes = (ends - starts).astype(np.uint64)
            if held:
                if not len(starts) or starts[0]:
                    sums, sizes = (np.concatenate([np.array([x], np.uint64), own]) for x, own in ((carried, sums), (held, sizes)))
                else:
                    sums[0] = (carried + int(sums[0]) * pow(_BASE, held, 1 << 64)) % (1 << 64)
                    sizes[0] += np.uint64(held)
            carried = held = 0
            if len(ends) and ends[-1] == len(piece) and at + _PIECE < len(part):
                carried, held, sums, sizes = int(sums[-1]), int(sizes[-1]), sums[:-1], sizes[:-1]
            out.append(mix(sums + sizes))
        return out[0] if len(out) == 1 else np.concatenate(out)

    def shingles(self, text: bytes | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        parts = [self._words(part) for part in slices(text.lower())]
        w = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if len(w) >= WORDS:
            n = len(w) - WORDS + 1
            total = w[:n] * _SALTS[0]
            for i in range(1, WORDS):
                total += w[i:i + n] * _SALTS[i]
        elif len(w):
            total = (w * _SALTS[:len(w)]).sum(keepdims=True) + _SALTS[WORDS:WORDS + 1] * np.uint64(len(w))
        else:
            return w
        total = np.sort(mix(total))
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash values, one row of ``SLOTS`` per set; an empty set's row is infinite.

    Level j of an element draws r_j and the slot to swap into place j from its own random stream, so equal elements
    offer equal values everywhere.  Elements of finished documents leave after each level.
    """
    best = np.full((len(sets), SLOTS), np.inf)
    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return best
    flat, element = best.ravel(), np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)) * SLOTS, sizes)
    order = None
    for level in range(SLOTS):
        draw = mix(element + _STEPS[level])
        value = (draw >> np.uint64(11)).astype(np.float64) * _UNIT + level
        swap = level + (mix(draw ^ _STEP) % np.uint64(SLOTS - level)).astype(np.int64)
        if level == 0:
            slot = swap
        else:
            if level == 1:
                order = np.broadcast_to(np.arange(SLOTS, dtype=np.uint8), (len(element), SLOTS)).copy()
                own = np.arange(len(element))
                order[own, first] = 0
                order[:, 0] = first
            own = np.arange(len(element))
            slot = order[own, swap].astype(np.int64)
            order[own, swap] = order[own, level]
        np.minimum.at(flat, row + slot, value)
        open_rows = ~np.isfinite(best).all(axis=1)
        live = open_rows[row // SLOTS]
        if not live.any():
            break
        if level == 0:
            first = swap[live].astype(np.uint8)
        if not live.all() or level == 0:
            element, row = element[live], row[live]
            order = None if order is None else order[live]
    return best


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band of each row."""
    bits = mix(signature.view(np.uint64)).reshape(len(signature), BANDS, ROWS)
    mixed = np.zeros(bits.shape[:2], np.uint64)
    for i in range(ROWS):
        mixed = mix(mixed * _SALTS[0] + bits[:, :, i])
    return mix(mixed + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)


_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.binary()), ("buckets", pa.list_(pa.int64())),
])
_ROWS_DDL = "doc_id long, n_shingles long, set_key binary, sketch binary, buckets array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()

    def rows(ids, sets):
        values = signatures(sets)
        sketch = (mix(values.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
        bucket = bands(values)
        empty = [len(s) == 0 for s in sets]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([None if e else xxhash.xxh3_128_digest(s.tobytes()) for e, s in zip(empty, sets, strict=True)], pa.binary()),
            pa.array([None if e else x.tobytes() for e, x in zip(empty, sketch, strict=True)], pa.binary()),
            pa.array([None if e else x for e, x in zip(empty, bucket, strict=True)], pa.list_(pa.int64())),
        ], schema=_ROWS)

    for batch in batches:
        ids, sets, held = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            ids.append(doc_id)
            sets.append(shingler.shingles(text))
            held += len(sets[-1])
            if held > 100_000:
                yield rows(ids, sets)
                ids, sets, held = [], [], 0
        if ids:
            yield rows(ids, sets)


def sign(docs: DataFrame) -> DataFrame:
    """Set size, set key, sketch and buckets of every row."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_signed, _ROWS_DDL)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of hubs and members whose sketches (columns 2 and 3) are alike."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (2, 3))
        yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= SIEVE))


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class and its ``LEAST`` smallest shingle hashes, filled up with the largest number."""
    shingler = Shingler()
    for batch in batches:
        held = []
        for text in utf8(batch.column(1)):
            own = np.full(LEAST, _NONE)
            first = shingler.shingles(text)[:LEAST]
            own[:len(first)] = first
            held.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], names=["class", "smallest"])


def fits(own: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each other set may be linked, from the smallest hashes of both.

    Below the smaller of the two last hashes both samples are complete, so they tell intersection and union there.
    """
    top = np.minimum(own[-1], others[:, -1])
    at = np.minimum(np.searchsorted(own, others), LEAST - 1)
    both = ((own[at] == others) & (others < _NONE)).sum(axis=1)
    mine, theirs = np.searchsorted(own[own < _NONE], top, side="right"), ((others <= top[:, None]) & (others < _NONE)).sum(axis=1)
    union = mine + theirs - both
    whole = (size <= LEAST) & (sizes <= LEAST)
    return np.where(whole, 100 * both >= 75 * union, both >= 0.75 * union - 4.5 * np.sqrt(0.1875 * union))


_NONE = np.uint64(2**64 - 1)
_CANDIDATES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("same", pa.int32())])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, low, high): each run is one block or two; pairs of different components leave."""
    out, run, key = Emitter(_CANDIDATES), [], None

    def closed():
        if sum(len(r[0]) for r in run) < 2:
            return
        name, component, side, size, sketch, smallest = (np.concatenate([r[k] for r in run]) for k in range(6))
        one = key[1] == key[2]
        for i in range(len(name)):
            # Within a block each pair once, between blocks only pairs across.
            others = np.arange(i + 1, len(name)) if one else np.flatnonzero((side == 1) & (side[i] == 0))
            others = others[component[others] != component[i]]
            if len(others):
                same = (sketch[others] == sketch[i]).sum(axis=1)
                near = np.flatnonzero(same >= SIEVE * SLOTS)
                if len(near):
                    near = near[fits(smallest[i], size[i], smallest[others[near]], size[others[near]])]
                for j in near.tolist():
                    x, y = int(name[i]), int(name[others[j]])
                    yield from out.add(min(x, y), max(x, y), int(same[j]))

    for batch in batches:
        column = {n: batch.column(n).to_numpy() for n in ("bucket", "low", "high", "class", "component", "side", "n_shingles")}
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
        smallest = np.frombuffer(b"".join(batch.column("smallest").to_pylist()), np.uint64).reshape(-1, LEAST)
        changed = [column[n][1:] != column[n][:-1] for n in ("bucket", "low", "high")]
        bounds = np.concatenate([[0], np.flatnonzero(np.logical_or.reduce(changed)) + 1, [batch.num_rows]]).tolist()
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            now = tuple(int(column[n][start]) for n in ("bucket", "low", "high"))
            if now != key:
                yield from closed()
                run, key = [], now
            run.append((*(column[n][start:end] for n in ("class", "component", "side", "n_shingles")), sketch[start:end], smallest[start:end]))
    yield from closed()
    yield from out.flush()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """The link rule on two full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= 75 * (len(a) + len(b) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler, out = Shingler(), Emitter(_PAIRS)
    last, last_set = None, None
    for batch in batches:
        for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
            if last != x:
                last, last_set = x, shingler.shingles(x)
            if alike(last_set, shingler.shingles(y)):
                yield from out.add(a, b)
    yield from out.flush()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that the link rule confirms on their whole texts."""
    texted = pairs.select("a", "b").join(texts.select(F.col("class").alias("b"), F.col("text").alias("y")), "b")
    texted = texted.join(texts.select(F.col("class").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")
    return texted.mapInArrow(_confirm, "a long, b long")


def _with_components(rows: DataFrame, joined: DataFrame, name: str) -> DataFrame:
    """``rows`` with the component of the class in column ``name``, as ``component``."""
    found = rows.join(joined.withColumnRenamed("node", name), name, "left")
    return found.withColumn("component", F.coalesce("component", name))


def _candidates(members: DataFrame, classes: DataFrame, texts: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs of different components whose sketches are alike: a, b, same (slots that agree)."""
    now = keep(_with_components(members.select("bucket", "class"), joined, "class"), "members")
    mixed = now.groupBy("bucket").agg(F.count("*").alias("size"), F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = mixed.where("least <> most").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    live = keep(now.join(mixed, "bucket"), "live")
    smallest = texts.join(live.select("class").distinct(), "class", "left_semi").select("class", "text")
    smallest = smallest.mapInArrow(_smallest, "class long, smallest binary")
    rows = live.join(classes.select("class", "sketch", "n_shingles"), "class").join(smallest, "class")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        (F.col("block") > F.col("with")).cast("int").alias("side"), "class", "component", "n_shingles", "sketch", "smallest",
    )
    tasks = rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return tasks.mapInArrow(_within, "a long, b long, same int").distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    What moves: a sketch and 32 bucket numbers per class, the bucket members that meet another class, and the texts
    of classes that have a candidate.  Sets themselves are never stored.
    """
    signed = keep(sign(docs), "signed")
    named = signed.where("n_shingles > 0 and doc_id is not null")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("class"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("buckets").alias("buckets"))
    classes = keep(classes, "classes")
    rows = classes.select("class", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = keep(rows.join(shared, "bucket").select("bucket", "class", "size"), "members")
    weights = members.groupBy("class").agg(F.sum("size").alias("weight"))
    weighed = members.select("bucket", "class").join(weights, "class")
    hubs = weighed.groupBy("bucket").agg(F.max_by("class", F.struct("weight", -F.col("class"))).alias("hub"))
    texts = docs.select(F.col("doc_id").alias("class"), "text").join(weights.select("class"), "class", "left_semi")
    texts = keep(texts.withColumn("hash", F.xxhash64("text")).dropDuplicates(["class", "hash"]).drop("hash"), "texts")

    pairs = members.join(hubs, "bucket").where("class <> hub").select(F.col("hub").alias("a"), F.col("class").alias("b")).distinct()
    sketches = classes.select("class", "sketch")
    pairs = pairs.join(sketches.select(F.col("class").alias("a"), F.col("sketch").alias("x")), "a")
    pairs = pairs.join(sketches.select(F.col("class").alias("b"), F.col("sketch").alias("y")), "b").select("a", "b", "x", "y")
    pairs = keep(pairs.mapInArrow(_sieve, "a long, b long"), "pairs")
    # Rows of one id with different sets are one document: their classes belong together.
    twins = named.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high")
    twins = named.join(twins.select("doc_id"), "doc_id", "left_semi").join(classes.select("set_key", "class"), "set_key")
    twins = twins.join(twins.groupBy("doc_id").agg(F.min("class").alias("a")), "doc_id").select("a", F.col("class").alias("b"))
    joined = components(_confirmed(pairs, texts).union(twins))

    rest = keep(_candidates(members, classes, texts, joined).join(pairs, ["a", "b"], "left_anti"), "candidates")
    number = BEST
    while not rest.isEmpty():
        best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("same"), "b"))
        ranked = keep(rest.withColumn("place", best), "ranked")
        found = _confirmed(ranked.where(F.col("place") <= number), texts)
        joined = components(found.union(joined.where("node <> component")))
        left = _with_components(ranked.where(F.col("place") > number).select("a", "b", "same"), joined, "a").withColumnRenamed("component", "c")
        number *= 4
        rest = keep(_with_components(left, joined, "b").where("component <> c").select("a", "b", "same"), "candidates")
    out = signed.join(classes.select("set_key", "class"), "set_key", "left")
    out = out.join(joined.withColumnRenamed("node", "class"), "class", "left")
    component = F.coalesce("component", "class", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
