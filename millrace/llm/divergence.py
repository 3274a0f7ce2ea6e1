r"""How far the sources of a language differ in their words, term by term and source by source.

Terms are runs of letters (A-Z, a-z and everything beyond ASCII), A-Z lower-cased.  A language keeps the terms of at
least ``LEAST_DOCS`` of its documents.  A group (language and source) and a language give a kept term with count ``c`` the
whole number ``p = 1 + floor(SCALE * (c + ADD) / (N + ADD * V))``, N the sum of counts over the V kept terms.  Reported
are ``abs(p - q)`` summed over all kept terms for each pair of a language's sources, and the terms that a group uses more
than its language.  Whole numbers throughout, so results don't depend on how rows are dealt out.

1. One scan counts terms in each task, in portions of ``HELD`` bytes that Arrow splits and numbers; the counts of a
   (language, source, term) are then summed in one exchange.
2. The kept terms are dealt to blocks by ranges of (language, count), which brings terms with equal counts together.
3. Run-length columns: a task has a block of terms and one or two blocks of sources.  It reorders its terms by their
   counts in all its sources, so that equal counts stand together, encodes each source's column as runs, intersects the
   run boundaries of each pair of sources and adds ``abs(p - q)`` times the length of each common run.  Terms that
   none of its sources has are one more run.  Partial sums are added up by pair.
4. The terms of a group are ranked with a limit in each task before they are shuffled, so a source with a third of
   all rows sends few.

No task holds a language or a source: a task has about ``TERMS`` terms and at most two blocks of about ``SOURCES`` sources.

Null text, language and source count as "".  A row is a document, whatever its id, so repeated rows count again.  A
group without terms has pairs and no term rows; a language without kept terms has distance 0; a language with one
source has no pair.  Empty tables give no row.  Columns other than text, language and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, gathered, keep, slices

LEAST_DOCS = 30
SCALE, ADD = 1_000_000_000, 5
TOP = 50
TERMS, SOURCES = 4096, 32
#: Bytes of text whose counts a task sums up before it hands them on.
HELD = 16 << 20

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_COUNTS_DDL = "lang string, source string, term string, n long, docs long"


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order: every byte that is no letter separates, and none lies inside a character."""
    return text.translate(_LETTERS).split()


def _long_text(text: bytes, group: tuple[str, str]) -> pa.RecordBatch:
    """Rows of one long document, a slice at a time."""
    own = Counter()
    for part in slices(text):
        own.update(terms(part))
    words, n = [t.decode("utf-8", "replace") for t in own], len(own)
    return pa.RecordBatch.from_arrays([
        pa.array([group[0]] * n, pa.string()), pa.array([group[1]] * n, pa.string()), pa.array(words, pa.string()),
        pa.array(own.values(), pa.int64()), pa.array([1] * n, pa.int64()),
    ], schema=_COUNTS)


def _letters_only(texts: pa.Array) -> pa.Array:
    """The texts with every byte that is no letter as a space, A-Z lower-cased: one pass over all their bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = memoryview(held)[offsets[0]:offsets[-1]].tobytes() if held is not None else b""
    moved = (offsets - offsets[0]).astype(np.int32).tobytes()
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(moved), pa.py_buffer(data.translate(_LETTERS))])


def _portion(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
    """Counts of the (language, source, term) triples of some documents, and in how many of them each occurs."""
    split = pc.ascii_split_whitespace(_letters_only(texts))
    words = split.values.dictionary_encode()
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    codes, size = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
    doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    real = codes != (words.dictionary.index("").as_py() if size else -1)
    codes, doc = codes[real], doc[real]
    keys, counts = np.unique(group[doc] * size + codes, return_counts=True)
    pairs = np.unique(doc * size + codes)
    docs = np.unique(group[pairs // max(size, 1)] * size + pairs % max(size, 1), return_counts=True)[1]
    at, word = keys // max(size, 1), keys % max(size, 1)
    some = np.unique(group)  # a row without term for each group
    at = np.concatenate([at, some])
    term = pa.concat_arrays([words.dictionary.take(pa.array(word)), pa.nulls(len(some), pa.string())])
    none = np.zeros(len(some), np.int64)
    return pa.RecordBatch.from_arrays([
        lang.dictionary.take(pa.array(at // len(source.dictionary))), source.dictionary.take(pa.array(at % len(source.dictionary))), term,
        pa.array(np.concatenate([counts, none])), pa.array(np.concatenate([docs, none])),
    ], schema=_COUNTS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and document counts by group and term, summed over portions of about ``HELD`` bytes.

    A group's row without term says that the group occurs.  Texts longer than a portion are counted by themselves.
    """
    for batch in gathered(batches, HELD):
        texts = batch.column(0)
        long = pc.greater(pc.binary_length(texts), HELD)
        for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)).tolist():
            yield _long_text(texts[i].as_py().encode(), (batch.column(1)[i].as_py(), batch.column(2)[i].as_py()))
        short = pc.if_else(long, "", texts)
        told = _portion(short, batch.column(1), batch.column(2))
        for start in range(0, told.num_rows, 50_000):
            yield told.slice(start, 50_000)


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n and docs (documents that hold it); every group also has a row with a null term."""
    bound_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    return rows.mapInArrow(_counted, _COUNTS_DDL).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probabilities(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """p of each count: exact for any size, by plain whole numbers where 64 bits don't hold the product."""
    below = total + ADD * kept
    if counts.max(initial=0) + ADD < (1 << 63) // SCALE:
        return 1 + (counts + ADD) * SCALE // below
    return np.array([1 + (int(c) + ADD) * SCALE // below for c in counts], np.int64)


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and values of the runs of equal numbers."""
    starts = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1])
    return starts, column[starts]


def distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> int:
    """Sum of abs(p - q) over ``n`` places, from two columns of runs: one step per common run."""
    cuts = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], cuts, side="right") - 1]
    q = b[1][np.searchsorted(b[0], cuts, side="right") - 1]
    return int((np.abs(p - q) * np.diff(cuts, append=n)).sum())


_PAIRS = pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()), ("value", pa.int64())])


def _compared(data: pa.Table) -> pa.Table:
    """A block of terms, one or two blocks of sources: the pairs' sums over the block.

    Rows without term describe sources: n is their N, ``kept`` the language's V, ``width`` the number of terms in the block.
    """
    told = data.filter(pc.is_null(data.column("term")))
    names, sides = told.column("source").to_pylist(), told.column("side").to_numpy()
    totals, kept, width = told.column("n").to_pylist(), told.column("kept")[0].as_py(), told.column("width")[0].as_py()
    rows = data.filter(pc.is_valid(data.column("term")))
    place = {name: i for i, name in enumerate(names)}
    words = rows.column("term").combine_chunks().dictionary_encode()
    found = words.indices.to_numpy() if rows.num_rows else np.zeros(0, np.int64)
    held = len(words.dictionary) if rows.num_rows else 0
    # One more place stands for all terms of the block that no source here has.
    matrix = np.zeros((len(names), held + 1), np.int64)
    matrix[[place[s] for s in rows.column("source").to_pylist()], found] = rows.column("n").to_numpy()
    order = np.lexsort(matrix[np.argsort([sum(m > 0) for m in matrix])])
    at = int(np.flatnonzero(order == held)[0])
    columns = []
    for i, total in enumerate(totals):
        starts, values = runs(matrix[i][order])
        # Behind its place, the one more place is as long as the terms it stands for.
        starts = np.where(starts > at, starts + width - held - 1, starts)
        columns.append((starts, probabilities(values, total, kept)))
    if data.column("low")[0] == data.column("high")[0]:
        pairs = [(i, j) for j in range(len(names)) for i in range(j)]
    else:
        pairs = [(i, j) for i in np.flatnonzero(sides == 0) for j in np.flatnonzero(sides == 1)]
    lang, out = data.column("lang")[0].as_py(), ([], [], [], [])
    for i, j in pairs:
        one, two = sorted((names[i], names[j]), key=str.encode)
        for column, value in zip(out, (lang, one, two, distance(columns[i], columns[j], width)), strict=True):
            column.append(value)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _PAIRS, strict=True)], schema=_PAIRS)


def source_distances(counts: DataFrame, vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, one, two (one before two), value of every pair of sources of a language.

    ``counts``: lang, source, term, n, block of kept terms.  ``vocabulary``: lang, term, block.  ``groups``: lang, source,
    total, kept.
    """
    many = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    parts = F.ceil(F.col("sources") / SOURCES).cast("int")
    own = F.pmod(F.xxhash64("source"), F.col("parts").cast("long")).cast("int")
    dealt = keep(groups.join(many, "lang").withColumn("parts", parts).select("lang", "source", "total", "kept", "parts", own.alias("part")), "dealt")
    widths = vocabulary.groupBy("lang", "block").agg(F.count("*").alias("width"))
    heads = dealt.join(widths, "lang").select("lang", "source", "block", "parts", "part", F.lit(None).cast("string").alias("term"), F.col("total").alias("n"), "kept", "width")
    zero = F.lit(0).cast("long")
    body = counts.join(dealt, ["lang", "source"]).select("lang", "source", "block", "parts", "part", "term", "n", zero.alias("kept"), zero.alias("width"))
    rows = heads.union(body).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "lang", "block", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"),
        (F.col("part") > F.col("with")).cast("int").alias("side"), "source", "term", "n", "kept", "width",
    )
    partial = rows.groupBy("lang", "block", "low", "high").applyInArrow(_compared, "lang string, one string, two string, value long")
    return partial.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: every other source (``pair``) and the ``top`` terms (``term``) of each group."""
    counts = keep(count_terms(docs), "counts")
    found = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
    found = keep(found.where(F.col("docs") >= least_docs).select("lang", "term", "all"), "vocabulary")
    size = found.count()
    ranged = found.repartitionByRange(max(1, -(-size // TERMS)), "lang", "all", "term")
    vocabulary = keep(ranged.withColumn("block", F.spark_partition_id()), "blocks")
    used = keep(counts.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n", "all", "block"), "used")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("all_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = counts.where("term is null").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = keep(groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "all_total")]), "groups")

    empty = groups.where("kept = 0").select("lang", "source")
    others = empty.withColumnRenamed("source", "other")
    nothing = empty.join(others, "lang").where("source < other").select("lang", F.col("source").alias("one"), F.col("other").alias("two"), zero.alias("value"))
    sums = source_distances(used, vocabulary, groups.where("kept > 0")).union(nothing)
    ends = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    pairs = sums.select("lang", ends.alias("end"), "value").select("lang", "end.source", "end.item", "value")

    share = lambda n, total: F.expr(
        f"1 + (cast({SCALE} as decimal(38, 0)) * ({n} + {ADD})) div ({total} + {ADD} * kept)"
    )
    shares = used.where("n > 0").join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), (share("n", "total") - share("`all`", "all_total")).cast("long").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    ranked_terms = shares.where("value > 0").withColumn("rank", rank).where(F.col("rank") <= top)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(*names)
        .union(ranked_terms.withColumn("part", F.lit("term")).select(*names))
    )
