r"""Lines that many documents share are dropped, except in one of these documents.

Texts are split at ``\n``; a line's key is the line without ASCII white space at both ends, A-Z lower-cased.  Keys of at
least ``LEAST_CHARS`` code points that at least ``LEAST_DOCS`` documents hold lose their lines in every document but the
one with the largest id.  Other lines stay, in their order.

1. One scan explodes the lines, hashes their keys (the first 128 bits of SHA-256) and writes hash, document, row and
   position of every line that is long enough.
2. An aggregate counts rows by hash, with partial counts in each task, so a line that a third of all documents hold
   is one row per task.  Fewer lines than ``LEAST_DOCS`` can't be fewer documents more often, so only hashes with enough
   lines go on.
3. On the lines of those hashes alone distinct documents are counted and the largest is taken.  These joins have one
   row per hash on one side and written tables on both, so adaptive execution splits a hot hash.
4. The positions that go are gathered by row, a number per line of that row, and each text is put together from the
   positions that stay.  A row is named by a digest of its id and text: equal rows lose the same lines.

All of it are columns.  Null and empty texts are one empty line.  Rows with equal ids are one document; rows without id
are one document, before all others.  Empty tables give no row.  Other columns are carried in ``doc`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep

LEAST_CHARS = 40
LEAST_DOCS = 5
#: Fixed value: ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The form in which lines are compared."""
    return F.translate(F.btrim(line, F.lit(SPACE)), _UPPER, _LOWER)


def _digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def _row(doc_id: Column, text: Column) -> Column:
    return _digest(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def frequent_lines(lines: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """Lines (hash, doc_id, row, position) of hashes with enough lines, and the hashes in enough documents with the
    largest id (hash, keeper)."""
    often = keep(lines.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= least_docs).select("hash"), "often")
    held = keep(lines.join(often, "hash"), "held")
    each = held.select("hash", "doc_id").distinct()
    frequent = each.groupBy("hash").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= least_docs)
    return held, keep(frequent.select("hash", "keeper"), "frequent")


def drop_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
    carry: list[str] | None = None,
) -> DataFrame:
    """``doc`` (the row, or its ``carry`` columns), n_lines, n_dropped and kept, the text of the lines that stay."""
    own, name = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]), F.col(f"`{doc_id}`")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(name.alias("doc_id"), _row(name, whole).alias("row"), whole.alias("whole"))
    lines = rows.select("doc_id", "row", F.posexplode(_split(F.col("whole"))).alias("position", "line"))
    # A line is no shorter than its key, so most short lines are left before a key is made.
    lines = lines.where(F.length("line") >= least_chars).withColumn("key", line_key(F.col("line")))
    lines = lines.where(F.length("key") >= least_chars).select(_digest(F.col("key")).alias("hash"), "doc_id", "row", "position")
    lines = keep(lines, "lines")
    held, frequent = frequent_lines(lines, least_docs)
    gone = held.join(frequent, "hash").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = keep(gone.groupBy("row").agg(F.collect_set("position").alias("gone")), "gone")
    # The lines are a column below the join, so that the expression above reads them and doesn't split a text per line.
    parts = docs.select(own.alias("doc"), _row(name, whole).alias("row"), _split(whole).alias("lines"))
    none = F.array().cast("array<int>")
    joined = parts.join(gone, "row", "left").select("doc", "lines", F.coalesce("gone", none).alias("gone"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.transform(F.array_except(places, F.col("gone")), lambda i: F.get("lines", i))
    kept = F.when(F.size("gone") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(stay, "\n"))
    return joined.select(
        "doc", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), kept.alias("kept")
    )
