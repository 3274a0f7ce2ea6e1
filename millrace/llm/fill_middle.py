r"""Fill-in-the-middle transformation by counted-quantifier patterns.

``regexp_count`` gives the number ``n`` of code points of a text; a keyed digest of the document id gives two cuts
``a <= b``; and one pattern made for the row, ``\A(.{a}+)(.{b-a}+)(.*+)\z``, captures prefix, middle and suffix in one
match, whose replacement writes them in the order of the form.  The quantifiers are possessive, so a match never goes
back and takes linear time; a dot is a code point, so no character is cut.  Counting goes over units of ``UNIT`` code
points and single ones after the last whole unit, so a count holds no more than a text and a little.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, and
``plain`` the text itself.  Empty texts and texts that hold one of the marks stay plain, so ``restore`` gives every text
back exactly: outside plain texts, marks stand only where the form put them.

Null texts count as empty; a null id is drawn like the id "".  Rows with equal ids get equal draws.  Empty tables give
no row.  Other columns are carried in ``doc`` whatever their names.  No exchange: one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points counted at once.
UNIT = 64


@dataclass(frozen=True)
class Marks:
    """Marks of prefix, suffix and middle: three different texts between ``<`` and ``>`` without these inside.

    That form makes sure that no mark arises where a piece of a text meets a mark.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        own = [self.prefix, self.suffix, self.middle]
        inside = [m[1:-1] for m in own]
        if len(set(own)) != 3 or any(m != f"<{i}>" or not i or set(i) & set("<>") for m, i in zip(own, inside, strict=True)):
            raise ValueError(f"marks {own} are not three different names between < and >")


def code_points(text: Column) -> Column:
    """Number of code points by counting matches: whole units, and single ones where no whole unit is left."""
    units = F.regexp_count(text, F.lit(f"(?s).{{{UNIT}}}+"))
    pieces = F.regexp_count(text, F.lit(f"(?s).{{{UNIT}}}+|."))
    return (pieces + units * (UNIT - 1)).cast("long")


def _draws(doc_id: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers of a document id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _literal(mark: str) -> str:
    """A mark as replacement text."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def _quoted(mark: str) -> str:
    return f"\\Q{mark}\\E" if "\\E" not in mark else "".join(f"\\x{{{ord(c):x}}}" for c in mark)


def fill_middle(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", changed: int = 90, suffix_first: int = 20, seed: str = "1",
    marks: Marks = Marks(), carry: list[str] | None = None,
) -> DataFrame:
    """``doc`` (the row, or its ``carry`` columns), n, form, prefix_chars, middle_chars and output.

    ``changed`` of 100 documents leave the plain form, ``suffix_first`` of 100 of those take ``spm``.
    """
    own = [F.col(f"`{c}`") for c in carry or docs.columns]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*own).alias("doc"), whole.alias("whole"), F.array(*_draws(F.col(f"`{doc_id}`"), seed)).alias("h"))
    rows = rows.withColumn("n", code_points(F.col("whole")))
    h = [F.col("h")[i] for i in range(4)]
    held = [F.contains("whole", F.lit(m)) for m in (marks.prefix, marks.suffix, marks.middle)]
    plain = (F.col("whole") == "") | held[0] | held[1] | held[2] | (h[2] % 100 >= changed)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    cut = [h[i] % (F.col("n") + 1) for i in (0, 1)]
    rows = rows.select("doc", "whole", "n", form.alias("form"), F.least(*cut).alias("a"), F.greatest(*cut).alias("b"))
    pattern = F.concat(F.lit("(?s)\\A(.{"), F.col("a"), F.lit("}+)(.{"), F.col("b") - F.col("a"), F.lit("}+)(.*+)\\z"))
    p, s, m = (_literal(x) for x in (marks.prefix, marks.suffix, marks.middle))
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    changed_row = F.col("form") != "plain"
    output = F.when(changed_row, F.regexp_replace("whole", pattern, order)).otherwise(F.col("whole"))
    return rows.select(
        "doc", "n", "form", F.when(changed_row, F.col("a")).alias("prefix_chars"),
        F.when(changed_row, F.col("b") - F.col("a")).alias("middle_chars"), output.alias("output"),
    )


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output and its form were made of."""
    p, s, m = (_quoted(x) for x in (marks.prefix, marks.suffix, marks.middle))
    psm = F.regexp_replace(output, F.lit(f"(?s)\\A{p}(.*?){s}(.*?){m}(.*+)\\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)\\A{s}(.*?){p}(.*?){m}(.*+)\\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
