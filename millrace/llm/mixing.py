"""Mixing sources to target weights by iterative proportional fitting (raking).

Token weights are summed per cell of the categories (source, language, topic); each round scales the cells to each
category's target shares in turn until all margins hold.  A cell's fitted share over its mass, scaled to the wanted
number of tokens and at most 1, is its documents' probability; a keyed hash of the document id decides, so a run can
be repeated and a document's fate doesn't depend on its neighbours.

Targets are shares per category value, or an exponent: observed shares to that power (below 1 lifts rare values).
Targets of absent values count nothing and the rest is scaled to 1; present values without a target get none of the
sample.  Null and "" are one value.  Null texts have weight 1, as has every shorter text than four characters.  Rows
with one id share their fate.  Empty tables give no row.  Margins that contradict each other end after ``rounds`` with
the last category's shares exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep


def token_weight(text: str = "text") -> Column:
    """About the number of tokens of a text: a quarter of its characters."""
    return F.greatest(F.lit(1), F.ceil(F.length(F.coalesce(F.col(text), F.lit(""))) / 4)).cast("long")


def topic_of(text: str = "text") -> Column:
    """Coarse topic by what a text holds: license lines, table rows, shouted or decorated lines, else prose."""
    t = F.coalesce(F.col(text), F.lit(""))
    legal = t.contains("Licensed under") | t.contains("is licensed under") | t.contains("All rights reserved")
    marked = t.contains("!!") | t.contains("***") | t.contains("%%%")
    return F.when(legal, "legal").when(t.contains(" | "), "table").when(marked, "marked").otherwise("prose")


def _margins(cells: DataFrame, name: str, target: float | dict[str, float]) -> DataFrame:
    """(name, share) of the values that are present, summing to 1."""
    seen = cells.groupBy(name).agg(F.sum("mass").alias("mass"))
    if isinstance(target, dict):
        wanted = F.create_map([x for k, v in target.items() for x in (F.lit(k), F.lit(float(v)))]) if target else None
        share = F.coalesce(wanted[F.col(name)], F.lit(0.0)) if target else F.lit(0.0)
    else:
        share = F.pow("mass", F.lit(float(target)))
    total = seen.agg(F.sum(share)).first()[0]
    return seen.select(name, (share / F.lit(float(total or 1.0))).alias(f"t_{name}"))


def fit(cells: DataFrame, targets: dict[str, float | dict[str, float]], tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """Cells with ``fitted``, their share of the mix, until all margins are met within ``tolerance``.

    Cells are far fewer than documents, but stay distributed: a category's margins are an aggregate with partial sums
    in each task, written and joined back, so a value that most cells share is no task of its own.  The margins found
    before a round's steps tell whether the round before it had ended.
    """
    for name, target in targets.items():
        cells = cells.join(_margins(cells, name, target), name)
    cells = keep(cells.withColumn("fitted", F.col("mass").cast("double")), "cells")
    for _ in range(rounds):
        off = []
        for name in targets:
            seen = keep(cells.groupBy(name, f"t_{name}").agg(F.sum("fitted").alias("seen")), "margins")
            off.append(seen.select(F.abs(F.col("seen") - F.col(f"t_{name}")).alias("off")))
            scaled = F.when(F.col("seen") > 0, F.col("fitted") * F.col(f"t_{name}") / F.col("seen")).otherwise(0.0)
            cells = cells.join(seen.select(name, "seen"), name).withColumn("fitted", scaled).drop("seen")
        # written after each round: its plans have a join per category at most, and every round's are alike, so that the
        # driver compiles and holds the code of one round
        cells = keep(cells, "cells")
        worst = reduce(DataFrame.union, off).agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return cells


def probabilities(cells: DataFrame, tokens: float) -> DataFrame:
    """Cells with ``probability`` such that the expected sample has ``tokens`` tokens, or all that the mix allows.

    Cells whose share exceeds their mass are taken whole; what they can't give is spread over the others.
    """
    scale, capped = 0.0, -1
    while True:
        full = F.col("fitted") * F.lit(scale) >= F.col("mass")
        told = cells.where("fitted > 0").agg(
            F.coalesce(F.sum(F.when(full, F.col("mass"))), F.lit(0)).alias("mass"),
            F.coalesce(F.sum(F.when(~full, F.col("fitted"))), F.lit(0.0)).alias("open"), F.count(F.when(full, 1)).alias("n"),
        ).first()
        if told["n"] == capped or told["open"] == 0:
            break
        capped, scale = told["n"], max(scale, (tokens - told["mass"]) / told["open"])
    return cells.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("fitted") * F.lit(scale) / F.col("mass")), 6))


def chance(doc_id: str = "doc_id", seed: str = "mix") -> Column:
    """A number in [0, 1) from a document's id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix_documents(
    docs: DataFrame, categories: dict[str, Column], targets: dict[str, float | dict[str, float]], part: float = 0.5,
    weight: Column | None = None, seed: str = "mix", carry: list[str] | None = None, tolerance: float = 1e-9, rounds: int = 60,
) -> DataFrame:
    """``doc`` (the document's row, or its ``carry`` columns), weight, each category, probability and sampled.

    One aggregate over the documents makes the cells; sums are partial in each task, so a source with a third of the
    rows is a few rows per task.  The cells come back by a join whose kind Spark picks by their size.
    """
    own = [F.col(f"`{c}`") for c in carry or docs.columns]
    named = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in categories.items()]
    rows = docs.select(
        F.struct(*own).alias("doc"), chance(seed=seed).alias("chance"), (token_weight() if weight is None else weight).alias("weight"), *named
    )
    cells = keep(rows.groupBy(*categories).agg(F.sum("weight").alias("mass")), "cells")
    total = cells.agg(F.sum("mass")).first()[0] or 0
    fitted = fit(cells, {c: targets[c] for c in categories}, tolerance, rounds)
    chosen = keep(probabilities(fitted, part * total).select(*categories, "probability"), "cells")
    joined = rows.join(chosen, [*categories]).withColumn("sampled", F.col("chance") < F.col("probability"))
    return joined.select("doc", "weight", *categories, "probability", "sampled")
