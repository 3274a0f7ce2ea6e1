"""Row operations: ordered column rewrites and filters over a DataFrame.

Filters only mark rows (``_valid``, ``_reject_reason``); a row counts as
rejected after the whole chain has run, so later operations still see it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.text import field, full_match, template, undock
from millrace.plans.spec import SpecError

VALID, REASON, PATH = "_valid", "_reject_reason", "_file_path"


@dataclass(frozen=True)
class Compute:
    """``digit``: put the value of an arithmetic rule in a (new) column."""

    rule: str
    dest: str

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.dest, rules.compute(self.rule, df.schema))


@dataclass(frozen=True)
class Filter:
    """``filter``: keep (or drop) rows whose template value matches the whole pattern.

    Where nothing was filled into the template the rule does not apply and the
    row stays valid.
    """

    value: str
    pattern: str
    keep: bool = True

    def condition(self, df: DataFrame) -> Column:
        text = template(self.value, df.schema)
        match = full_match(text, self.pattern)
        return (text == F.lit(self.value)) | (match if self.keep else ~match)


@dataclass(frozen=True)
class ReplaceValue:
    """``conreplace``: map listed values, not chained; compared as text, null stays null."""

    column: str
    values: Mapping[str, str] = dc_field(hash=False)

    def apply(self, df: DataFrame) -> DataFrame:
        if self.column not in df.columns or not self.values:
            return df
        old = field(self.column).cast("string")
        pairs = [x for k, v in self.values.items() for x in (F.lit(k), F.lit(v))]
        return df.withColumn(self.column, F.coalesce(F.try_element_at(F.create_map(*pairs), old), old))


@dataclass(frozen=True)
class Reverse:
    """``reverse``: reverse listed fields; null gives ""."""

    columns: Sequence[str]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: F.reverse(F.coalesce(field(c).cast("string"), F.lit("")))
                for c in self.columns
                if c in df.columns
            }
        )


@dataclass(frozen=True)
class SourcePath:
    """``replace``: put the full path of the source file in a field."""

    column: str

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, _path(df))


@dataclass(frozen=True)
class FileNamePart:
    """``filename``: derive an existing field from the source file's name.

    ``index``: characters [start, stop) when the name is longer than ``stop``;
    ``split``: n-th piece of a regex split without trailing empty pieces;
    ``regex``: every match replaced, when there is one.  Otherwise the field
    keeps its value.
    """

    column: str
    mode: str
    start: int = 0
    stop: int = 0
    pattern: str = ""
    replacement: str = ""

    def apply(self, df: DataFrame) -> DataFrame:
        if self.column not in df.columns:
            return df
        name = F.substring_index(_path(df), "/", -1)
        if self.mode == "index":
            new = F.when(F.length(name) > self.stop, F.substring(name, self.start + 1, self.stop - self.start))
        elif self.mode == "split":
            parts = F.split(name, self.pattern, -1)
            rest = F.array_join(F.slice(parts, F.lit(self.start + 1), F.greatest(F.size(parts), F.lit(1))), "")
            new = F.when(rest != "", F.get(parts, F.lit(self.start)))
        elif self.mode == "regex":
            new = F.when(name.rlike(self.pattern), F.regexp_replace(name, self.pattern, self.replacement))
        else:
            raise SpecError(f"unknown file name mode {self.mode!r}")
        return df.withColumn(self.column, F.coalesce(new, field(self.column).cast("string")))


@dataclass(frozen=True)
class Custom:
    """Any DataFrame transform as a step of the chain."""

    transform: object

    def apply(self, df: DataFrame) -> DataFrame:
        return self.transform(df)


def _path(df: DataFrame) -> Column:
    if PATH not in df.columns:
        raise SpecError("this operation needs a file source read with provenance=True")
    return field(PATH)


def mark_valid(df: DataFrame) -> DataFrame:
    """Add ``_valid`` and ``_reject_reason`` where a source or hook has not set them."""
    missing = {VALID: F.lit(True), REASON: F.lit(None).cast("string")}
    missing = {name: c for name, c in missing.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def apply_ops(df: DataFrame, ops: Sequence, combine: str = "all", only: Sequence[str] | None = None) -> DataFrame:
    """Run the chain in listed order and mark every row.

    ``combine="all"``: a row must pass every filter; ``"last"``: the last filter
    that applies decides alone; rows that came rejected into the chain stay so.
    ``only`` lists the columns operations may not change (group keys after
    grouping is fixed).
    """
    if combine not in ("all", "last"):
        raise SpecError(f"unknown filter rule {combine!r}")
    df = mark_valid(df)
    for op in ops:
        if isinstance(op, Filter):
            ok = op.condition(df)
            why = F.lit(f"filter {op.value}:{'' if op.keep else 'not '}{op.pattern}")
            if combine == "all":
                df = df.withColumns({VALID: field(VALID) & ok, REASON: F.coalesce(field(REASON), F.when(~ok, why))})
            else:
                applies = template(op.value, df.schema) != F.lit(op.value)
                df = df.withColumns(
                    {
                        VALID: F.when(applies, ok).otherwise(field(VALID)),
                        REASON: F.when(applies, F.when(~ok, why)).otherwise(field(REASON)),
                    }
                )
            continue
        before = df
        df = op.apply(df)
        if only:
            kept = {c: before.schema[c].dataType for c in only}
            touched = [c for c in kept if _writes(op, c)]
            if touched:
                raise SpecError(f"group keys {touched} are read-only after grouping")
    return df


def _writes(op, column: str) -> bool:
    names = [getattr(op, "dest", None), getattr(op, "column", None), *getattr(op, "columns", ())]
    return column in names


def is_valid() -> Column:
    """Whether a marked row is accepted; a mark that is null rejects it."""
    return F.coalesce(field(VALID), F.lit(False))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_valid()).drop(VALID, REASON)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(~is_valid()).drop(VALID)


OPERATION_NAMES = ("digit", "filter", "replace", "filename", "reverse", "conreplace")


def parse_ops(text: str, keep: bool = True) -> list:
    """Comma list of ``name:rule``.

    A convenience for simple rules: commas separate operations and colons the
    parts of a rule, so a rule that needs either inside must be given as an
    object.  Anything unclear is an error and is never dropped.
    """
    ops = []
    for piece in filter(None, (p.strip() for p in text.split(","))):
        name, _, rule = piece.partition(":")
        if name not in OPERATION_NAMES:
            raise SpecError(f"unknown operation in {piece!r} (a comma inside a rule needs the object form)")
        if not rule:
            raise SpecError(f"operation {name!r} has no rule")
        ops.append(_parse_rule(name, rule, keep))
    return ops


def _parse_rule(name: str, rule: str, keep: bool):
    if name == "digit":
        expr, _, dest = rule.rpartition("=")
        if not expr or not re.fullmatch(r"\{[^{}]+\}", dest):
            raise SpecError(f"digit rule {rule!r} is not <expression>={{field}}")
        return Compute(expr, undock(dest))
    if name == "filter":
        parts = rule.split(":")
        if len(parts) != 2:
            raise SpecError(f"filter rule {rule!r} is not <template>:<pattern>")
        return Filter(parts[0], parts[1], keep)
    if name == "replace":
        return SourcePath(undock(rule))
    if name == "reverse":
        return Reverse([undock(c) for c in rule.split(":") if c])
    if name == "conreplace":
        column, *pairs = rule.split(":")
        values = {}
        for pair in pairs:
            m = re.fullmatch(r"\{(.*?)\}-\{(.*?)\}", pair)
            if not m:
                raise SpecError(f"value pair {pair!r} is not {{old}}-{{new}}")
            values[m.group(1)] = m.group(2)
        if not values:
            raise SpecError(f"conreplace rule {rule!r} lists no values")
        return ReplaceValue(undock(column), values)
    if rule.startswith("reg:"):
        parts = rule[4:].split("~")
        if len(parts) != 3:
            raise SpecError(f"filename rule {rule!r} is not reg:{{field}}~pattern~replacement")
        return FileNamePart(undock(parts[0]), "regex", pattern=parts[1], replacement=parts[2])
    column, _, how = rule.partition(":")
    if m := re.fullmatch(r"index\[(\d+)-(\d+)\]", how):
        start, stop = int(m.group(1)), int(m.group(2))
        if start >= stop:
            raise SpecError(f"filename rule {rule!r}: empty index range")
        return FileNamePart(undock(column), "index", start, stop)
    if m := re.fullmatch(r"split\[\{(.*?)\}-\{(\d+)\}\]", how):
        return FileNamePart(undock(column), "split", int(m.group(2)), pattern=m.group(1))
    raise SpecError(f"filename rule {rule!r} is not understood")
