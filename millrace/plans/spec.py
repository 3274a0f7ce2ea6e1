"""Job specification and its checks, all made before any Spark job starts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any


class SpecError(ValueError):
    """The job description is not usable."""


@dataclass(frozen=True)
class FieldMap:
    """``dest:src`` or ``dest:src:METHOD``; ``cast`` gives the source a type first."""

    dest: str
    src: str
    method: str | None = None
    cast: str | None = None


def parse_mapping(text: str) -> list[FieldMap]:
    """Comma list of ``dest:src[:METHOD]``; target names are lower-cased."""
    out = []
    for piece in text.split(","):
        parts = [p.strip() for p in piece.split(":")]
        if len(parts) not in (2, 3) or not all(parts):
            raise SpecError(f"mapping {piece!r} is not dest:src or dest:src:METHOD")
        out.append(FieldMap(parts[0].lower(), parts[1], parts[2] if len(parts) == 3 else None))
    return out


def parse_defaults(items: Sequence[str]) -> dict[str, str]:
    """``[col:value]`` items; the value may hold further colons."""
    out = {}
    for item in items:
        name, sep, value = item[1:-1].partition(":")
        if not (item.startswith("[") and item.endswith("]") and sep and name):
            raise SpecError(f"default {item!r} is not [column:value]")
        out[name] = value
    return out


def is_projection(mapping: Sequence[FieldMap]) -> bool:
    """No method, or NONE everywhere: rows are projected and not merged."""
    return all(m.method in (None, "NONE") for m in mapping)


@dataclass
class JobSpec:
    """Source, row operations, mapping and sink of one job.

    ``source`` is a DataFrame or a callable taking the session; ``sink`` a
    callable taking the result.  Output fields are the targets of ``mapping``
    unless ``output_fields`` lists them; ``partition_by`` names those the sink
    partitions by.  ``finalize`` and ``column_functions`` act just before the sink.
    """

    source: Any
    mapping: Sequence[FieldMap] | str
    input_fields: Sequence[str] | None = None
    output_fields: Sequence[str] | None = None
    line_hook: Callable | None = None
    parse: Callable | None = None
    row_hook: Callable | None = None
    ops: Sequence | str = ()
    post_shuffle_ops: Sequence | str = ()
    keep_matching: bool = True
    keep_matching_post: bool = True
    combine: str = "all"
    defaults: Mapping[str, str] = field(default_factory=dict)
    nulls_as_zero: bool = True
    empty_as_null: bool = True
    partition_by: Sequence[str] = ()
    group_hook: Callable | None = None
    finalize: Callable | None = None
    column_functions: Mapping[str, str] = field(default_factory=dict)
    sink: Callable | None = None
    reject_sink: Callable | None = None
    validate_only: bool = False

    def fields(self) -> list[FieldMap]:
        return parse_mapping(self.mapping) if isinstance(self.mapping, str) else list(self.mapping)

    def parsed_ops(self) -> tuple[list, list]:
        from millrace.operators.rowops import parse_ops

        pre = parse_ops(self.ops, self.keep_matching) if isinstance(self.ops, str) else list(self.ops)
        post = (
            parse_ops(self.post_shuffle_ops, self.keep_matching_post)
            if isinstance(self.post_shuffle_ops, str)
            else list(self.post_shuffle_ops)
        )
        return pre, post

    def validate(self, columns: Sequence[str] | None = None) -> "JobSpec":
        """Raise ``SpecError`` on the first problem; no data is read.

        ``columns`` are the columns the mapping may name: those of the source
        after row operations.  When they are unknown, ``input_fields`` and the
        columns that operations make are used, unless a row hook reshapes rows.
        """
        from millrace.operators.aggregate import METHODS

        mapping = self.fields()
        if not mapping:
            raise SpecError("the mapping is empty")
        with_method = [m for m in mapping if m.method is not None]
        if with_method and len(with_method) != len(mapping):
            raise SpecError("either every mapping names a method or none does")
        for m in with_method:
            if m.method not in METHODS:
                raise SpecError(f"method {m.method!r} is not supported")
        pre, _ = self.parsed_ops()
        known = columns
        if known is None and self.input_fields and self.row_hook is None:
            known = [*self.input_fields, *(op.dest for op in pre if hasattr(op, "dest"))]
        if known is not None:
            for m in mapping:
                if m.src not in known:
                    raise SpecError(f"source field {m.src!r} is unknown")
        targets = set(self.output_fields) if self.output_fields else {m.dest for m in mapping}
        for m in mapping:
            if m.dest not in targets:
                raise SpecError(f"target field {m.dest!r} is not an output field")
        for c in self.defaults:
            if c not in targets:
                raise SpecError(f"default for unknown column {c!r}")
        for c in self.partition_by:
            if c not in targets:
                raise SpecError(f"partition field {c!r} is not an output field")
        if not is_projection(mapping):
            dests = [m.dest for m in mapping]
            if len(set(dests)) != len(dests):
                raise SpecError("duplicate target field in a grouped job")
        elif self.post_shuffle_ops:
            raise SpecError("a projection has no shuffle: use ops")
        elif self.group_hook:
            raise SpecError("a projection has no groups: use row_hook")
        if self.line_hook and not self.parse:
            raise SpecError("a line hook needs parse, which makes rows of the lines")
        if self.combine not in ("all", "last"):
            raise SpecError(f"unknown filter rule {self.combine!r}")
        return self
