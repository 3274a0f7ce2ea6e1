"""Key ranges and other row predicates that cut a table into parallel reads.

Every function returns SQL conditions that are disjoint and together hold for
every row, also for rows outside the measured bounds and for null keys.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from decimal import Decimal

KINDS = ("integer", "decimal", "float", "boolean", "date", "timestamp", "text")
# Dialects in which a backslash inside quotes is an escape.
BACKSLASH_DIALECTS = ("mysql", "spark")
_TEXT_CHARS = 8
_BASE = 65536


def kind_of(value) -> str:
    """Range kind of a bound by its Python type."""
    for kind, python in (
        ("boolean", bool), ("integer", int), ("decimal", Decimal), ("float", float),
        ("timestamp", dt.datetime), ("date", dt.date),
    ):
        if isinstance(value, python):
            return kind
    return "text"


def sql_literal(value, dialect: str = "ansi") -> str:
    """A value as a quoted SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
        if dialect == "oracle":
            return f"TO_DATE('{text}', 'YYYY-MM-DD HH24:MI:SS')"
        return f"TIMESTAMP '{text}{f'.{value.microsecond:06d}' if value.microsecond else ''}'"
    if isinstance(value, dt.date):
        return f"TO_DATE('{value}', 'YYYY-MM-DD')" if dialect == "oracle" else f"DATE '{value}'"
    text = str(value).replace("'", "''")
    return "'" + (text.replace("\\", "\\\\") if dialect in BACKSLASH_DIALECTS else text) + "'"


def _text_points(lo: str, hi: str, n: int) -> list[str]:
    """Points between two texts: after the common prefix, eight characters read as
    base-65536 digits of a number that is divided evenly."""
    shared = 0
    while shared < min(len(lo), len(hi)) and lo[shared] == hi[shared]:
        shared += 1
    prefix = lo[:shared]

    def number(s: str) -> int:
        codes = [min(ord(c), _BASE - 1) for c in s[:_TEXT_CHARS]]
        return sum(code * _BASE ** (_TEXT_CHARS - 1 - i) for i, code in enumerate(codes))

    def text(x: int) -> str:
        out = []
        for i in range(_TEXT_CHARS):
            code = x // _BASE ** (_TEXT_CHARS - 1 - i) % _BASE
            if code == 0:
                break
            # no half of a surrogate pair, no quote, control character or backslash
            code = 0xD7FF if 0xD800 <= code <= 0xDFFF else 0x5B if code == 0x5C else max(code, 0x30)
            out.append(chr(code))
        return prefix + "".join(out)

    a, b = number(lo[shared:]), number(hi[shared:])
    points = [text(a + (b - a) * i // n) for i in range(1, n)]
    return sorted({p for p in points if lo < p <= hi})


def split_points(kind: str, lo, hi, n: int) -> list:
    """Inner bounds of at most ``n`` even ranges between ``lo`` and ``hi``."""
    if kind not in KINDS:
        raise ValueError(f"unknown key type {kind!r}")
    if lo is None or hi is None or n < 2 or not lo < hi:
        return []
    if kind == "text":
        return _text_points(lo, hi, n)
    if kind == "integer":
        points = [lo + (hi - lo) * i // n for i in range(1, n)]
    elif kind == "decimal":
        lo, hi = Decimal(lo), Decimal(hi)
        step = max((hi - lo) / n, Decimal(1))
        points = [lo + step * i for i in range(1, n)]
    elif kind == "float":
        points = [lo + (hi - lo) * i / n for i in range(1, n)]
    elif kind == "date":
        points = [lo + dt.timedelta(days=(hi - lo).days * i // n) for i in range(1, n)]
    else:
        points = [lo + (hi - lo) * i / n for i in range(1, n)]
    return sorted({p for p in points if lo < p < hi})


def range_predicates(column: str, kind: str, lo, hi, n: int, dialect: str = "ansi") -> list[str]:
    """Half-open ranges of a split column; the first also takes null keys, the ends are open."""
    if kind == "boolean":
        return [f"{column} = TRUE", f"{column} = FALSE", f"{column} IS NULL"]
    return point_predicates(column, split_points(kind, lo, hi, n), dialect)


def point_predicates(column: str, points: Sequence, dialect: str = "ansi") -> list[str]:
    """Half-open ranges between ascending points, the ends open; null keys belong to the first."""
    points = [sql_literal(p, dialect) for p in points]
    if not points:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:])]
    return [f"({column} < {points[0]} OR {column} IS NULL)", *inner, f"{column} >= {points[-1]}"]


def hash_predicates(column: str, n: int) -> list[str]:
    """Even shares of a whole-number key by remainder: no paging, no order needed,
    and insensitive to gaps or clusters in the key range."""
    shares = [f"ABS(MOD({column}, {n})) = {i}" for i in range(n)]
    shares[0] = f"({shares[0]} OR {column} IS NULL)"
    return shares


def value_predicates(column: str, values: Sequence, dialect: str = "ansi") -> list[str]:
    """One read per listed partition value."""
    return [
        f"{column} IS NULL" if v is None else f"{column} = {sql_literal(v, dialect)}" for v in dict.fromkeys(values)
    ]


def parameter_list(text: str) -> list[dict]:
    """Literal parameters ``'a', 'b', 3``: one row of one parameter each."""
    out = []
    for item in text.split(","):
        item = item.strip()
        if len(item) > 1 and item[0] == item[-1] == "'":
            item = item[1:-1]
        out.append({"p": item})
    return out


_BOUND = re.compile(r"'\{(?P<whole>[^{}']+)\}'|(?P<quoted>'(?:[^']|'')*')|\{(?P<name>[^{}]+)\}|(?P<mark>\?)")


def bind(template: str, row: Mapping, dialect: str = "ansi", marks: Sequence | None = None) -> str:
    """Macros and ``?`` marks replaced by literals, in one pass over the template.

    Macros are ``{NAME}`` or ``{PARAM_MACROS[i]}`` by position.  A quoted macro
    becomes a text literal; within a longer quoted text a macro's value is
    escaped and joins that text.  ``?`` marks are filled in column order, or with ``marks``.  What
    was filled in is not looked at again, and a ``?`` inside quotes is text.
    """
    values = dict(row)
    values.update({f"PARAM_MACROS[{i}]": v for i, v in enumerate(row.values())})
    filled = iter(row.values() if marks is None else marks)

    def inside(m: re.Match) -> str:
        if m.group(1) not in values:
            return m.group(0)
        value = values[m.group(1)]
        return "" if value is None else sql_literal(str(value), dialect)[1:-1]

    def fill(m: re.Match) -> str:
        if m.group("quoted"):
            return re.sub(r"\{([^{}]+)\}", inside, m.group(0))
        if m.group("mark"):
            try:
                return sql_literal(next(filled), dialect)
            except StopIteration:
                raise ValueError("more parameter marks than parameters") from None
        name = m.group("whole") or m.group("name")
        if name not in values:
            return m.group(0)
        value = values[name]
        return sql_literal(str(value) if m.group("whole") and value is not None else value, dialect)

    return _BOUND.sub(fill, template)
