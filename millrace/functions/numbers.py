"""Lenient casts and fixed-decimal text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The decimal layouts a caller may name.
DECIMAL_LAYOUTS = ("0", "0.0", "0.00", "0.000000", "0.00000000", "#,##0", "#,##0.0", "#,##0.00")


def number(c: Column) -> Column:
    """Double in a text value, null when there is none.

    Only ``NaN`` and ``Infinity`` in this spelling are numbers; Spark's cast
    would also take words such as ``inf`` or ``nan``.
    """
    s = c.cast("string")
    x = s.try_cast("double")
    special = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(special & ~F.trim(s).rlike(r"^[+-]?(NaN|Infinity|[0-9.].*)$"), F.lit(None)).otherwise(x)


def lenient_double(c: Column, default: float = 0.0) -> Column:
    """Number in the value, or ``default`` when there is none."""
    return F.coalesce(number(c), F.lit(float(default)))


def lenient_int(c: Column, default: int = 0) -> Column:
    """Whole number in the value; "3.5" is not one and gives ``default``."""
    whole = F.when(c.cast("string").rlike(r"\A[+-]?[0-9]+\z"), c.cast("string").try_cast("int"))
    return F.coalesce(whole, F.lit(int(default)))


def decimal_text(c: Column, layout: str = "0.00") -> Column:
    """Fixed-decimal text, halves to even, optionally with grouped thousands."""
    if layout not in DECIMAL_LAYOUTS:
        raise ValueError(f"unknown decimal layout {layout!r}")
    return F.call_function("format_number", c.cast("double"), F.lit(layout))
