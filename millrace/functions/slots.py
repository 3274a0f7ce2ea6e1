"""Hash-slot sharding: 1024 slots cut into consecutive segments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SLOTS = 1024


def segments(counts: list[int], lengths: list[int]) -> list[int]:
    """Upper slot bound of every shard; the products must fill all 1024 slots."""
    if len(counts) != len(lengths):
        raise ValueError("counts and lengths differ in size")
    widths = [length for count, length in zip(counts, lengths) for _ in range(count)]
    if sum(widths) != SLOTS or any(w <= 0 for w in widths):
        raise ValueError(f"segments cover {sum(widths)} slots, not {SLOTS}")
    bounds, total = [], 0
    for w in widths:
        total += w
        bounds.append(total)
    return bounds


def parse_slice(text: str | int) -> tuple[int, int]:
    """``"2"`` -> (0, 2), ``"1:"`` -> (1, 0), ``":-1"`` -> (0, -1); end 0 means the whole length."""
    text = str(text)
    if ":" not in text:
        n = int(text)
        return (0, n) if n >= 0 else (n, 0)
    left, right = (p.strip() for p in text.split(":", 1))
    return int(left or 0), int(right or 0)


def int_slot(c: Column) -> Column:
    """Low ten bits of the key; null keys and texts that are no whole number use slot 0."""
    return F.coalesce(c.try_cast("bigint").bitwiseAND(F.lit(SLOTS - 1)), F.lit(0)).cast("int")


#: Slices of at most this many units are columns; wider and open ones fold in numpy.
NARROW = 64


def string_slot(c: Column, hash_slice: str | int = "0:8") -> Column:
    """Low ten bits of ``h = 31 * h + unit`` over a slice of the key's UTF-16 units.

    One rule in two forms, picked by the slice and never by the data: the usual narrow slice is cut out first and
    folded as a column; a wide or open slice may cover a whole text, where a fold in interpreted columns costs
    several times a numpy product over Arrow batches.  Both are linear in the length of the slice.
    """
    start, end = parse_slice(hash_slice)
    key = F.coalesce(c.cast("string"), F.lit(""))
    if 0 <= start < end <= start + NARROW:
        # ``end`` characters hold at least ``end`` units, so the rest of a long key is never encoded.
        return _folded(_units(F.substring(key, 1, end)).substr(4 * start + 1, 4 * (end - start)))
    if -NARROW <= start < 0 == end:
        units = _units(F.substring(key, start, -start))
        return _folded(units.substr(F.greatest(F.length(units) + 4 * start, F.lit(0)) + 1, F.lit(-4 * start)))
    return _wide(start, end)(key)


def _units(key: Column) -> Column:
    """Four hex digits for each UTF-16 unit."""
    return F.hex(F.encode(key, "UTF-16BE"))


def _folded(units: Column) -> Column:
    def step(h: Column, unit: Column) -> Column:
        return (h * 31 + F.conv(unit, 16, 10).cast("int")).bitwiseAND(F.lit(SLOTS - 1))

    return F.aggregate(F.regexp_extract_all(units, F.lit("...."), F.lit(0)), F.lit(0), step)


#: Units of one product.
_PIECE = 1 << 16


def _wide(start: int, end: int):
    """The fold as products of pieces with powers of 31, in wrapping 32-bit numbers, which keep the low ten bits."""

    @F.arrow_udf("int")
    def slot(keys: pa.Array) -> pa.Array:
        # a batch stays in Arrow and one key at a time becomes a text: as texts, a batch takes up to four times the memory
        powers = np.cumprod(np.full(_PIECE + 1, 31, np.uint32), dtype=np.uint32) * np.uint32(pow(31, -1, 1 << 32))
        out = np.zeros(len(keys), np.int32)
        for i, key in enumerate(keys):
            units = np.frombuffer(key.as_py().encode("utf-16-le"), "<u2")
            last = min(end, len(units)) if end > 0 else len(units) + end
            units = units[start if start >= 0 else max(len(units) + start, 0):max(last, 0)]
            h = 0
            for at in range(0, len(units), _PIECE):
                piece = units[at:at + _PIECE]
                own = piece[::-1].astype(np.uint32) @ powers[:len(piece)]
                h = (h * int(powers[len(piece)]) + int(own)) % SLOTS
            out[i] = h
        return pa.array(out)

    return slot


def shard_of(slot: Column, counts: list[int], lengths: list[int]) -> Column:
    """Shard number of a slot.

    Equal segments are one division; uneven ones a literal table lookup.
    """
    bounds = segments(counts, lengths)
    if len(set(lengths)) == 1:
        return F.floor(slot / F.lit(lengths[0])).cast("int")
    table = [shard for shard, hi in enumerate(bounds) for _ in range(hi - (bounds[shard - 1] if shard else 0))]
    return F.element_at(F.lit(table), slot + 1).cast("int")
