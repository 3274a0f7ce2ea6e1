"""Macros in job texts: ``{name}`` replaced before a job is built.

The run time is always passed in, so a job text is reproducible.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from millrace.plans.spec import SpecError

# Names a parameter of the job's date argument fills, with the
# digits (start, stop) they are cut from and the range they must lie in.
_DATE_PARTS = {
    "YYYY": (0, 4, 1970, 9999),
    "MM": (4, 6, 1, 12),
    "DD": (6, 8, 1, 31),
    "HH": (8, 10, 0, 23),
    "MI": (10, 12, 0, 59),
    "SS": (12, 14, 0, 59),
}


def date_macros(digits: str) -> dict[str, str | None]:
    """``201302011416`` -> YYYY, YY, MM, M, DD, D, HH, MI, SS; parts not given are None."""
    if not re.fullmatch(r"[0-9]{4,14}", digits) or len(digits) % 2:
        raise SpecError(f"date argument {digits!r} must have 4 to 14 digits, an even number")
    out: dict[str, str | None] = {}
    for name, (start, stop, low, high) in _DATE_PARTS.items():
        part = digits[start:stop] if len(digits) >= stop else None
        if part is not None and not low <= int(part) <= high:
            raise SpecError(f"date argument {digits!r}: {name} is out of range")
        out[name] = part
    out["YY"] = out["YYYY"][2:]
    out["M"] = str(int(out["MM"])) if out["MM"] else None
    out["D"] = str(int(out["DD"])) if out["DD"] else None
    return out


def _month(day: dt.datetime, step: int) -> str:
    months = day.year * 12 + day.month - 1 + step
    return f"{months // 12:04d}{months % 12 + 1:02d}"


def now_macros(run_time: dt.datetime) -> dict[str, str]:
    """``N_`` macros of the run time: its parts, the day and month before and after."""
    day = dt.timedelta(days=1)
    return {
        "N_YYYY": f"{run_time:%Y}",
        "N_YY": f"{run_time:%y}",
        "N_MM": f"{run_time:%m}",
        "N_M": str(run_time.month),
        "N_DD": f"{run_time:%d}",
        "N_D": str(run_time.day),
        "N_HH": f"{run_time:%H}",
        "N_MI": f"{run_time:%M}",
        "N_SS": f"{run_time:%S}",
        "N_YYYYMM": _month(run_time, 0),
        "N_YYYYMMN": _month(run_time, 1),
        "N_YYYYMMP": _month(run_time, -1),
        "N_YYYYMMDD": f"{run_time:%Y%m%d}",
        "N_YYYYMMDDN": f"{run_time + day:%Y%m%d}",
        "N_YYYYMMDDP": f"{run_time - day:%Y%m%d}",
    }


def parameters(pairs: list[str]) -> dict[str, str]:
    """``name=value`` arguments."""
    out = {}
    for pair in pairs:
        name, sep, value = pair.strip().partition("=")
        if not sep or not name or "=" in value:
            raise SpecError(f"argument {pair!r} is not name=value")
        out[name] = value
    return out


def substitute(text: str, macros: Mapping[str, str | None], fields: frozenset[str] | set[str] = frozenset()) -> str:
    """Replace ``{name}`` in any letter case; a macro that has no value is an error.

    ``fields`` are record fields of templates, which stay as they are, as do
    names that are no macro.
    """
    known = {k.lower(): v for k, v in macros.items()}
    keep = {f.lower() for f in fields}

    def value(m: re.Match) -> str:
        name = m.group(1).lower()
        if name in keep or name not in known:
            return m.group(0)
        if known[name] is None:
            raise SpecError(f"macro {m.group(0)} has no value")
        return known[name]

    return re.sub(r"\{([^{}]+)\}", value, text)
