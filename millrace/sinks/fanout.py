"""One input to several outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import renamed
from millrace.session import scratch_path


@dataclass(frozen=True)
class TargetStatus:
    target: str
    ok: bool
    error: str = ""


def fan_out(df: DataFrame, targets: Mapping[str, Callable[[DataFrame], None]], stage: bool = True) -> list[TargetStatus]:
    """Write ``df`` by every target function; a failed target does not stop the others.

    With ``stage`` the input is computed once into the shared scratch folder
    and every target reads that copy; a single target needs no copy.
    """
    if stage and len(targets) > 1:
        copy = scratch_path(df.sparkSession, "fanout") + "/rows"
        df.write.parquet(copy)
        df = df.sparkSession.read.schema(df.schema).parquet(copy)
    out = []
    for name, write in targets.items():
        try:
            write(df)
            out.append(TargetStatus(name, True))
        except Exception as e:  # the outcome of each target is reported, not raised
            out.append(TargetStatus(name, False, f"{type(e).__name__}: {e}"[:500]))
    return out


def with_target_name(manifest: DataFrame, rename: str, rule: str | None = None, path: str = "path") -> DataFrame:
    """Manifest rows with the output file name a rename rule gives them."""
    return manifest.withColumn("target_name", renamed(F.col(path), rename, rule))
