"""A job from source to sink as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.text import field
from millrace.operators.aggregate import summarize
from millrace.operators.hooks import flat_map_rows, map_lines
from millrace.operators.project import apply_column_functions, project
from millrace.operators.rejects import RunCounts, count_rows, read_split, write_split
from millrace.operators.rowops import REASON, VALID, apply_ops, is_valid, mark_valid, valid_rows
from millrace.plans.spec import JobSpec, SpecError, is_projection
from millrace.session import scratch_path
from millrace.sources.archives import read_archive_lines
from millrace.sources.text import parse_fields


def source_rows(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Rows of the source; with a line hook the source gives lines and ``parse`` makes rows of them."""
    df = spec.source(spark) if callable(spec.source) else spec.source
    if spec.line_hook:
        df = map_lines(df, spec.line_hook)
    return spec.parse(df) if spec.parse else df


def marked_rows(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Source, hooks and all row operations; every row carries ``_valid`` and a reason.

    Operations after grouping see single rows with read-only keys, so they are
    part of this chain and what they reject is counted like any other reject.
    """
    df = source_rows(spark, spec)
    if spec.row_hook:
        df = spec.row_hook(df)
    pre, post = spec.parsed_ops()
    marked = apply_ops(mark_valid(df), pre, spec.combine)
    if not post:
        return marked
    before = marked.withColumn("_before", is_valid())
    keys = [m.src for m in spec.fields() if m.method == "NONE"]
    after = apply_ops(before, post, spec.combine, only=keys)
    return after.withColumn(VALID, is_valid() & F.col("_before")).drop("_before")


def shape(marked: DataFrame, spec: JobSpec) -> DataFrame:
    """Projection or aggregation of the valid rows, up to what the sink receives."""
    mapping = spec.fields()
    spec.validate([c for c in marked.columns if c not in (VALID, REASON)])
    rows = valid_rows(marked)
    if is_projection(mapping):
        out = project(rows, mapping, spec.defaults)
    else:
        out = summarize(
            rows,
            mapping,
            defaults=spec.defaults,
            nulls_as_zero=spec.nulls_as_zero,
            empty_as_null=spec.empty_as_null,
            combine=spec.combine,
        )
    if spec.group_hook:
        out = spec.group_hook(out)
    if spec.finalize:
        out = spec.finalize(out)
    if spec.column_functions:
        out = apply_column_functions(out, spec.column_functions)
    return out


def build(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """The job's result as a lazy DataFrame; nothing runs."""
    return shape(marked_rows(spark, spec.validate()), spec)


def staged_rows(marked: DataFrame, spec: JobSpec) -> DataFrame:
    """What a run keeps of its marked rows: the mapped columns, and for a reject sink all columns of rejected rows.

    Nothing else is read from the source but what row operations need; of accepted rows the columns that only the
    reject sink sees are null, which takes no room.
    """
    mapped = [*dict.fromkeys(m.src for m in spec.fields())]
    kept = [field(c) for c in mapped]
    if spec.reject_sink:
        rest = [c for c in marked.columns if c not in (*mapped, VALID, REASON)]
        kept = [field(c) if c in mapped else F.when(~is_valid(), field(c)).alias(c) for c in marked.columns if c in mapped or c in rest]
        kept.append(field(REASON))
    return marked.select(*kept, field(VALID))


def run(spark: SparkSession, spec: JobSpec) -> RunCounts:
    """Run a job with its sinks and return the row counts.

    The mapped columns of the marked rows are written once to the shared scratch folder, accepted and rejected apart.
    Both sinks read that copy, so the source and its hooks run once, and every count is taken from written rows: a sink
    that evaluates its input several times, a retried task or a lost executor changes none.
    """
    if not spec.validate_only and spec.sink is None:
        raise SpecError("the job has no sink")
    marked = marked_rows(spark, spec.validate())
    if spec.validate_only:
        return RunCounts(*count_rows(marked).first())
    spec.validate([c for c in marked.columns if c not in (VALID, REASON)])
    path = scratch_path(spark, "marked") + "/rows"
    staged = staged_rows(marked, spec)
    write_split(staged, path)
    accepted, rejected = read_split(spark, path, staged.schema)
    valid, bad = accepted.count(), rejected.count()
    result = shape(mark_valid(accepted), spec)
    stored = valid
    if not is_projection(spec.fields()) or spec.finalize or spec.group_hook:
        # Groups are few against rows; written once, they are counted and stored from the same copy.
        place = scratch_path(spark, "result") + "/rows"
        result.write.parquet(place)
        result = spark.read.schema(result.schema).parquet(place)
        stored = result.count()
    spec.sink(result)
    if spec.reject_sink:
        spec.reject_sink(rejected)
    return RunCounts(valid + bad, valid, bad, stored)


def sample_rows(df: DataFrame, count: int = 10) -> DataFrame:
    """A few rows to look at while a job is being written."""
    return df.limit(count)


def row_hook(recode: Callable, schema, **options) -> Callable[[DataFrame], DataFrame]:
    """``recode(row) -> rows`` as the row hook of a job; rows it rejects are counted."""
    return lambda df: flat_map_rows(df, recode, schema, keep_rejects=True, **options)


def archive_source(
    paths: str | Sequence[str], fields, sep: str = ",", regex: bool = False, charset: str = "utf-8"
) -> Callable[[SparkSession], DataFrame]:
    """Collect and process in one pass: archive members unpacked, parsed and fed to the job."""

    def source(spark: SparkSession) -> DataFrame:
        lines = read_archive_lines(spark, paths, charset=charset).drop("_member", "_line")
        return parse_fields(lines, fields, sep, regex)

    return source


def totals_by_file(marked: DataFrame, path_column: str = "_file_path") -> DataFrame:
    """Total, accepted and rejected rows per source file."""
    ok = is_valid().cast("bigint")
    return marked.groupBy(F.col(path_column).alias("file_path")).agg(
        F.count(F.lit(1)).alias("total"), F.sum(ok).alias("success"), F.sum(1 - ok).alias("failed")
    )
