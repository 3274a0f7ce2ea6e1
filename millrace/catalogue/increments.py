"""Incremental runs: the ledger and its streaming twin."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.operators.aggregate import summarize
from millrace.operators.rowops import Filter, apply_ops, valid_rows
from millrace.plans.ledger import current_rows, failed_in_run, failed_latest, Ledger, pending, process_files, vanished
from millrace.plans.spec import parse_mapping
from millrace.session import scratch_path
from millrace.sinks.text import write_delimited
from millrace.sources.files import manifest
from millrace.sources.text import read_delimited
from millrace.streaming.incremental import append_available, convert_available, stream_delimited

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql

_EVENTS = "event_id bigint, user_id bigint, event_type string, value double"


def _land(events, root, name, condition):
    write_delimited(events.where(condition).select("event_id", "user_id", "event_type", "value"), f"{root}/{name}")


def _read(spark, paths):
    df = read_delimited(spark, paths, _EVENTS, provenance=True)
    return apply_ops(df, [Filter("{event_type}", "error|signup", keep=False)])


@_R.add("SELECT event_id, user_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup')")
def ledger_run_twice(spark, d):
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "target") + "/rows"
    ledger = Ledger(spark, scratch_path(spark, "ledger") + "/rows")
    e = table(spark, d, "events")
    job = dict(job_id="events", source_id=1, root=root, read=_read, target=target, regex=r"part-.*",
               run_time=dt.datetime(2024, 2, 1))
    _land(e, root, "first", "event_id % 2 = 0")
    process_files(spark, ledger, **job)
    _land(e, root, "second", "event_id % 2 = 1")
    process_files(spark, ledger, **job)
    process_files(spark, ledger, **job, mode="force")
    return current_rows(ledger, target, "events").select("event_id", "user_id", "event_type", "value")


@_R.add("""
SELECT count(*) AS total, count(*) FILTER (event_type NOT IN ('error', 'signup')) AS success,
       count(*) FILTER (event_type IN ('error', 'signup')) AS failed, CAST(0 AS BIGINT) AS second_run FROM events""")
def ledger_totals(spark, d):
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "target") + "/rows"
    ledger = Ledger(spark, scratch_path(spark, "ledger") + "/rows")
    _land(table(spark, d, "events"), root, "all", "true")
    job = dict(job_id="events", source_id=1, root=root, read=_read, target=target, regex=r"part-.*",
               run_time=dt.datetime(2024, 2, 1))
    process_files(spark, ledger, **job)
    again = process_files(spark, ledger, **job)
    return ledger.rows().agg(
        F.sum("total").alias("total"), F.sum("success").alias("success"), F.sum("failed").alias("failed"),
        F.lit(again).cast("bigint").alias("second_run"),
    )


# attempts of an invented ledger: one row per event, files are users, runs are days
_ATTEMPTS_SQL = """(SELECT user_id, event_id, ts, CASE event_type WHEN 'error' THEN 3 WHEN 'view' THEN 1 ELSE 2 END AS status FROM events)"""


def _attempts(spark, d):
    status = F.when(F.col("event_type") == "error", 3).when(F.col("event_type") == "view", 1).otherwise(2)
    return table(spark, d, "events").select(
        F.col("event_id").alias("run_id"), F.lit(0).alias("seq"), F.lit("j").alias("job_id"), F.lit(1).alias("source_id"),
        F.col("user_id").cast("string").alias("file_id"), F.concat(F.lit("/u/"), "user_id").alias("file_path"),
        F.col("ts").alias("start_time"), status.alias("status"),
    )


@_R.add(f"""
SELECT '/u/' || user_id AS file_path, max(event_id) AS run_id FROM {_ATTEMPTS_SQL} GROUP BY user_id HAVING max_by(status, event_id) = 3""")
def ledger_latest_failed(spark, d):
    return failed_latest(_attempts(spark, d), "j").select("file_path", "run_id")


@_R.add(f"""
SELECT '/u/' || user_id AS file_path, max(event_id) AS run_id FROM {_ATTEMPTS_SQL}
WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' GROUP BY user_id HAVING max_by(status, event_id) = 3""")
def ledger_failed_in_time_range(spark, d):
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    failed = failed_latest(_attempts(spark, d), "j", ntz("2024-01-10"), ntz("2024-01-20"))
    return failed.select("file_path", "run_id")


@_R.add(f"SELECT '/u/' || user_id AS file_path FROM {_ATTEMPTS_SQL} WHERE event_id = (SELECT max(event_id) FROM events WHERE event_type = 'error') AND status = 3")
def ledger_failed_in_one_run(spark, d):
    """Failures of one run, which the mode that repeats a run takes."""
    last = table(spark, d, "events").where("event_type = 'error'").agg(F.max("event_id")).first()[0]
    return failed_in_run(_attempts(spark, d), "j", last).select("file_path")


@_R.add(f"""
SELECT '/u/' || user_id AS file_path, 4 AS status, 1 AS seq FROM {_ATTEMPTS_SQL} GROUP BY user_id
HAVING max_by(status, event_id) = 3 AND user_id % 2 = 1""")
def ledger_vanished_files(spark, d):
    """Failed files that are no longer listed get a row of their own."""
    files = table(spark, d, "events").where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("file_id")).distinct()
    return vanished(failed_latest(_attempts(spark, d), "j"), files).select("file_path", "status", "seq")


@_R.add(f"""
SELECT CAST(c_custkey AS VARCHAR) AS file_id FROM customer WHERE c_custkey NOT IN
 (SELECT user_id FROM {_ATTEMPTS_SQL} GROUP BY user_id HAVING max_by(status, event_id) IN (0, 1, 2))""")
def ledger_pending(spark, d):
    files = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("file_id"))
    return pending(files, _attempts(spark, d), "j")


@_R.add("SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'view'")
def stream_new_files(spark, d):
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "target") + "/rows"
    checkpoint = scratch_path(spark, "stream")
    e = table(spark, d, "events")
    for name, condition in (("a", "event_id % 2 = 0"), ("b", "event_id % 2 = 1"), ("b", None)):
        if condition:
            _land(e, root, name, condition)
        stream = stream_delimited(spark, root, _EVENTS)
        append_available(stream.filter("event_type <> 'view'"), target, checkpoint)
    return spark.read.parquet(target)


@_R.add("""
SELECT event_type AS kind, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE user_id < 100 GROUP BY 1""")
def stream_grouped_portions(spark, d):
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "target")
    checkpoint = scratch_path(spark, "stream")
    mapping = parse_mapping("kind:event_type:NONE,n:event_type:COUNT,total:value:SUM")

    def convert(batch):
        return summarize(valid_rows(apply_ops(batch, [Filter("{user_id}", "[0-9]{1,2}")])), mapping)

    e = table(spark, d, "events")
    for name, condition in (("a", "event_id % 2 = 0"), ("b", "event_id % 2 = 1")):
        _land(e, root, name, condition)
        convert_available(stream_delimited(spark, root, _EVENTS), convert, target, checkpoint)
    portions = spark.read.schema("kind string, n bigint, total double, batch int").parquet(target)
    return portions.groupBy("kind").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@_R.add("SELECT count(*) AS rows_read, CAST(1 AS BIGINT) AS failed_files, CAST(1 AS BIGINT) AS retried FROM events")
def ledger_broken_file_alone(spark, d):
    """One broken file fails alone; the next run takes only that file."""
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "target") + "/rows"
    ledger = Ledger(spark, scratch_path(spark, "ledger") + "/rows")
    e = table(spark, d, "events")
    for i in range(4):
        _land(e, root, f"part{i}", f"event_id % 4 = {i}")
    # a large table lands as several files a folder: one of them is broken
    broken = {manifest(spark, f"{root}/part2", r"part-.*").agg(F.min("path")).first()[0]}

    def read(session, paths):
        if broken & set(paths):
            raise OSError("a broken file")
        return _read(session, paths)

    job = dict(job_id="events", source_id=1, root=root, read=read, target=target, regex=r"part-.*", run_time=dt.datetime(2024, 2, 1))
    process_files(spark, ledger, **job)
    failed = ledger.rows().filter("status = 3").count()
    broken.clear()
    retried = process_files(spark, ledger, **job)
    rows = current_rows(ledger, target, "events").unionByName(current_rows(ledger, target, "events", rejected=True).drop("_reject_reason"), allowMissingColumns=True)
    return rows.agg(F.count("*").alias("rows_read"), F.lit(failed).cast("bigint").alias("failed_files"), F.lit(retried).cast("bigint").alias("retried"))
