"""Ledger of processed files: skip what is done, rerun what failed.

The ledger is an append-only table; a later row of a file supersedes an earlier
one.  A run writes its rows to a folder of its own and the ledger last, which
makes them current: readers take the rows of each file from its latest
successful run.  A run that broke off leaves nothing visible, and a reprocessed
file replaces its earlier rows without any folder being rewritten.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter, deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import batched
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import file_id
from millrace.operators.latest import latest_per_key, within, without
from millrace.operators.rejects import write_split
from millrace.operators.rowops import VALID, mark_valid, rejected_rows, valid_rows
from millrace.plans.job import totals_by_file
from millrace.session import collect_small, create_file, path_exists, scratch_path
from millrace.sources.files import manifest

# Status of an attempt.
INIT, DOING, SUCCESS, FAILED, DELETED = 0, 1, 2, 3, 4

SCHEMA = """run_id bigint, seq int, job_id string, source_id int, file_id string, file_path string,
 size bigint, modified timestamp, start_time timestamp, status int, total bigint, success bigint,
 failed bigint, error_path string"""

FILE_KEY = ["source_id", "file_path"]
ATTEMPT = ["run_id", "seq"]


def plain_path(path: Column) -> Column:
    """Path without scheme and host, as different readers spell those differently."""
    return F.regexp_replace(path, r"^[A-Za-z0-9+.-]+:(?://[^/]*)?", "")


def identified(files: DataFrame, source_id: int) -> DataFrame:
    """Manifest rows with the file's identity."""
    path = plain_path(F.col("path"))
    return files.withColumns(
        {"source_id": F.lit(source_id), "file_path": path, "file_id": file_id(source_id, path)}
    )


def latest_attempts(ledger: DataFrame, keys=FILE_KEY, order=ATTEMPT) -> DataFrame:
    return latest_per_key(ledger, keys, order)


def pending(files: DataFrame, ledger: DataFrame, job_id: str) -> DataFrame:
    """Default run: files never tried and files whose latest attempt failed.

    Started, running and finished files are skipped; a file that disappeared
    and came back is new again.
    """
    mine = ledger.filter(F.col("job_id") == job_id)
    settled = latest_attempts(mine, ["file_id"]).filter(F.col("status").isin(INIT, DOING, SUCCESS))
    return without(files, settled, ["file_id"])


def failed_in_run(ledger: DataFrame, job_id: str, run_id: int) -> DataFrame:
    """Files that failed in one run."""
    return ledger.filter((F.col("job_id") == job_id) & (F.col("run_id") == run_id) & (F.col("status") == FAILED))


def failed_latest(ledger: DataFrame, job_id: str, start=None, end=None) -> DataFrame:
    """Files whose latest attempt (started in the given time range, ends included) failed."""
    mine = ledger.filter(F.col("job_id") == job_id)
    if start is not None:
        mine = mine.filter(F.col("start_time").between(F.lit(start), F.lit(end)))
    return latest_attempts(mine).filter(F.col("status") == FAILED)


def rerun(files: DataFrame, failed: DataFrame) -> DataFrame:
    """Listed files among the failed ones."""
    return within(files, failed, ["file_id"])


def vanished(failed: DataFrame, files: DataFrame) -> DataFrame:
    """Failed files that are no longer there, as ledger rows with status DELETED."""
    gone = without(failed, files, ["file_id"])
    return gone.withColumns({"status": F.lit(DELETED), "seq": F.col("seq") + 1})


def changed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files to collect again: not yet collected with success at this modification time."""
    done = ledger.filter(F.col("status") == SUCCESS)
    return without(files, done, ["file_id", "modified"])


def with_details(attempts: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Attempt log joined with its detail log."""
    return attempts.join(details, key, "inner")


def failure_list(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Failures found by either log, each once."""
    return first.select(*keys).union(second.select(*keys)).distinct()


class Ledger:
    """The ledger table under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        names = [f.name for f in self.spark.createDataFrame([], SCHEMA).schema.fields]
        rows.select(*names).hint("rebalance").write.mode("append").parquet(self.path)

    def claim_run(self, target: str) -> tuple[int, str]:
        """Number and folder of a new run.

        The folder is claimed by creating a file in it that must not exist yet,
        so two runs that start together get different numbers.
        """
        number = (self.rows().agg(F.max("run_id")).first()[0] or 0) + 1
        while True:
            folder = f"{target.rstrip('/')}/run_id={number}"
            if create_file(self.spark, f"{folder}/_claimed"):
                return number, folder
            number += 1


#: Files of one write.
PORTION = 1000
#: Portions written side by side.
AT_ONCE = 4
#: So many single files failing for the same reason, none done, are a fault of their own.
SAME_REASON = 8
# What a lost cluster or a full disk says.
CLUSTER_FAULTS = ("SparkContext was shut down", "No space left on device", "Disk quota exceeded", "Job aborted due to stage failure: Task not serializable")


def process_files(
    spark: SparkSession,
    ledger: Ledger,
    *,
    job_id: str,
    source_id: int,
    root: str,
    read: Callable[[SparkSession, list[str]], DataFrame],
    target: str,
    run_time: dt.datetime,
    mode: str = "default",
    run_id: int | None = None,
    between: tuple | None = None,
    regex: str | None = None,
) -> int:
    """One incremental run; returns the number of files stored.

    ``mode``: default, force (all files), run (failures of ``run_id``), time
    (latest attempt in ``between`` failed) or fail (latest attempt failed).
    ``read`` gives rows with ``_file_path`` and, if it checks rows, ``_valid``.

    The chosen files are listed once, in a scratch table, and go through in
    portions of ``PORTION`` files, a few side by side, however many there are.  A
    portion that cannot be written is halved until the broken file stands alone:
    that file is FAILED, the others SUCCESS.  A fault that isn't a file's (a lost
    cluster, or the same error for file after file) ends the run instead.  Every portion enters the ledger when it is
    done, so a run that breaks off keeps what it has stored.
    """
    files = identified(manifest(spark, root, regex), source_id)
    old = ledger.rows()
    if mode == "default":
        chosen = pending(files, old, job_id)
    elif mode == "force":
        chosen = files
    else:
        failed = {
            "run": lambda: failed_in_run(old, job_id, run_id),
            "time": lambda: failed_latest(old, job_id, *between),
            "fail": lambda: failed_latest(old, job_id),
        }[mode]()
        ledger.append(vanished(failed, files))
        chosen = rerun(files, failed)
    place = scratch_path(spark, "pending") + "/files"
    kept = chosen.select("path", "source_id", "file_path", "file_id", "size", "modified")
    kept.write.parquet(place)
    listed = spark.read.schema(kept.schema).parquet(place)
    count = listed.count()
    if not count:
        return 0
    this_run, folder = ledger.claim_run(target)
    constants = {
        "run_id": F.lit(this_run), "seq": F.lit(0), "job_id": F.lit(job_id), "start_time": F.lit(run_time),
        "error_path": F.lit(None).cast("string"),
    }
    seen, appending = _Failures(), Lock()

    def store(number: int, own: list) -> int:
        totals: dict[str, tuple | None] = {}
        for part, counted in _written(spark, read, source_id, own, f"{folder}/portion={number}", seen):
            totals |= {r["file_id"]: counted.get(r["file_id"], (0, 0, 0)) if counted is not None else None for r in part}
        rows = [(*r[1:], *((SUCCESS, *totals[r["file_id"]]) if totals[r["file_id"]] else (FAILED, None, None, None))) for r in own]
        names = "status int, total bigint, success bigint, failed bigint"
        schema = T.StructType([*kept.schema.fields[1:], *T.StructType.fromDDL(names).fields])
        with appending:  # two writes to one folder would share its temporary files
            ledger.append(spark.createDataFrame(rows, schema).withColumns(constants))
        return sum(t is not None for t in totals.values())

    with ThreadPoolExecutor(AT_ONCE) as pool:
        # The list passes through the driver once, a partition at a time; at most two rounds of portions are held.
        stored, waiting = 0, deque()
        for number, own in enumerate(batched(listed.toLocalIterator(), PORTION)):
            waiting.append(pool.submit(store, number, list(own)))
            if len(waiting) >= 2 * AT_ONCE:
                stored += waiting.popleft().result()
        return stored + sum(w.result() for w in waiting)


class _Failures:
    """Reasons of the single files that failed, to tell broken files from a fault that breaks every file."""

    def __init__(self):
        self.reasons: Counter[str] = Counter()
        self.succeeded = False

    def about_a_file(self, error: Exception, files: list) -> bool:
        """False for a fault of the cluster or of ``read``: one that says so, or the same reason for many files and no success."""
        text = str(error)
        if any(sign in text for sign in CLUSTER_FAULTS):
            return False
        if len(files) > 1 or self.succeeded or files[0]["path"].rsplit("/", 1)[-1] in text:
            return True
        reason = f"{type(error).__name__}: {re.sub(r'[0-9]+', '#', text)[:500]}"
        self.reasons[reason] += 1
        return self.reasons[reason] < SAME_REASON


def _written(spark, read, source_id: int, files: list, folder: str, seen: _Failures) -> Iterator[tuple[list, dict | None]]:
    """Write the rows of some files; yields them with their totals by file, or a single broken file with None."""
    if not files:
        return
    try:
        rows = mark_valid(read(spark, [r["path"] for r in files]))
        rows = rows.withColumn("file_id", file_id(source_id, plain_path(F.col("_file_path")))).drop("_file_path")
        write_split(rows, folder, mode="overwrite")
    except Exception as error:
        if not seen.about_a_file(error, files):
            raise
        if len(files) == 1:
            yield files, None
            return
        half = len(files) // 2
        yield from _written(spark, read, source_id, files[:half], folder + "a", seen)
        yield from _written(spark, read, source_id, files[half:], folder + "b", seen)
        return
    seen.succeeded = True
    # counted on the rows just written: two narrow columns, not the source again
    totals = totals_by_file(spark.read.schema(rows.schema).parquet(folder), "file_id")
    yield files, {r["file_path"]: (r["total"], r["success"], r["failed"]) for r in totals.collect()}


def current_rows(ledger: Ledger, target: str, job_id: str, rejected: bool = False) -> DataFrame:
    """Accepted (or rejected) rows of every file's latest successful run.

    Only run folders the ledger names are listed and read.
    """
    done = ledger.rows().filter((F.col("job_id") == job_id) & (F.col("status") == SUCCESS))
    current = latest_attempts(done.select(*FILE_KEY, *ATTEMPT, "file_id"))
    runs = collect_small(current.select("run_id").distinct(), 100_000, "runs with current rows")
    folders = [f"{target.rstrip('/')}/run_id={r['run_id']}" for r in runs]
    if not folders:
        raise ValueError(f"job {job_id} has stored nothing under {target}")
    stored = ledger.spark.read.option("basePath", target).parquet(*folders).withColumns(
        {"run_id": F.col("run_id").cast("bigint"), VALID: F.col(VALID).cast("boolean")}
    )
    rows = within(stored, current, ["run_id", "file_id"])
    rows = rows.drop("portion")
    return rejected_rows(rows) if rejected else valid_rows(rows)
