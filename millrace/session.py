"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the jobs rely on; a cluster's own settings win (see get_session).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Executors on other hosts must be able to read what is written here, so a
    machine-local folder is used only when Spark itself runs in one process.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="run-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared scratch root, removed when the JVM ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; False if it does."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        fs.create(hadoop_path, False).close()
    except Py4JJavaError:
        if fs.exists(hadoop_path):
            return False
        raise
    return True


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, such as a control file or an archive of a few rows, through Spark's file systems."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop_path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


@contextmanager
def open_writers(spark: SparkSession, count: int):
    """Let a task keep ``count`` partition files open, so a partitioned write needs no sort."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(count, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def collect_small(df, limit: int, what: str) -> list:
    """Rows of a control table (bounds, parameters, file lists), never of data.

    Reads one row more than allowed, so an unexpectedly large table is an
    error and is not pulled through the driver.
    """
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows
