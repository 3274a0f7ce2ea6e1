import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import FieldMap, JobSpec, SpecError, build, run
from millrace.operators.rowops import Compute, Filter, apply_ops
from millrace.plans import job, ledger as lg
from millrace.plans.job import archive_source, row_hook, sample_rows, totals_by_file
from millrace.plans.macros import date_macros, now_macros, parameters, substitute
from millrace.plans.measurements import COLUMNS, read_measurements
from millrace.plans.spec import parse_defaults, parse_mapping
from millrace.sources import jdbc
from millrace.sources.ranges import (
    bind, hash_predicates, parameter_list, range_predicates, split_points, sql_literal, value_predicates,
)
from millrace.sources.text import parse_fields, read_delimited, read_lines
from millrace.sinks.jdbc import write_table
from millrace.streaming.incremental import append_available, convert_available, stream_delimited, stream_lines


# --- specification


@pytest.mark.parametrize(
    "change",
    [
        dict(mapping="a:x,b:y:SUM"),
        dict(mapping="a:x:NONE,b:y:MEDIAN"),
        dict(mapping="a:zz"),
        dict(mapping="a:x", output_fields=["b"]),
        dict(mapping="a:x", defaults={"zz": "1"}),
        dict(mapping="a:x:NONE,a:y:SUM"),
        dict(mapping="a:x", ops="nope:{x}"),
        dict(mapping="a:x", post_shuffle_ops="filter:{x}:1"),
        dict(mapping="a:x", partition_by=["zz"]),
        dict(mapping="a:x", combine="any"),
        dict(mapping=[]),
        dict(mapping="a"),
        dict(mapping="a:x:SUM:z"),
    ],
)
def test_unusable_jobs_are_refused(change):
    spec = dict(source=None, mapping="a:x", input_fields=["x", "y"])
    with pytest.raises(SpecError):
        JobSpec(**{**spec, **change}).validate()


def test_usable_jobs_pass():
    JobSpec(source=None, mapping="a:x,a:y", input_fields=["x", "y"]).validate()
    JobSpec(source=None, mapping="A:x:NONE,b:y:SUM", input_fields=["x", "y"], defaults={"a": "1"}).validate()
    assert parse_mapping("SID:Id:NONE")[0] == FieldMap("sid", "Id", "NONE")
    assert parse_defaults(["[a:1:2]", "[b:]"]) == {"a": "1:2", "b": ""}
    with pytest.raises(SpecError):
        parse_defaults(["a:1"])


def test_a_mapping_may_use_columns_made_by_operations(spark):
    df = spark.createDataFrame([(2, 3)], "x int, y int")
    spec = JobSpec(source=df, ops=[Compute("{x}*{y}", "xy")], mapping="p:xy")
    assert build(spark, spec).first()[0] == 6
    with pytest.raises(SpecError):
        build(spark, JobSpec(source=df, mapping="p:nothing"))


# --- running jobs


def test_run_counts_and_rejects(spark, scratch):
    df = spark.range(100).select(F.col("id").cast("string").alias("s"))
    spec = JobSpec(
        source=df, ops=[Filter("{s}", "[0-9]")], mapping="v:s",
        sink=lambda d: d.write.parquet(scratch + "/ok"), reject_sink=lambda d: d.write.parquet(scratch + "/bad"))
    counts = run(spark, spec)
    assert (counts.input, counts.output, counts.filtered, counts.stored) == (100, 10, 90, 10)
    assert spark.read.parquet(scratch + "/ok").columns == ["v"]
    assert (spark.read.parquet(scratch + "/ok").count(), spark.read.parquet(scratch + "/bad").count()) == (10, 90)


def test_a_job_without_sink_is_refused(spark):
    with pytest.raises(SpecError):
        run(spark, JobSpec(source=spark.range(1), mapping="v:id"))


def test_validate_only_run(spark):
    def sink(_):
        raise AssertionError("nothing may be stored")

    spec = JobSpec(source=spark.range(10).select(F.col("id").cast("string").alias("s")), ops="filter:{s}:[0-4]", mapping="v:s",
                   sink=sink, validate_only=True)
    assert run(spark, spec).filtered == 5


def test_grouped_run_with_hook_and_text_source(spark, scratch):
    os.makedirs(scratch + "/d")
    with open(scratch + "/d/in.txt", "w") as f:
        f.write("1^a^2.5\n2^a^x\n3^b^\n4^skip^1\n")
    spec = JobSpec(
        source=lambda s: read_delimited(s, scratch + "/d", ["id", "type", "price"], "^"),
        row_hook=row_hook(lambda r: [r] if r["type"] != "skip" else [], "id string, type string, price string"),
        mapping="type:type:NONE,total:price:SUM,n:id:COUNT",
        sink=lambda d: d.write.parquet(scratch + "/o"))
    counts = run(spark, spec)
    assert (counts.input, counts.filtered, counts.stored) == (4, 1, 2)
    assert sorted(tuple(r) for r in spark.read.parquet(scratch + "/o").collect()) == [("a", 2.5, 2), ("b", 0.0, 1)]


def test_collect_and_process(spark, scratch):
    import zipfile

    os.makedirs(scratch + "/d")
    with zipfile.ZipFile(scratch + "/d/a.zip", "w") as z:
        z.writestr("m", "1,x\n2,y\n")
    spec = JobSpec(source=archive_source(scratch + "/d", ["id", "v"]), mapping="v:v", ops="filter:{id}:2")
    assert [r[0] for r in build(spark, spec).collect()] == ["y"]
    assert sample_rows(spark.range(50), 3).count() == 3


# --- macros


def test_date_macros():
    m = date_macros("20130201141658")
    assert (m["YYYY"], m["YY"], m["MM"], m["M"], m["DD"], m["D"], m["HH"], m["MI"], m["SS"]) == (
        "2013", "13", "02", "2", "01", "1", "14", "16", "58")
    assert date_macros("201302")["DD"] is None
    for bad in ("201", "20130", "201313", "20130232", "2013020125", "196902", "x013", "201302011416581"):
        with pytest.raises(SpecError):
            date_macros(bad)


def test_now_macros():
    m = now_macros(dt.datetime(2012, 12, 31, 9, 5, 7))
    assert m["N_YYYYMMDDN"] == "20130101" and m["N_YYYYMMN"] == "201301" and m["N_YYYYMMP"] == "201211"
    assert m["N_YYYYMMDDP"] == "20121230" and m["N_M"] == "12" and m["N_D"] == "31" and m["N_HH"] == "09"
    assert now_macros(dt.datetime(2013, 3, 5))["N_M"] == "3"


def test_substitute():
    macros = {**date_macros("201302"), "var1": "x"}
    assert substitute("/d/{yyyy}/{Mm}/{VAR1}/{sid}", macros) == "/d/2013/02/x/{sid}"
    assert substitute("{d}-{sid}", {"d": None}, fields={"d"}) == "{d}-{sid}"
    with pytest.raises(SpecError):
        substitute("{DD}", macros)
    assert parameters(["a=1"]) == {"a": "1"}
    with pytest.raises(SpecError):
        parameters(["a"])


# --- ranges and database reads


@pytest.mark.parametrize(
    "kind, data, schema",
    [
        ("integer", [0, 1, 5, 99, -7, 2**40], "bigint"),
        ("decimal", [Decimal("0.01"), Decimal("99.90"), Decimal("-3.50"), Decimal("50.00")], "decimal(10,2)"),
        ("float", [0.0, 0.5, -1e9, 1e9, 3.25], "double"),
        ("date", [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2024, 2, 29)], "date"),
        ("timestamp", [dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 1), dt.datetime(2021, 6, 1, 12)], "timestamp_ntz"),
        ("text", ["a", "ab", "b", "it's", "zz", "数据", "~", "a%"], "string"),
        ("text", ["Customer#0001", "Customer#0009", "Customer#0005", "Customer#"], "string"),
        ("boolean", [True, False], "boolean"),
    ],
)
@pytest.mark.parametrize("n", [1, 2, 5, 16])
def test_ranges_cover_every_row_once(spark, kind, data, schema, n):
    rows = [(v,) for v in data] + [(None,)]
    df = spark.createDataFrame(rows, f"k {schema}")
    predicates = range_predicates("k", kind, min(data), max(data), n)
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert [r[0] for r in df.select(hits).collect()] == [1] * len(rows)
    assert len(predicates) <= max(n, 3)


def test_range_details():
    assert range_predicates("k", "integer", None, None, 4) == ["1 = 1"]
    assert range_predicates("k", "integer", 5, 5, 4) == ["1 = 1"]
    assert range_predicates("k", "integer", 0, 10, 2) == ["(k < 5 OR k IS NULL)", "k >= 5"]
    assert split_points("decimal", Decimal(0), Decimal(2), 8) == [Decimal(1)]
    assert "TO_DATE('2020-01-02'" in range_predicates("k", "date", dt.date(2020, 1, 1), dt.date(2020, 1, 3), 2, "oracle")[1]
    assert sql_literal("it's") == "'it''s'" and sql_literal(None) == "NULL" and sql_literal(True) == "TRUE"
    assert value_predicates("p", ["a", None, "a"]) == ["p = 'a'", "p IS NULL"]
    with pytest.raises(ValueError):
        split_points("blob", 0, 1, 2)


def test_text_ranges_with_backslashes(spark):
    data = ["C:\\a", "C:\\b\\", "C:\\b'x", "C:\\z"]
    df = spark.createDataFrame([(v,) for v in [*data, None]], "k string")
    predicates = range_predicates("k", "text", min(data), max(data), 6, dialect="spark")
    assert len(predicates) > 1
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert [r[0] for r in df.select(hits).collect()] == [1] * 5
    assert sql_literal("a\\b") == "'a\\b'" and sql_literal("a\\b", "mysql") == "'a\\\\b'"


def test_hash_predicates(spark):
    df = spark.createDataFrame([(v,) for v in (-5, -1, 0, 1, 7, None)], "k bigint")
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in hash_predicates("k", 3)), F.lit(0))
    assert {r[0] for r in df.select(hits).collect()} == {1}


def test_bind():
    row = {"A": "x'; drop", "B": 3}
    assert bind("c = {A} and d = {B}", row) == "c = 'x''; drop' and d = 3"
    assert bind("c = '{A}' and d = '{B}'", row) == "c = 'x''; drop' and d = '3'"
    assert bind("c = {PARAM_MACROS[0]} and d > {PARAM_MACROS[1]} and {other}", row) == "c = 'x''; drop' and d > 3 and {other}"
    assert bind("c = ? and d = ?", row) == "c = 'x''; drop' and d = 3"
    with pytest.raises(ValueError):
        bind("? ? ?", row)
    assert parameter_list("'a', 'b,'") != [] and [p["p"] for p in parameter_list("'a', b ,3")] == ["a", "b", "3"]


class Recorder:
    """Stands in for a session or a writer and notes the calls; no database is started."""

    def __init__(self, frame=None):
        self.calls, self.frame = [], frame
        self.read = self.write = self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self.frame

    def format(self, name):
        self.calls.append(name)
        return self

    def option(self, key, value):
        self.calls.append((key, value))
        return self

    def options(self, **kw):
        self.calls.extend(kw.items())
        return self

    def mode(self, name):
        self.calls.append(("mode", name))
        return self

    def save(self):
        self.calls.append("save")


def test_database_reads(spark):
    frame = spark.createDataFrame([(1, 9)], "lo int, hi int")
    db = jdbc.Database("jdbc:x", {"user": "u", "password": "secret"})
    assert "secret" not in repr(db)
    fake = Recorder(frame)
    jdbc.read_by_range(fake, db, "select a from t where $CONDITIONS", "a", "integer", 2)
    assert fake.calls[0][1] == "(select min(a) lo, max(a) hi from (select a from t where 1 = 1) src) src"
    assert fake.calls[1][2]["predicates"] == ["(a < 5 OR a IS NULL)", "a >= 5"]
    assert fake.calls[1][2]["properties"] == {"fetchsize": "10000", "user": "u", "password": "secret"}
    fake = Recorder(frame)
    jdbc.read_by_hash(fake, db, "t", "a", 2)
    assert fake.calls[0][2]["predicates"][1] == "ABS(MOD(a, 2)) = 1"
    fake = Recorder(frame)
    jdbc.read_partitions(fake, db, "t", ["p1", "p2"], "select a from {SRC_TABLE}")
    assert [c[1] for c in fake.calls] == ["(select a from t partition(p1)) src", "(select a from t partition(p2)) src"]
    fake = Recorder(frame)
    jdbc.read_parameterised(fake, db, "t", "a = {X}", [{"X": "q"}, {"X": "r"}])
    assert fake.calls[0][2]["predicates"] == ["a = 'q'", "a = 'r'"]
    fake = Recorder(frame)
    out = jdbc.read_shards(fake, {"s1": db, "s2": jdbc.Database("jdbc:y")}, "t")
    assert [r["_shard"] for r in out.collect()] == ["s1", "s2"] and [c[0] for c in fake.calls] == ["jdbc:x", "jdbc:y"]


def test_database_write():
    fake = Recorder()
    write_table(fake, jdbc.Database("jdbc:x"), "t", batch_size=3000, connections=8)
    assert ("batchsize", "3000") in fake.calls and ("numPartitions", "8") in fake.calls and fake.calls[-1] == "save"


# --- ledger


def attempts(spark, data):
    rows = [(run, 0, "j", 1, f"id-{f}", f"/d/{f}", dt.datetime(2024, 1, run), status) for run, f, status in data]
    schema = "run_id bigint, seq int, job_id string, source_id int, file_id string, file_path string, start_time timestamp, status int"
    return spark.createDataFrame(rows, schema)


def names(df, column="file_id"):
    return sorted(r[column] for r in df.collect())


def test_file_selection(spark):
    ledger = attempts(spark, [(1, "a", 2), (1, "b", 3), (1, "c", 3), (2, "c", 2), (1, "d", 0), (2, "e", 3), (1, "f", 4)])
    files = spark.createDataFrame([(f"id-{f}",) for f in "abcdefg"], "file_id string")
    assert names(lg.pending(files, ledger, "j")) == ["id-b", "id-e", "id-f", "id-g"]
    assert names(lg.pending(files, ledger, "other")) == [f"id-{f}" for f in "abcdefg"]
    assert names(lg.failed_in_run(ledger, "j", 1)) == ["id-b", "id-c"]
    assert names(lg.failed_latest(ledger, "j")) == ["id-b", "id-e"]
    early = lg.failed_latest(ledger, "j", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 12))
    assert names(early) == ["id-b", "id-c"]
    assert names(lg.rerun(files.filter("file_id <> 'id-b'"), lg.failed_latest(ledger, "j"))) == ["id-e"]
    gone = lg.vanished(lg.failed_latest(ledger, "j"), files.filter("file_id <> 'id-b'"))
    assert [(r.file_id, r.status, r.seq) for r in gone.collect()] == [("id-b", lg.DELETED, 1)]


def test_changed_files_and_failure_lists(spark):
    t = dt.datetime(2024, 1, 1)
    done = spark.createDataFrame([("a", t, 2), ("b", t, 2), ("c", t, 3)], "file_id string, modified timestamp, status int")
    now = spark.createDataFrame([("a", t), ("b", t + dt.timedelta(1)), ("c", t), ("d", t)], "file_id string, modified timestamp")
    assert names(lg.changed(now, done)) == ["b", "c", "d"]
    assert lg.failure_list(now, done, ["file_id"]).count() == 4


def test_incremental_runs(spark, scratch):
    root, target = scratch + "/in", scratch + "/out"
    ledger = lg.Ledger(spark, scratch + "/ledger")

    def land(name, text):
        os.makedirs(root, exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)

    state = {"fail": False}

    def read(session, paths):
        if state["fail"]:
            return read_lines(session, paths, provenance=True).withColumn("n", F.raise_error(F.lit("broken")).cast("string"))
        df = read_delimited(session, paths, ["n"], provenance=True)
        return apply_ops(df, [Filter("{n}", r"\d+")])

    job = dict(job_id="j", source_id=1, root=root, read=read, target=target, run_time=dt.datetime(2024, 1, 1))
    land("a.txt", "1\n2\nx\n")
    land("b.txt", "3\n")
    assert lg.process_files(spark, ledger, **job) == 2
    assert lg.process_files(spark, ledger, **job) == 0
    totals = {r.file_path.split("/")[-1]: (r.total, r.success, r.failed, r.status) for r in ledger.rows().collect()}
    assert totals == {"a.txt": (3, 2, 1, 2), "b.txt": (1, 1, 0, 2)}
    current = lambda: sorted(r.n for r in lg.current_rows(ledger, target, "j").collect())
    assert current() == ["1", "2", "3"]
    assert [r.n for r in lg.current_rows(ledger, target, "j", rejected=True).collect()] == ["x"]

    land("a.txt", "7\n")  # reprocessing replaces the rows of the file, also its rejects
    assert lg.process_files(spark, ledger, **job, mode="force") == 2
    assert current() == ["3", "7"]
    assert lg.current_rows(ledger, target, "j", rejected=True).count() == 0

    land("c.txt", "9\n")
    state["fail"] = True
    assert lg.process_files(spark, ledger, **job) == 0
    state["fail"] = False
    assert current() == ["3", "7"]
    assert lg.process_files(spark, ledger, **job, mode="fail") == 1
    assert current() == ["3", "7", "9"]
    assert lg.process_files(spark, ledger, **job, mode="run", run_id=3) == 1
    assert lg.process_files(spark, ledger, **job, mode="time", between=(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))) == 0


def test_vanished_failed_file_is_marked(spark, scratch):
    os.makedirs(scratch + "/in")
    open(scratch + "/in/a.txt", "w").close()
    ledger = lg.Ledger(spark, scratch + "/ledger")
    files = lg.identified(spark.createDataFrame([("/gone.txt", 1, dt.datetime(2024, 1, 1))], "path string, size bigint, modified timestamp"), 1)
    zero = F.lit(None).cast("bigint")
    ledger.append(files.withColumns({"run_id": F.lit(1), "seq": F.lit(0), "job_id": F.lit("j"), "start_time": F.lit(dt.datetime(2024, 1, 1)),
                                     "status": F.lit(lg.FAILED), "total": zero, "success": zero, "failed": zero, "error_path": F.lit("")}))
    n = lg.process_files(spark, ledger, job_id="j", source_id=1, root=scratch + "/in", read=None, target=scratch + "/o",
                         run_time=dt.datetime(2024, 1, 1), mode="fail")
    assert n == 0
    assert [r.status for r in lg.latest_attempts(ledger.rows()).collect()] == [lg.DELETED]


def test_totals_by_file(spark):
    df = spark.createDataFrame([("f", True), ("f", False), ("g", True)], "_file_path string, _valid boolean")
    assert sorted(tuple(r) for r in totals_by_file(df).collect()) == [("f", 2, 1, 1), ("g", 1, 1, 0)]


# --- streaming


def test_stream_reads_each_file_once(spark, scratch):
    os.makedirs(scratch + "/in")
    for name in ("a1.txt", "a2.txt", "b.txt"):
        with open(f"{scratch}/in/{name}", "w") as f:
            f.write("1,x\n2,y\n")
    go = lambda: append_available(
        stream_delimited(spark, scratch + "/in", "n int, s string", name_regex=r"a\d\.txt", files_per_batch=1), scratch + "/out", scratch + "/cp")
    assert go() == 4
    assert go() == 0
    assert spark.read.parquet(scratch + "/out").count() == 4
    assert stream_lines(spark, scratch + "/in", provenance=True).columns == ["value", "_file_path"]


def test_stream_portions_may_be_grouped(spark, scratch):
    os.makedirs(scratch + "/in")
    convert = lambda b: b.groupBy("s").agg(F.sum("n").alias("n"))
    for i in range(2):
        with open(f"{scratch}/in/{i}.txt", "w") as f:
            f.write("1,x\n2,x\n")
        convert_available(stream_delimited(spark, scratch + "/in", "n int, s string"), convert, scratch + "/out", scratch + "/cp")
    assert sorted(tuple(r) for r in spark.read.parquet(scratch + "/out").select("s", "n", "batch").collect()) == [("x", 3, 0), ("x", 3, 1)]


# --- measurement files


DOCUMENT = """<?xml version="1.0" encoding="UTF-8"?>
<measCollecFile>
<fileHeader fileFormatVersion="32.435" vendorName="V"><fileSender elementType="ENB"/><measCollec beginTime="2015-04-17T02:00:00+08:00"/></fileHeader>
<measData><managedElement localDn="Server=102900,SBNID=510101,ENODEBID=634884" userLabel="north"/>
<measInfo><granPeriod duration="PT900S" endTime="2015-04-17T02:15:00+08:00"/><measTypes>c1 c2</measTypes>
<measValue measObjLdn="Server=102900,CellID=1"><measResults>10 20</measResults><suspect>false</suspect></measValue>
<measValue measObjLdn="Server=102900,CellID=2"><measResults>30 40</measResults><suspect>true</suspect></measValue>
</measInfo></measData>
<fileFooter><measCollec endTime="2015-04-17T02:15:00+08:00"/></fileFooter>
</measCollecFile>
"""


def test_measurement_file(spark, scratch):
    os.makedirs(scratch + "/d")
    for i in range(2):
        with open(f"{scratch}/d/{i}.xml", "w") as f:
            f.write(DOCUMENT)
    out = read_measurements(spark, scratch + "/d")
    assert tuple(out.columns) == COLUMNS
    rows = sorted(tuple(r) for r in out.distinct().collect())
    head = ("32.435", "V", "ENB", "2015-04-17 02:00:00", "north", "102900", "510101", "634884", "2015-04-17 02:15:00", "PT900S")
    assert rows == [(*head, "1", "false", "c1", "10"), (*head, "1", "false", "c2", "20"), (*head, "2", "true", "c1", "30"), (*head, "2", "true", "c2", "40")]
    assert out.count() == 8


def test_a_broken_file_fails_alone(spark, scratch, monkeypatch):
    monkeypatch.setattr(lg, "PORTION", 3)
    os.makedirs(scratch + "/in")
    for name in "abcdefg":
        with open(f"{scratch}/in/{name}.txt", "w") as f:
            f.write(f"{name}\n")
    broken = {"d.txt"}

    def read(session, paths):
        if any(p.rsplit("/", 1)[-1] in broken for p in paths):
            raise OSError("broken")
        return read_lines(session, paths, provenance=True)

    ledger = lg.Ledger(spark, scratch + "/ledger")
    job = dict(job_id="j", source_id=1, root=scratch + "/in", read=read, target=scratch + "/out", run_time=dt.datetime(2024, 1, 1))
    assert lg.process_files(spark, ledger, **job) == 6
    status = {r.file_path.rsplit("/", 1)[-1]: r.status for r in ledger.rows().collect()}
    assert status == {**{f"{n}.txt": lg.SUCCESS for n in "abcefg"}, "d.txt": lg.FAILED}
    broken.clear()
    assert lg.process_files(spark, ledger, **job) == 1
    assert sorted(r.value for r in lg.current_rows(ledger, scratch + "/out", "j").collect()) == list("abcdefg")


def test_overlapping_runs_get_different_numbers(spark, scratch):
    ledger = lg.Ledger(spark, scratch + "/ledger")
    assert [ledger.claim_run(scratch + "/t")[0] for _ in range(3)] == [1, 2, 3]


def test_counts_of_a_sink_that_reads_its_input_twice(spark, scratch):
    df = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    seen = []
    spec = JobSpec(source=df, ops=[Filter("{s}", ".*[05]", keep=False)], mapping="v:s",
                   sink=lambda d: d.repartitionByRange(4, "v").write.parquet(scratch + "/ok"), reject_sink=lambda d: seen.append(d.count()))
    counts = run(spark, spec)
    assert (counts.input, counts.output, counts.filtered, counts.stored, seen) == (1000, 800, 200, 800, [200])


def test_rejects_after_grouping_and_null_marks_are_counted(spark, scratch):
    df = spark.createDataFrame([("a", "1", True), ("a", "x", True), ("b", "2", None), ("b", "3", False)], "k string, v string, _valid boolean")
    bad = []
    spec = JobSpec(source=df, mapping="k:k:NONE,n:v:COUNT", post_shuffle_ops=[Filter("{v}", r"\d")],
                   sink=lambda d: d.write.parquet(scratch + "/g"), reject_sink=lambda d: bad.extend(d.collect()))
    counts = run(spark, spec)
    assert (counts.input, counts.output, counts.filtered, counts.stored) == (4, 1, 3, 1)
    assert sorted(r.v for r in bad) == ["2", "3", "x"]
    assert [(r.k, r.n) for r in build(spark, spec).collect()] == [("a", 1)]


def test_line_hook_and_group_hook(spark):
    lines = spark.createDataFrame([("1,a",), ("2,b;3,b",), ("#",)], "value string")
    spec = JobSpec(
        source=lines, line_hook=lambda t: None if t == "#" else t.replace(";", "\n"), parse=lambda d: parse_fields(d, ["n", "k"], ","),
        mapping="k:k:NONE,c:n:COUNT", group_hook=lambda d: d.filter("c > 1"))
    assert [tuple(r) for r in build(spark, spec).collect()] == [("b", 2)]
    with pytest.raises(SpecError):
        build(spark, JobSpec(source=lines, mapping="v:value", group_hook=lambda d: d))


def test_a_run_reads_and_keeps_only_mapped_columns(spark, scratch):
    """A wide source: unmapped columns are neither read nor copied, unless a reject sink shows them."""
    wide = spark.range(50).select("id", *[(F.col("id") + i).alias(f"c{i}") for i in range(40)])
    wide.write.parquet(scratch + "/wide")
    source = spark.read.parquet(scratch + "/wide")
    out = {}
    spec = JobSpec(
        source=source, ops="filter:{c3}:[0-9]", mapping="a:id,b:c7",
        sink=lambda df: df.write.parquet(scratch + "/out"),
    )
    plan = job.staged_rows(job.marked_rows(spark, spec), spec)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert read == "ReadSchema: struct<id:bigint,c3:bigint,c7:bigint>" or sorted(read[19:-1].split(",")) == ["c3:bigint", "c7:bigint", "id:bigint"]
    counts = run(spark, spec)
    assert (counts.input, counts.output, counts.filtered, counts.stored) == (50, 7, 43, 7)
    assert sorted(tuple(r) for r in spark.read.parquet(scratch + "/out").collect()) == [(i, i + 7) for i in range(7)]
    spec.sink, spec.reject_sink = (lambda df: df.write.parquet(scratch + "/out2")), (lambda df: out.update(bad=df.collect(), columns=df.columns))
    assert run(spark, spec) == counts
    assert len(out["bad"]) == 43 and out["columns"][:41] == wide.columns and all(r["c39"] == r["id"] + 39 for r in out["bad"])


def _run(spark, scratch, read):
    ledger = lg.Ledger(spark, scratch + "/ledger")
    return ledger, lambda: lg.process_files(
        spark, ledger, job_id="j", source_id=1, root=scratch + "/in", read=read, target=scratch + "/t", run_time=dt.datetime(2024, 1, 1))


def test_a_fault_of_every_file_ends_the_run(spark, scratch):
    """A bug in ``read`` is no broken file: few jobs, then the error; nothing is FAILED."""
    os.makedirs(scratch + "/in")
    for i in range(40):
        with open(f"{scratch}/in/{i:03d}.txt", "w") as f:
            f.write("x\n")
    calls = []

    def broken(_, paths):
        calls.append(len(paths))
        raise TypeError(f"bug number {len(calls)}")

    ledger, go = _run(spark, scratch, broken)
    with pytest.raises(TypeError):
        go()
    assert len(calls) < 30 and ledger.rows().count() == 0

    def away(_, paths):
        calls.append(len(paths))
        raise OSError("No space left on device")

    calls.clear()
    with pytest.raises(OSError):
        _run(spark, scratch, away)[1]()
    assert calls == [40]


def test_portions_side_by_side(spark, scratch, monkeypatch):
    monkeypatch.setattr(lg, "PORTION", 3)
    os.makedirs(scratch + "/in")
    for i in range(14):
        with open(f"{scratch}/in/{i:03d}.txt", "w") as f:
            f.write(f"{i}\n" * (i + 1))

    def read(session, paths):
        if any("005" in p for p in paths):
            raise ValueError("cannot read 005.txt")
        return session.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file_path"))

    ledger, go = _run(spark, scratch, read)
    assert go() == 13
    told = {r["file_path"][-7:-4]: (r["status"], r["total"]) for r in ledger.rows().collect()}
    assert told == {f"{i:03d}": (lg.FAILED, None) if i == 5 else (lg.SUCCESS, i + 1) for i in range(14)}
    assert lg.current_rows(ledger, scratch + "/t", "j").count() == sum(range(1, 15)) - 6


def test_one_broken_file_of_a_large_landing(spark, scratch):
    """Tables that land as several files a folder: the query still breaks one file and runs it again."""
    from millrace.catalogue.increments import QUERIES

    rows = spark.range(400).selectExpr("id AS event_id", "id % 7 AS user_id", "element_at(array('view', 'error'), int(id % 2) + 1) AS event_type", "double(id) AS value")
    rows.repartition(8).write.parquet(f"{scratch}/events.parquet")
    assert QUERIES["ledger_broken_file_alone"](spark, scratch).collect() == [(400, 1, 1)]
