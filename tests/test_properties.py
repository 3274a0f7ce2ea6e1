import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from millrace import SpecError, build, run
from millrace.plans import properties as p
from millrace.plans.macros import date_macros
from millrace.operators import cells
from millrace.sources.text import read_lines


def base(scratch, **more):
    return {
        p.INPUT_TYPE: "FILETEXT",
        p.INPUT_DIR: scratch + "/in",
        p.IN_FIELD_SEP: r"[\^;]",
        p.INPUT_FIELDS: "time,id,type,price,number,message",
        p.OUTPUT_TYPE: "FILETEXT",
        p.OUTPUT_DIR: scratch + "/out",
        p.OUT_FIELD_SEP: "^",
        p.OUTPUT_FIELDS: "SID,SPRICE,SNUMBER,SMESSAGE",
        p.MAPPING: "SID:id,SPRICE:price,SNUMBER:number,SMESSAGE:message",
        **more,
    }


@pytest.fixture
def landed(scratch):
    os.makedirs(scratch + "/in")
    with open(scratch + "/in/records.txt", "w") as f:
        f.write("head\n2012-12-27 10:00:00^1000^a^1.5;3^hi\n2012-12-28 10:00:00^1001^b^x\n\n2012-12-28 10:00:00^1000^a^2.5^4^\n")
    with open(scratch + "/in/other.log", "w") as f:
        f.write("head\nnothing\n")
    return scratch


def lines(spark, path):
    return sorted(r[0] for r in read_lines(spark, path).collect())


def test_text_projection(spark, landed):
    props = base(
        landed, **{p.SKIP_LINES: "1", p.NAME_FILTER_ON: "true", p.NAME_FILTER: r"rec.*\.txt", p.DEFAULTS: "[SMESSAGE:none:x],[SNUMBER:0]"})
    counts = run(spark, p.job_from_properties(props))
    assert (counts.input, counts.output) == (3, 3)
    assert lines(spark, landed + "/out") == ["1000^1.5^3^hi", "1000^2.5^4^none:x", "1001^x^0^none:x"]


def test_text_group_by_with_rejects_and_macros(spark, landed):
    props = base(
        landed,
        **{
            p.INPUT_DIR: landed + "/{DIR}", p.SKIP_LINES: "1", p.NAME_FILTER_ON: "true", p.NAME_FILTER: r".*\.log", p.NAME_FILTER_INCLUDE: "false",
            p.MAP_OPS: "filter:{id}:100[0],digit:{number}*{YY}={twice}", p.REJECT_PATH: landed + "/bad",
            p.OUTPUT_FIELDS: "sid,sprice,mprice,avgnumber,sumnumber,rowcounts",
            p.MAPPING: "sid:id:NONE,sprice:price:MIN,mprice:price:MAX,avgnumber:twice:AVG,sumnumber:twice:SUM,rowcounts:id:COUNT",
        })
    counts = run(spark, p.job_from_properties(props, macros={"DIR": "in", **date_macros("2010")}))
    assert (counts.input, counts.filtered) == (3, 1)
    assert lines(spark, landed + "/out") == ["1000^1.5^2.5^35.0^70.0^2"]
    assert len(lines(spark, landed + "/bad")) == 1


def test_sequence_and_catalog_types(spark, landed):
    run(spark, p.job_from_properties(base(landed, **{p.OUTPUT_TYPE: "FILESEQUENCE", p.SKIP_LINES: "1"})))
    back = base(landed, **{
        p.INPUT_TYPE: "FILESEQUENCE", p.INPUT_DIR: landed + "/out", p.IN_FIELD_SEP: r"\^", p.INPUT_FIELDS: "a,b,c,d",
        p.OUTPUT_FIELDS: "a", p.MAPPING: "a:a"})
    # the line of the other file has one field only, so its id is null
    assert sorted((r[0] for r in build(spark, p.job_from_properties(back)).collect()), key=str) == ["1000", "1000", "1001", None]
    query = base(landed, **{p.INPUT_TYPE: "HIVETEXT", p.IN_QUERY: "select id k, id * 2 v from range(3)", p.INPUT_FIELDS: "x,y", p.OUTPUT_FIELDS: "s", p.MAPPING: "s:y"})
    assert [r[0] for r in build(spark, p.job_from_properties(query)).collect()] == [0, 2, 4]


def test_cell_types(spark, landed):
    layout = "[f1:head:[sid,sprice]]-[f2:m:[smessage]]"
    put = base(landed, **{p.SKIP_LINES: "1", p.NAME_FILTER_ON: "true", p.NAME_FILTER: "records.txt", p.OUTPUT_TYPE: "HBASE", "output." + p.CELLS["layout"]: layout,
                          "output." + p.CELLS["key"]: "tj-{sid}-{snumber}", p.OUTPUT_DIR: landed + "/cells"})
    with pytest.raises(SpecError):
        p.job_from_properties(put)
    run(spark, p.job_from_properties(put, run_time=dt.datetime(2020, 1, 1)))
    table = spark.read.parquet(landed + "/cells")
    assert sorted(r.row_key for r in cells.read_rows(table, cells.parse_layout(layout)).collect()) == ["tj-1000-3", "tj-1000-4", "tj-1001-{snumber}"]
    view = "cells_" + os.path.basename(landed).replace("-", "_")
    table.createOrReplaceTempView(view)
    scan = base(landed, **{
        p.INPUT_TYPE: "HBASE", "input." + p.CELLS["table"]: view, "input." + p.CELLS["layout"]: layout, "input." + p.CELLS["start"]: "tj-1000-4",
        "input." + p.CELLS["filter"]: "[filterType:17,family:f1,qualifier:head,compareOp:GREATER,value:1000]",
        p.INPUT_FIELDS: "sid,sprice,smessage", p.OUTPUT_FIELDS: "a,b", p.MAPPING: "a:sid,b:sprice"})
    assert sorted(tuple(r) for r in build(spark, p.job_from_properties(scan)).collect()) == [("1000", "2.5"), ("1001", "x")]


def test_cell_time_range_and_columns(spark, landed):
    frame = spark.createDataFrame(
        [(f"r{i}", f, q, i * 1000, "v") for i in range(4) for f, q in (("f", "a"), ("f", "b"), ("g", "c"))],
        "row_key string, family string, qualifier string, ms bigint, value string",
    ).select("row_key", "family", "qualifier", F.timestamp_millis("ms").alias("ts"), "value")
    view = "timed_" + os.path.basename(landed).replace("-", "_")
    frame.createOrReplaceTempView(view)
    scan = base(landed, **{
        p.INPUT_TYPE: "HBASE", "input." + p.CELLS["table"]: view, "input." + p.CELLS["layout"]: "[f:a:[a]]-[f:b:[b]]-[g:c:[c]]",
        "input." + p.CELLS["times"]: "1000,3000", "input." + p.CELLS["columns"]: "f:a,g:c",
        p.INPUT_FIELDS: "row_key,a,b,c", p.OUTPUT_FIELDS: "k,a,b,c", p.MAPPING: "k:row_key,a:a,b:b,c:c"})
    assert sorted(tuple(r) for r in build(spark, p.job_from_properties(scan)).collect()) == [("r1", "v", None, "v"), ("r2", "v", None, "v")]
    one = {**scan, "input." + p.CELLS["times"]: "", "input." + p.CELLS["time"]: "3000"}
    assert [r[0] for r in build(spark, p.job_from_properties(one)).collect()] == ["r3"]


def test_column_functions_in_field_names(spark, landed):
    props = base(landed, **{p.SKIP_LINES: "1", p.OUTPUT_FIELDS: "sid,msg_method(upper)method", p.MAPPING: "sid:id,msg_method(upper)method:message"})
    out = build(spark, p.job_from_properties(props))
    assert out.columns == ["sid", "msg"] and "HI" in [r["msg"] for r in out.collect()]
    with pytest.raises(SpecError):
        build(spark, p.job_from_properties({**props, p.OUTPUT_FIELDS: "sid,msg_method(drop)method", p.MAPPING: "sid:id,msg_method(drop)method:message"}))


@pytest.mark.parametrize(
    "change",
    [
        {p.INPUT_TYPE: "FTPDATA"}, {p.OUTPUT_TYPE: "PARTITION_SPLIT"}, {p.MAP_PLUGIN: "X"}, {p.INPUT_FIELDS: ""},
        {p.MAPPING: "SID:nope"}, {p.OUTPUT_FIELDS: "SID"}, {p.MAP_OPS: "what:{x}"}, {p.DEFAULTS: "[zz:1]"}, {p.MAPPING: ""},
    ],
)
def test_unusable_properties(scratch, change):
    with pytest.raises(SpecError):
        p.job_from_properties(base(scratch, **change))


def test_hook_and_sink_arguments(spark, landed):
    got = []
    spec = p.job_from_properties(
        base(landed, **{p.MAP_PLUGIN: "X", p.OUTPUT_TYPE: "PARTITION_SPLIT"}), row_hook=lambda df: df.filter(F.col("id") == "1001"),
        sink=lambda df: got.extend(df.collect()))
    run(spark, spec)
    assert [r["sid"] for r in got] == ["1001"]


@pytest.mark.parametrize("change", [{k: "true"} for k in p.REFUSED] + [{p.OUT_MAX_ROWS: "0"}, {p.REDUCE_PLUGIN: "X"}, {p.CELL_DELETE: "true"}])
def test_properties_that_change_results_are_never_ignored(scratch, change):
    with pytest.raises(SpecError):
        p.job_from_properties(base(scratch, **change))


def test_target_path_row_limit_and_partitions(spark, landed):
    target = landed + "/published"
    props = base(landed, **{p.SKIP_LINES: "1", p.NAME_FILTER_ON: "true", p.NAME_FILTER: "records.txt", p.OUT_TARGETS[0]: target,
                            p.OUT_MAX_ROWS: "1", p.OUT_PARTITIONS: "SID"})
    with pytest.raises(SpecError):
        run(spark, p.job_from_properties(props))
    run(spark, p.job_from_properties(props, run_time=dt.datetime(2024, 5, 6, 7, 8, 9)))
    rows = spark.read.text(target + "/batch=20240506070809")
    assert sorted((r.sid, r.value) for r in rows.collect()) == [(1000, "1.5^3^hi"), (1000, "2.5^4^"), (1001, "x^^")]
    assert rows.filter("sid = 1000").select("_metadata.file_name").distinct().count() == 2


def test_cell_delete(spark, landed):
    layout = "[f1:head:[sid,sprice]]"
    put = base(landed, **{p.SKIP_LINES: "1", p.NAME_FILTER_ON: "true", p.NAME_FILTER: "records.txt", p.OUTPUT_TYPE: "HBASE", "output." + p.CELLS["layout"]: layout,
                          "output." + p.CELLS["key"]: "{sid}", p.OUTPUT_DIR: landed + "/cells"})
    run(spark, p.job_from_properties(put, run_time=dt.datetime(2020, 1, 1)))
    gone = {**put, p.CELL_DELETE: "true", p.OUT_TARGETS[0]: landed + "/next", p.MAP_OPS: "filter:{id}:1001"}
    run(spark, p.job_from_properties(gone, run_time=dt.datetime(2020, 1, 2)))
    left = spark.read.parquet(landed + "/next/batch=20200102000000")
    assert {r.row_key for r in left.select("row_key").distinct().collect()} == {"1000"}


def test_archives_with_another_row_separator(spark, scratch):
    import zipfile

    os.makedirs(scratch + "/in")
    with zipfile.ZipFile(scratch + "/in/a.zip", "w") as z:
        z.writestr("m", "1^2|3^4|")
    with open(scratch + "/in/b.txt", "w") as f:
        f.write("5^6|7^8")
    props = base(scratch, **{p.IN_ROW_SEP: "|", p.INPUT_FIELDS: "a,b", p.OUTPUT_FIELDS: "b", p.MAPPING: "b:b"})
    assert sorted(r[0] for r in build(spark, p.job_from_properties(props)).collect()) == ["2", "4", "6", "8"]
    hooked = p.job_from_properties(props, line_hook=lambda t: t.replace("6", "9"))
    assert sorted(r[0] for r in build(spark, hooked).collect()) == ["2", "4", "8", "9"]


def test_windows_line_ends(spark, scratch):
    os.makedirs(scratch + "/in")
    with open(scratch + "/in/a.txt", "wb") as f:
        f.write(b"1^2\r\n3^4\r\n")
    spec = p.job_from_properties(base(scratch, **{p.INPUT_FIELDS: "a,b", p.OUTPUT_FIELDS: "b", p.MAPPING: "b:b"}))
    assert [r[0] for r in build(spark, spec).collect()] == ["2", "4"]


@pytest.mark.parametrize("name", [
    "output.mr.mapred.nonsense.flag", "input.mr.mapred.jdbc.bounding.query", "mapred.rdb.input.querysql", "mapred.rdb.input.query.params",
    "output.split.partition.params.count", "output.mr.maperd.hive.table", "input.mr.maperd.hbase.table.query.startrow", "input.mr.mapred.ftp.collect.id",
    "output.mr.mapred.jdbc.table.dropsql", "mapreduce.input.something",
])
def test_a_property_is_used_or_refused(spark, scratch, name):
    with pytest.raises(SpecError, match=name):
        p.job_from_properties(base(scratch, **{name: "x"}))
    assert p.job_from_properties(base(scratch, **{name: ""}))  # not set


def test_names_that_tune_other_engines_and_other_maps_are_left(spark, scratch):
    more = {n: "1" for n in p.TUNING} | {"mr.sys.job.id": "7", "mapred.job.tracker": "x", "own.key": "y"}
    assert p.job_from_properties(base(scratch, **more))
    with pytest.raises(SpecError, match="row limit|no effect"):
        p.job_from_properties(base(scratch, **{p.OUTPUT_TYPE: "HIVETEXT", p.OUT_TABLE: "t", p.OUT_MAX_ROWS: "5"}))
    given = base(scratch, **{p.RDB_QUERY: "select 1"})
    assert p.job_from_properties(given, source=spark.range(1).selectExpr("id time", "id", "id type", "id price", "id number", "id message"))


def test_queries_with_parameters(monkeypatch, spark, scratch):
    rows = [{"ID": 1, "NAME": "a'b", "DAY": dt.date(2024, 1, 2)}, {"ID": 2, "NAME": "c", "DAY": None}]
    asked = []

    def read(spark, db, relation, predicates=(), where=None):
        asked.append(relation)
        return spark.createDataFrame(rows, "ID int, NAME string, DAY date") if relation.startswith("select * from params") else spark.range(1).select("id")

    monkeypatch.setattr(p, "read_table", read)
    props = base(scratch, **{
        p.INPUT_TYPE: "RDBNORM", "input." + p.JDBC["url"]: "jdbc:x", p.RDB_QUERY: "select v from t where k = ? and n = '{NAME}' and d = ?",
        p.RDB_PARAMS: "select * from params", p.RDB_MACROS: "NAME", p.INPUT_FIELDS: "v", p.OUTPUT_FIELDS: "v", p.MAPPING: "v:v",
    })
    assert build(spark, p.job_from_properties(props)).count() == 2
    assert asked[1:] == ["select v from t where k = 1 and n = 'a''b' and d = DATE '2024-01-02'", "select v from t where k = 2 and n = 'c' and d = NULL"]
    asked.clear()
    assert build(spark, p.job_from_properties({**props, p.RDB_MACROS: "1"}, partitions=1)).count() == 1
    assert asked[1].count(" UNION ALL ") == 1  # several parameter rows in one split
    with pytest.raises(SpecError, match="OTHER"):
        build(spark, p.job_from_properties({**props, p.RDB_MACROS: "OTHER"}))
    literal = {**props, p.RDB_PARAMS: "'a', 3", p.RDB_QUERY: "select v from t where k = ?"}
    del literal[p.RDB_MACROS]
    asked.clear()
    build(spark, p.job_from_properties(literal))
    assert asked == ["select v from t where k = 'a'", "select v from t where k = '3'"]
