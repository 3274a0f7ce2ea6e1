import pytest
from pyspark.sql import functions as F

from millrace.operators import cells, hooks, rowops
from millrace.operators.aggregate import summarize
from millrace.operators.latest import latest_per_key, row_window, within, without
from millrace.operators.project import apply_column_functions, apply_defaults, project, unique_key
from millrace.operators.rejects import count_rows, read_split, reject_lines, write_split
from millrace.operators.rowops import Compute, FileNamePart, Filter, ReplaceValue, Reverse, apply_ops, parse_ops
from millrace.plans.spec import FieldMap, SpecError, parse_mapping


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_last_nonempty_source_wins(spark):
    df = spark.createDataFrame([("a", ""), ("a", None), ("a", "b"), ("", None), (None, ""), (None, None)], "x string, y string")
    out = project(df, parse_mapping("v:x,v:y"))
    assert [r[0] for r in out.collect()] == ["a", "a", "b", "", "", None]


def test_last_nonempty_of_mixed_types(spark):
    df = spark.createDataFrame([(1, ""), (2, "z"), (None, None)], "x int, y string")
    assert [r[0] for r in project(df, parse_mapping("v:x,v:y")).collect()] == ["1", "z", None]


def test_all_none_is_a_projection(spark):
    df = spark.createDataFrame([("a",), ("a",)], "x string")
    assert summarize(df, parse_mapping("k:x:NONE")).count() == 2


def test_defaults_fill_null_and_empty_only(spark):
    df = spark.createDataFrame([("", None), (None, 2), ("x", 0)], "s string, n int")
    assert rows(apply_defaults(df, {"s": "d", "n": "7"})) == [("d", 2), ("d", 7), ("x", 0)]
    with pytest.raises(SpecError):
        apply_defaults(df, {"zz": "1"})


def test_column_functions_are_limited(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert apply_column_functions(df, {"s": "upper"}).first()[0] == "A"
    with pytest.raises(SpecError):
        apply_column_functions(df, {"s": "java_method"})


def test_unique_key(spark):
    df = spark.range(0, 1000, 1, 7).select(unique_key(F.lit("k")).alias("k"))
    assert df.distinct().count() == 1000


# --- row operations


def test_filter_skips_rows_without_a_value(spark):
    df = spark.createDataFrame([("120131",), ("1213",), (None,), ("",)], "phone string")
    marked = apply_ops(df, [Filter("{phone}", "[1-9]+")])
    assert [r["_valid"] for r in marked.collect()] == [False, True, True, False]
    flipped = apply_ops(df, [Filter("{phone}", "[1-9]+", keep=False)])
    assert [r["_valid"] for r in flipped.collect()] == [True, False, True, True]


def test_filters_and_or_last(spark):
    df = spark.createDataFrame([("1", "x"), ("a", "y"), ("1", None)], "p string, q string")
    ops = [Filter("{p}", r"\d"), Filter("{q}", "y")]
    assert [r["_valid"] for r in apply_ops(df, ops).collect()] == [False, False, True]
    assert [r["_valid"] for r in apply_ops(df, ops, combine="last").collect()] == [False, True, True]


def test_operations_after_a_failed_filter_still_run(spark):
    df = spark.createDataFrame([("ab",)], "s string")
    r = apply_ops(df, [Filter("{s}", "x"), Reverse(["s"])]).first()
    assert (r["s"], r["_valid"], r["_reject_reason"]) == ("ba", False, "filter {s}:x")


def test_value_map_is_not_chained(spark):
    df = spark.createDataFrame([("203", 1), ("202", 2), (None, 3), ("9", 4)], "a string, b int")
    op = ReplaceValue("a", {"203": "202", "202": "00002"})
    assert [r[0] for r in op.apply(df).collect()] == ["202", "00002", None, "9"]
    assert [r[1] for r in ReplaceValue("b", {"1": "one"}).apply(df).collect()] == ["one", "2", "3", "4"]
    assert ReplaceValue("absent", {"1": "2"}).apply(df) is df


def test_reverse(spark):
    df = spark.createDataFrame([("asdf#23", "fewfwe", None)], "phone string, name string, pas string")
    assert tuple(Reverse(["phone", "name", "pas", "absent"]).apply(df).first()) == ("32#fdsa", "ewfwef", "")


@pytest.mark.parametrize(
    "op, expected",
    [
        (FileNamePart("f", "index", 0, 3), "hiv"),
        (FileNamePart("f", "index", 0, 12), "old"),
        (FileNamePart("f", "split", 1, pattern="_"), "txt.txt"),
        (FileNamePart("f", "split", 2, pattern="_"), "old"),
        (FileNamePart("f", "split", 1, pattern="t"), "x"),
        (FileNamePart("f", "split", 4, pattern="t"), "old"),
        (FileNamePart("f", "regex", pattern=r"^(\w+)_(\w+)\..*", replacement="$2-$1"), "txt-hive"),
        (FileNamePart("f", "regex", pattern="zzz", replacement="a"), "old"),
    ],
)
def test_file_name_part(spark, op, expected):
    df = spark.createDataFrame([("old", "file:///d/hive_txt.txt")], "f string, _file_path string")
    assert op.apply(df).first()["f"] == expected


def test_parse_ops(spark):
    ops = parse_ops("digit:({a}+1)/2={c},conreplace:{A1}:{203}-{00001}:{202}-{00002},filename:{p}:split[{_}-{1}],"
                    "filename:reg:{p}~^a~b,filename:{p}:index[0-3],reverse:{x}:{y},replace:{z},filter:{p}:[1-9]+")
    assert [type(o).__name__ for o in ops] == [
        "Compute", "ReplaceValue", "FileNamePart", "FileNamePart", "FileNamePart", "Reverse", "SourcePath", "Filter"]
    assert ops[1].values == {"203": "00001", "202": "00002"}


@pytest.mark.parametrize("text", ["digit:{a}+1", "filter:{a}:x:y", "filter:{a}:[1,2]", "nope:{a}", "reverse", "filename:{p}:index[3-1]",
                                  "conreplace:{a}:x-y", "filename:{p}:other"])
def test_unclear_operations_are_errors(text):
    with pytest.raises(SpecError):
        parse_ops(text)


def test_reject_outputs_add_up(spark, scratch):
    df = spark.range(100).select(F.col("id").cast("string").alias("s"))
    marked = apply_ops(df, [Filter("{s}", "[0-9]")])
    assert tuple(count_rows(marked).first()) == (100, 10, 90)
    write_split(marked, scratch + "/x")
    good, bad = read_split(spark, scratch + "/x", marked.schema)
    assert (good.count(), bad.count()) == (10, 90)
    assert good.columns == ["s"]
    assert reject_lines(marked).first()[0] == "filter {s}:[0-9]\t10"
    assert tuple(count_rows(apply_ops(df.limit(0), [])).first()) == (0, 0, 0)


# --- group-by


def test_text_measures(spark):
    df = spark.createDataFrame(
        [("a", "10"), ("a", "9"), ("a", ""), ("a", None), ("b", "10"), ("b", "9"), ("b", "x"), ("c", None), ("c", " 3 ")],
        "k string, v string")
    out = summarize(df, parse_mapping("k:k:NONE,lo:v:MIN,hi:v:MAX,s:v:SUM,m:v:AVG,n:v:COUNT"))
    assert rows(out) == [
        ("a", "9", "10", 19.0, 4.75, 4), ("b", "10", "x", 19.0, 19.0 / 3, 3), ("c", " 3 ", " 3 ", 3.0, 1.5, 2)]


def test_null_rules(spark):
    df = spark.createDataFrame([("a", None), ("a", 4.0), ("b", None)], "k string, v double")
    mapping = parse_mapping("k:k:NONE,s:v:SUM,m:v:AVG")
    assert rows(summarize(df, mapping)) == [("a", 4.0, 2.0), ("b", 0.0, 0.0)]
    assert rows(summarize(df, mapping, nulls_as_zero=False)) == [("a", 4.0, 4.0), ("b", None, None)]


def test_empty_and_null_keys(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "k string")
    mapping = parse_mapping("k:k:NONE,n:k:COUNT")
    assert rows(summarize(df, mapping)) == [("x", 1), (None, 2)] or rows(summarize(df, mapping)) == [(None, 2), ("x", 1)]
    assert summarize(df, mapping, empty_as_null=False).count() == 3


def test_global_group(spark):
    df = spark.createDataFrame([(1,), (3,)], "v int")
    mapping = parse_mapping("s:v:SUM,n:v:COUNT")
    assert rows(summarize(df, mapping)) == [(4.0, 2)]
    assert rows(summarize(df.limit(0), mapping)) == []


def test_values_with_separators_stay_whole(spark):
    df = spark.createDataFrame([("a,b:c", "x,y"), ("a,b:c", "z")], "k string, v string")
    assert rows(summarize(df, parse_mapping("k:k:NONE,hi:v:MAX"))) == [("a,b:c", "z")]


def test_post_shuffle_operations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 20), ("b", 30)], "k string, v int")
    mapping = parse_mapping("k:k:NONE,s:v:SUM")
    assert rows(summarize(df, mapping, post_shuffle_ops=[Filter("{v}", "[0-9]{2}")])) == [("a", 20.0), ("b", 30.0)]
    with pytest.raises(SpecError):
        summarize(df, mapping, post_shuffle_ops=[Reverse(["k"])])
    with pytest.raises(SpecError):
        summarize(df, mapping, post_shuffle_ops=[Compute("1", "k")])


def test_casts_in_mappings(spark):
    df = spark.createDataFrame([("1", "10"), ("1", "x"), ("01", "9")], "k string, v string")
    mapping = [FieldMap("k", "k", "NONE", cast="int"), FieldMap("hi", "v", "MAX", cast="double")]
    assert rows(summarize(df, mapping)) == [(1, 10.0)]


def test_group_by_plan_aggregates_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = summarize(df, parse_mapping("k:k:NONE,s:v:SUM,hi:v:MAX,n:v:COUNT"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_sum")


# --- keys


def test_latest_per_key_with_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), F.col("id").cast("string").alias("x"))
    out = latest_per_key(df, ["k"], ["t"])
    assert out.columns == ["k", "t", "x"]
    assert out.count() == 2001
    assert tuple(out.filter("k = 0").first()) == (0, 2997, "2997")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "q"), (None, 3, "n"), (None, 2, "m")], "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == sorted([("a", 1, "y"), ("b", None, "q"), (None, 3, "n")], key=repr)
    tagged = df.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    assert latest_per_key(tagged, ["k"], ["t"]).count() == 3


def test_key_selection_with_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, "x"), (2, "y")], "k int, s string")
    b = spark.createDataFrame([(1, None), (1, None), (2, "y")], "k int, s string")
    assert without(a, b, ["k", "s"]).count() == 2
    assert rows(without(a, b, ["k", "s"], null_safe=True)) == [(1, "x")]
    assert within(a, b, ["k", "s"], null_safe=True).count() == 2


def test_row_window(spark):
    assert [r[0] for r in row_window(spark.range(10), ["id"], 3, 4).collect()] == [4, 5, 6]


@pytest.mark.parametrize("offset, limit", [(0, 7), (120, 300), (9_990, 50), (20_000, 5), (3, 0)])
def test_deep_row_window(spark, offset, limit):
    df = spark.range(10_000).select(((F.col("id") * 7919) % 10_007).alias("a"), "id")
    expected = [tuple(r) for r in df.orderBy("a", "id").collect()][offset:offset + limit]
    assert [tuple(r) for r in row_window(df, ["a", "id"], limit, offset, deep=True).collect()] == expected
    assert [tuple(r) for r in row_window(df, ["a", "id"], limit, offset).collect()] == expected


# --- cells


LAYOUT = cells.parse_layout("[f1:ab:[a,b]]-[f2:c:[c]]")


def cell_frame(spark, data):
    return spark.createDataFrame(data, "row_key string, family string, qualifier string, ts bigint, value string")


def test_layout_errors():
    for bad in ("", "[f:c]", "[f:c:[a]]x", "[f:c:[a]]-[f:d:[a]]", "f:c:[a]"):
        with pytest.raises(SpecError):
            cells.parse_layout(bad)


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([("x", None, "1|2"), ("", "y", "")], "a string, b string, c string")
    packed = df.select(cells.pack(["a", "b", "c"], "|").alias("v"))
    assert [r[0] for r in packed.collect()] == ["x||1|2", "|y|"]
    assert rows(packed.select(*cells.unpack(F.col("v"), ["a", "b", "c"], "|"))) == [("", "y", ""), ("x", "", "1|2")]
    short = spark.createDataFrame([("only",), (None,)], "v string").select(*cells.unpack(F.col("v"), ["a", "b"], "|"))
    assert rows(short) == [("only", ""), (None, None)]


def test_cells_keep_the_latest_version(spark):
    frame = cell_frame(spark, [("r", "f1", "ab", 1, "old,1"), ("r", "f1", "ab", 2, "new,2"), ("r", "f2", "c", 1, "z"), ("s", "f2", "c", 1, "q"), ("t", "g", "g", 1, "-")])
    assert rows(cells.read_rows(frame, LAYOUT)) == [("r", "new", "2", "z"), ("s", None, None, "q")]


def test_null_row_key_is_skipped(spark):
    df = spark.createDataFrame([("1", "a", "b", "c"), (None, "a", "b", "c")], "id string, a string, b string, c string")
    out = cells.to_cells(df, cells.row_key("exec:{id}+'-k'", df), LAYOUT, F.lit(5))
    assert rows(out) == [("1-k", "f1", "ab", 5, "a,b"), ("1-k", "f2", "c", 5, "c")]


@pytest.mark.parametrize(
    "op, value, missing, expected",
    [("LESS", "b", False, "acz"), ("LESS_OR_EQUAL", "b", False, "abcz"), ("EQUAL", "b", True, "b"), ("NOT_EQUAL", "b", True, "acd"),
     ("GREATER", "b", True, "d"), ("GREATER_OR_EQUAL", "b", True, "bd"), ("NO_OP", "", True, "abcd"), ("NO_OP", "", False, "abcdz")],
)
def test_cell_filter(spark, op, value, missing, expected):
    # row c has an old value "z" and a newer one "a"; row z has no such cell
    frame = cell_frame(spark, [("a", "f", "q", 1, "a"), ("b", "f", "q", 1, "b"), ("c", "f", "q", 1, "z"), ("c", "f", "q", 2, "a"),
                               ("d", "f", "q", 1, "d"), ("z", "f", "other", 1, "b")])
    flt = [cells.CellFilter("f", "q", op, value, missing)]
    kept = {r[0] for r in cells.filter_rows(frame, flt).select("row_key").distinct().collect()}
    assert kept == set(expected)
    wide = cells.read_rows(frame, cells.parse_layout("[f:q:[q]]-[f:other:[o]]"), filters=flt)
    assert {r[0] for r in wide.collect()} == set(expected)


def test_unknown_cell_filters_are_errors():
    for bad in ("[filterType:5,family:f]", "[filterType:17,family:f]", "", "[filterType:17,family:f,qualifier:q,compareOp:LIKE,value:1]"):
        with pytest.raises(SpecError):
            cells.parse_filters(bad)


def test_scan_conditions(spark):
    frame = cell_frame(spark, [(f"r{i}", "f" if i % 2 else "g", "q", i, "v") for i in range(10)])
    assert cells.scan(frame, start_row="r2", stop_row="r5").count() == 3
    assert cells.scan(frame, min_ts=3, max_ts=6, families=["f"]).count() == 2
    assert cells.scan(frame, at_ts=4).count() == 1
    assert cells.scan(frame, columns=[("g", "q")]).count() == 5
    assert cells.scan(frame).count() == 10


def test_bulk_order_with_a_hot_row(spark):
    frame = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id"))).alias("row_key"),
        F.lit("f").alias("family"), F.lpad(F.col("id").cast("string"), 6, "0").alias("qualifier"), F.col("id").alias("ts"), F.lit("v").alias("value"))
    ranged = cells.sort_for_bulk(frame, 8)
    parts = ranged.rdd.mapPartitions(lambda it: [[(r.row_key, r.family, r.qualifier, -r.ts) for r in it]]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(flat) and len(flat) == 6000
    assert sum(1 for p in parts if any(k[0] == "hot" for k in p)) > 1


# --- hooks


def test_row_hook(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, words string")
    recode = lambda row: [{"id": row["id"], "w": w} for w in (row["words"] or "").split()]
    assert rows(hooks.flat_map_rows(df, recode, "id int, w string")) == [(1, "a"), (1, "b")]
    marked = hooks.flat_map_rows(df, recode, "id int, w string", keep_rejects=True)
    assert tuple(count_rows(marked).first()) == (4, 2, 2)


def test_hook_rows_keep_exact_values(spark):
    df = spark.sql("SELECT * FROM VALUES (9007199254740993L, 1.10BD, timestamp_ntz'2020-01-01 00:00:00', array(1, 2)), (null, null, null, null) t(n, d, t, a)")
    out = hooks.flat_map_rows(df, lambda r: [r, r], df.schema)
    assert rows(out.distinct()) == rows(df) and out.count() == 4
    assert hooks.flat_map_rows(df, lambda r: [], df.schema).count() == 0


def test_hook_life_cycle(spark, scratch):
    import os

    os.makedirs(scratch, exist_ok=True)

    def note(name):
        def write():
            with open(f"{scratch}/{name}-{os.getpid()}", "a") as f:
                f.write("x")
        return write

    df = spark.range(0, 10, 1, 1).select(F.col("id").cast("int").alias("id"))
    hooks.flat_map_rows(df, lambda r: [r], "id int", configure=note("start"), close=note("end")).count()
    names = [n.split("-")[0] for n in os.listdir(scratch)]
    assert "start" in names and "end" in names


def test_line_hook(spark):
    df = spark.createDataFrame([("a",), ("drop",), ("b",)], "value string")
    out = hooks.map_lines(df, lambda v: None if v == "drop" else v + "1\n" + v + "2")
    assert [r[0] for r in out.collect()] == ["a1", "a2", "b1", "b2"] or sorted(r[0] for r in out.collect()) == ["a1", "a2", "b1", "b2"]


def test_file_name_prefix(spark):
    df = spark.createDataFrame([("x", "file:///d/20150417_a.txt")], "value string, _file_path string")
    assert hooks.prefix_with_file_name(df).first()["value"] == "20150417,x"


def test_unknown_filter_rule(spark):
    with pytest.raises(SpecError):
        apply_ops(spark.range(1), [], combine="any")
    with pytest.raises(SpecError):
        rowops.SourcePath("x").apply(spark.range(1))


def test_gapless_numbers_in_order(spark):
    from millrace.operators.project import number_rows

    rows = [(i * 7 % 50, "abc"[i % 3], None if i % 11 == 0 else i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, s string, v int").repartition(5)
    one = sorted((r["_number"], r["k"], r["s"], r["v"]) for r in number_rows(df, ["k", "s"]).collect())
    two = sorted((r["_number"], r["k"], r["s"], r["v"]) for r in number_rows(df.repartition(3), ["k", "s"]).collect())
    assert one == two and [r[0] for r in one] == list(range(1, 501))
    assert [(r[1], r[2]) for r in one] == sorted((r[0], r[1]) for r in rows)
    assert number_rows(df.limit(0), ["k"]).count() == 0
