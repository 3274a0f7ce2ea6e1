import datetime as dt
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import numbers, rules, slots, text
from millrace.sources import ranges


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'timestamp_ntz' if isinstance(v, dt.datetime) else 'bigint' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for n, v in values.items())
    df = spark.createDataFrame([tuple(values.values())], schema) if names else spark.range(1)
    return df.select(column(df) if callable(column) else column).first()[0]


@pytest.mark.parametrize(
    "rule, a, b, expected",
    [
        ("({a}+1)/2-5+{b}*3+{b}%2", "2.00", "5", 12.5),
        ("({a}+1)/2-5+{b}*3+{b}%2", "2", "5", 12.0),
        ("{a}/{b}", "7", "2", 3.0),
        ("{a}/{b}", "-7", "2", -3.0),
        ("{a}/{b}", "7", "0", None),
        ("{a}%{b}", "7", "0", None),
        ("{a}/{b}", "7.0", "0.0", None),
        ("{a}*{b}", "x", "2", None),
        ("{a}*{b}", None, "2", None),
        ("-{a}+{b}", "3", "1", -2.0),
        ("{a} > {b} && !({a} == 3)", "4", "2", True),
        ("{a} > {b} || {a} == 3", "1", "2", False),
        ("math.abs({a})+{b}", "-3", "1", 4.0),
    ],
)
def test_rule_on_text(spark, rule, a, b, expected):
    assert one(spark, lambda df: rules.compute(rule, df.schema), a=a, b=b) == expected


def test_rule_on_typed_columns(spark):
    assert one(spark, lambda df: rules.compute("{a}/{b}", df.schema), a=7, b=2) == 3
    assert one(spark, lambda df: rules.compute("{a}/{b}", df.schema), a=7.0, b=2) == 3.5
    assert one(spark, lambda df: rules.compute("{a}*{b}", df.schema), a=2**62, b=4) is None
    assert one(spark, lambda df: rules.compute("{a}/{b}", df.schema), a=-(2**63), b=-1) is None


def test_execute_keeps_text(spark):
    run = lambda rule, **v: one(spark, lambda df: rules.execute(rule, df.schema), **v)
    assert run("exec:{a}+'-'+{b}", a="1", b="2") == "1-2"
    assert run("exec:a+1", a=4) == "5"
    assert run("exec:string.substring({a}, 1, 3)+str(string.length({a}))", a="hello") == "el5"
    assert run("exec:string.contains({a}, 'ell')", a="hello") == "true"
    assert run("exec:{a}+'x'", a=None) is None


@pytest.mark.parametrize("rule", ["{a} ? 1 : 2", "{a} > 1 ? 2", "{a} > 1 ? 'x' : 2", "{zz}+1", "foo({a})", "{a}[0]", "1 +", "{a} ** 2"])
def test_rule_outside_the_language_is_an_error(spark, rule):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(rules.RuleError):
        rules.compute(rule, df.schema)


@pytest.mark.parametrize(
    "t, sid, stime, expected",
    [
        ("tj-{sid}-{stime, yyyy-MM-dd}", "1000", "2012-12-27 10:00:00", "tj-1000-2012-12-27"),
        ("{sid}/{other}", "7", "", "7/{other}"),
        ("{sid}", None, "", "{sid}"),
        ("{stime,yyyy-MM-dd HH}", "", "2012-1-7 9:30:00", "2012-01-07 09"),
        ("{stime,yyyy-MM-dd}", "", " ", ""),
        ("{stime,yyyy-MM-dd}", "", "2012-13-45", ""),
        ("{stime,yyyy-MM-dd}", "", None, "{stime,yyyy-MM-dd}"),
        ("{stime,yyyy}", "", "2012-12-27", ""),
        ("{stime,yyyy-MM-dd HH:mm:ss}", "", "2012-12-27", ""),
        ("plain", "", "", "plain"),
    ],
)
def test_template(spark, t, sid, stime, expected):
    assert one(spark, lambda df: text.template(t, df.schema), sid=sid, stime=stime) == expected


def test_template_on_timestamp(spark):
    at = dt.datetime(2012, 12, 27, 10, 5)
    assert one(spark, lambda df: text.template("{t,yyyy-MM-dd HH:mm}", df.schema), t=at) == "2012-12-27 10:05"


@pytest.mark.parametrize(
    "value, expected",
    [("20150417", "2015-04-17 00:00:00"), ("20150417023005", "2015-04-17 02:30:05"), ("2015", None), ("201504", None),
     ("2015041702300512", None), ("2015-04-17", None), ("", None), (None, None)],
)
def test_expand_timestamp(spark, value, expected):
    assert one(spark, text.expand_timestamp(F.col("v")), v=value) == expected


def test_text_helpers(spark):
    run = lambda c, v: one(spark, c(F.col("v")), v=v)
    assert run(text.iso_datetime, "2015-04-17T02:00:00+08:00") == "2015-04-17 02:00:00"
    assert run(text.iso_datetime, "no date") is None
    assert run(lambda c: text.bracketed(c, "{", "}"), "{ab}") == "ab"
    assert run(lambda c: text.bracketed(c, "{", "}"), "ab}") is None
    assert run(lambda c: text.bracketed(c, "|", "|"), "|") is None
    assert run(text.pairs_to_map, "a:1,b:2,x,a:3,c:1:2") == {"b": "2", "a": "3"}
    assert run(lambda c: text.pad_left(c, 4, "0"), "12") == "0012"
    assert run(lambda c: text.pad_left(c, 2, "0"), "12345") == "12345"
    assert run(lambda c: text.pad_right(c, 3, "."), None) == "..."
    assert run(text.file_name, "/a/b.txt") == "b.txt"
    assert run(text.file_name, "b.txt") == ""
    assert run(text.file_name, " ") is None
    assert run(text.parent_path, "/a/b/c.txt") == "/a/b"
    assert run(text.parent_path, "/a") == "/"
    assert [run(text.compression_of, x) for x in ("a.TAR.GZ", "a.tar", "a.gz", "a", None)] == ["TARGZ", "TAR", "GZ", "NONE", "NONE"]
    assert run(lambda c: text.count_char(c, "a"), "banana") == 3
    assert run(lambda c: text.replace_once(c, "an", "AN"), "banana") == "bANana"
    assert run(lambda c: text.replace_chars(c, "ban", "B"), "banana") == "B"
    assert run(lambda c: text.full_match(c, "a|b"), "a\n") is False
    assert run(lambda c: text.from_millis(c), "0") == "1970-01-01 00:00:00"
    assert run(lambda c: text.to_millis(c), "1970-01-01 00:00:01") == 1000
    assert run(lambda c: text.to_millis(c), "x") is None
    assert run(lambda c: text.renamed(c, "s_$0_$1_$2_{SF_NAME}", r"\d+"), "/x/a12b34.txt") == "s_12_34_$2_a12b34.txt"


def test_numbers(spark):
    run = lambda c, v: one(spark, c(F.col("v")), v=v)
    assert [run(lambda c: numbers.decimal_text(c, "0.00"), x) for x in (0.125, 0.375, 2.0, -1.005)] == ["0.12", "0.38", "2.00", "-1.00"]
    assert run(lambda c: numbers.decimal_text(c, "#,##0.0"), 1234567.25) == "1,234,567.2"
    assert [run(numbers.lenient_double, x) for x in ("1.5", " 2 ", "x", "", None)] == [1.5, 2.0, 0.0, 0.0, 0.0]
    assert [run(lambda c: numbers.lenient_int(c, 9), x) for x in ("3", "3.5", "99999999999", None)] == [3, 9, 9, 9]
    with pytest.raises(ValueError):
        numbers.decimal_text(F.lit(1), "0.000")


def hash_slot(key: str, start: int, end: int) -> int:
    """Plain rendering of the definition, on UTF-16 units."""
    units = key.encode("utf-16-le")
    units = [units[i] | units[i + 1] << 8 for i in range(0, len(units), 2)]
    lo = start if start >= 0 else max(len(units) + start, 0)
    hi = min(end if end > 0 else len(units) + end, len(units))
    h = 0
    for u in units[lo:max(hi, lo)]:
        h = (31 * h + u) & 0xFFFFFFFFFFFFFFFF
    return h & 1023


_PLANE0 = st.characters(min_codepoint=1, max_codepoint=0xFFFF, blacklist_categories=("Cs",))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.text(_PLANE0, max_size=70), min_size=1, max_size=40))
def test_string_slot(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    slices = {"0:8": (0, 8), ":": (0, 0), "2:5": (2, 5), "-3:": (-3, 0), ":-2": (0, -2), "-6:-2": (-6, -2), "3:60": (3, 60)}
    cols = [slots.string_slot(F.col("k"), s).alias(f"c{i}") for i, s in enumerate(slices)]
    for row in df.select("k", *cols).collect():
        for i, (start, end) in enumerate(slices.values()):
            assert row[f"c{i}"] == hash_slot(row["k"], start, end), (row["k"], start, end)


def test_slots_and_segments(spark):
    assert slots.segments([2, 1], [256, 512]) == [256, 512, 1024]
    assert [slots.parse_slice(s) for s in ("2", "1:2", "1:", "-1:", ":-1", ":", "-3")] == [
        (0, 2), (1, 2), (1, 0), (-1, 0), (0, -1), (0, 0), (-3, 0)]
    with pytest.raises(ValueError):
        slots.segments([3], [256])
    rows = spark.createDataFrame([(None,), (0,), (255,), (256,), (1023,), (1024,), (-1,)], "k bigint").select(
        slots.shard_of(slots.int_slot(F.col("k")), [2, 1], [256, 512])).collect()
    assert [r[0] for r in rows] == [0, 0, 0, 1, 2, 0, 2]


def test_whole_key_slot_uses_utf16_units(spark):
    key = "a\U0001F600b"
    assert one(spark, slots.string_slot(F.col("k"), ":"), k=key) == hash_slot(key, 0, 0)


def test_words_that_are_no_numbers(spark):
    run = lambda v: one(spark, numbers.number(F.col("v")), v=v)
    assert [run(v) for v in ("inf", "nan", "infinity", "-INF", "x", "")] == [None] * 6
    assert run("Infinity") == float("inf") and run("1e999") == float("inf") and run(" 1.5 ") == 1.5
    assert run("NaN") != run("NaN")


def test_conditional_match_and_nil_rules(spark):
    run = lambda rule, **v: one(spark, lambda df: rules.compute(rule, df.schema), **v)
    assert run("{a} > 1 ? 10 : 20", a=2) == 10
    assert run("{a} > 5 ? 1 : {a} > 1 ? 2 : 3", a=2) == 2
    assert run("({a} > 5 ? 1 : 2) + ({a} < 5 ? 10 : 20)", a=2) == 12
    assert run("{a} =~ /[a-z]+\\d/ ? 'yes' : 'no: ?'", a="ab1") == "yes"
    assert run("{a} =~ /b/", a="abc") is False
    assert run("{a} == nil ? 0 : {a}", a=None, b=1) == 0
    assert run("string.replace_all({a}, 'b+', '-')", a="abbbc") == "a-c"
    assert run("date_to_string({a}, 'yyyy/MM')", a="2024-03-05 01:02:03") == "2024/03"
    assert run("math.abs({a})/2", a=-7) == 3
    assert run("math.abs({a})/2", a="-7") == 3.0
    assert run("math.abs({a})", a=-2.5) == 2.5


@pytest.mark.parametrize("key", ["", "abc", "k\U0001F600ey" + "x" * 40, "é" * 33, "\U0001F600" * 20, "wé\U0001F600" * 50_000])
def test_one_slot_rule_for_every_slice(spark, key):
    units = key.encode("utf-16-be")
    units = [units[i] * 256 + units[i + 1] for i in range(0, len(units), 2)]
    for text in ("0:32", "0:33", ":", "8", "-3", "2:-1", ":-1", "1:4"):
        lo, hi = slots.parse_slice(text)
        part = units[lo if lo >= 0 else max(len(units) + lo, 0):min(hi, len(units)) if hi > 0 else max(len(units) + hi, 0)]
        h = 0
        for u in part:
            h = (31 * h + u) & 1023
        assert one(spark, lambda df, t=text: slots.string_slot(F.col("a"), t), a=key) == h, text


def test_bind_leaves_values_and_quotes_alone():
    assert ranges.bind("a = {NAME}", {"NAME": "what?"}) == "a = 'what?'"
    assert ranges.bind("a = '{NAME}' and b = '?' and c = ?", {"NAME": "it's {X}?", "X": 5}) == "a = 'it''s {X}?' and b = '?' and c = 'it''s {X}?'"
    assert ranges.bind("a like 'x{P}%' and n = {N}", {"P": "o'y", "N": 3}) == "a like 'xo''y%' and n = 3"
    with pytest.raises(ValueError):
        ranges.bind("? ?", {"a": 1})


def test_statements_split_outside_quotes():
    from millrace.sinks.tables import split_statements

    assert [x.strip() for x in split_statements("a ';' b; c \";\" ; `d;`")] == ["a ';' b", 'c ";"', "`d;`"]


def test_slot_time_is_linear_in_the_text(spark):
    """Open and narrow slices of long texts: twice the length takes at most about twice the time."""
    def seconds(length: int, part: str) -> float:
        df = spark.range(40).select(F.repeat(F.lit("aé\U0001F600z"), length // 4).alias("k"))
        taken = []
        for _ in range(3):
            start = time.perf_counter()
            df.select(F.sum(slots.string_slot(F.col("k"), part))).collect()
            taken.append(time.perf_counter() - start)
        return min(taken)

    for part in (":", "0:8", "-8:"):
        assert seconds(200_000, part) < 3 * max(seconds(100_000, part), 0.2), part


def test_wide_slots_hold_one_text_at_a_time():
    import tracemalloc

    import pyarrow as pa

    keys = pa.array(["\U0001F600" + "x" * 20_000] * 500)
    tracemalloc.start()
    try:
        found = slots._wide(0, 0).func(keys)
        assert tracemalloc.get_traced_memory()[1] < 5 << 20
    finally:
        tracemalloc.stop()
    assert len(set(found.to_pylist())) == 1
