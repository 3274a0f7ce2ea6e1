"""Tables that change by key, and reads that skip files, against brute force."""

import random
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators.cells import region_of
from millrace.plans.spec import SpecError
from millrace.sinks import cells as sink
from millrace.sinks.keyed import KeyedTable, TableChanged
from millrace.sources.file_index import FileIndex


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def many_files(spark, n=4000, files=8):
    """Keys 0 to n - 1 in ranges, a file each."""
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartitionByRange(files, "k")


def kept(spark, scratch, n=4000):
    """A table with several base files of separate key ranges."""
    t = KeyedTable(spark, scratch + "/t", ["k"])
    t.create(spark.createDataFrame([], "k bigint, v string"))
    for i in range(4):
        t.append(spark.range(n // 4 * i, n // 4 * (i + 1)).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).coalesce(1))
    return t


def names(t):
    return {r["file"] for r in t.files().collect()}


def test_untouched_files_keep_their_names(spark, scratch):
    t = kept(spark, scratch)
    before = names(t)
    t.delete(spark.range(0, 40).select(F.col("id").alias("k")))  # 1 % of the keys, in one file
    assert names(t) == before and t.read().count() == 3960
    assert {r["deleted"] for r in t.files().collect()} == {0, 40}
    t.compact(share=0.02)
    after = names(t)
    assert len(before - after) == 1 and len(after - before) == 1 and t.read().count() == 3960
    assert t.compact() and names(t) == after
    assert t.read(version=5).count() == 4000
    assert t.vacuum() == 2 and t.read().count() == 3960  # the rewritten file and the empty first one


def test_reads_move_only_touched_files(spark, scratch):
    t = kept(spark, scratch)
    assert "Exchange" not in t.read()._jdf.queryExecution().executedPlan().toString()
    t.delete(spark.createDataFrame([(5,)], "k bigint"))
    assert len(t.read().inputFiles()) == 5  # four base files and one with places
    assert t.read(columns=["v"]).columns == ["v"]


def test_random_changes(spark, scratch):
    draw = random.Random(5)
    rows = [(draw.choice([None, *range(30)]), draw.choice(["a", None, "b"]), i) for i in range(300)]
    schema = "k int, c string, n int"
    t = KeyedTable(spark, scratch + "/t", ["k", "c"]).create(spark.createDataFrame(rows, schema).repartition(3))
    for step in range(5):
        keys = {(draw.choice([None, *range(30)]), draw.choice(["a", None, "b"])) for _ in range(8)}
        rows = [r for r in rows if r[:2] not in keys]
        if step % 2:
            t.delete(spark.createDataFrame([(*k, 0) for k in keys] * 2, schema))
        else:
            fresh = [(*k, 1000 + step) for k in keys for _ in range(2)]
            rows += fresh
            t.replace(spark.createDataFrame(fresh, schema))
        assert rows_of(t.read()) == Counter(rows)
        told = t.files().agg(F.sum(F.col("rows") - F.col("deleted"))).first()[0]
        assert told == len(rows)
        if step == 3:
            t.compact(share=0.1)
            t.vacuum()
            assert rows_of(t.read()) == Counter(rows)


def test_empty_tables_and_changes(spark, scratch):
    t = KeyedTable(spark, scratch + "/t", ["k"]).create(spark.createDataFrame([], "k bigint, v string"))
    assert t.read().collect() == [] and t.read().columns == ["k", "v"]
    t.delete(spark.createDataFrame([(1,)], "k bigint"))
    t.replace(spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, v string"))
    t.delete(spark.createDataFrame([], "k bigint"))
    assert rows_of(t.read()) == Counter([(1, "a"), (None, "b")])
    t.delete(spark.createDataFrame([(None,)], "k bigint"))
    assert rows_of(t.read()) == Counter([(1, "a")])
    with pytest.raises(SpecError):
        KeyedTable(spark, scratch + "/u", ["x"]).create(t.read())
    with pytest.raises(TableChanged):
        t.create(t.read())


def test_a_broken_change_counts_for_nothing(spark, scratch):
    t = kept(spark, scratch)
    with pytest.raises(Exception):
        t.replace(spark.range(3).select(F.col("id").alias("k"), F.raise_error(F.lit("broken")).alias("v")))
    assert t.read().count() == 4000
    with pytest.raises(TableChanged):
        t.delete(spark.range(10).select(F.col("id").alias("k")))
    t.release()
    t.delete(spark.range(10).select(F.col("id").alias("k")))
    assert t.read().count() == 3990


def test_point_reads_open_one_file(spark, scratch):
    many_files(spark).write.parquet(scratch + "/d")
    index = FileIndex(spark, scratch + "/d", "k")
    assert index.update() == 8 and index.update() == 0
    for key in (0, 1234, 3999):
        assert len(index.candidates([key])) == 1
        assert index.open(index.candidates([key])).where(F.col("k") == key).count() == 1
    assert index.candidates([-1]) == [] and index.candidates([]) == [] and len(index.candidates()) == 8
    assert len(index.candidates(low=0, high=10)) == 1 and len(index.candidates(low=3990)) == 1


def test_bloom_filter_of_mixed_files(spark, scratch):
    """Every file spans all keys, so only the Bloom filters tell; none loses a key, few let absent ones pass."""
    spark.range(40_000).select((F.col("id") * 2).alias("k")).repartition(8).write.parquet(scratch + "/d")
    index = FileIndex(spark, scratch + "/d", "k")
    index.update()
    there, absent = list(range(0, 80_000, 1601 * 2)), list(range(1, 80_000, 2001 * 2))
    held = index._table("files")
    found = index._holding(held, there)
    names = {r[0] for r in found.collect()}
    rows = index.open(sorted(names)).where(F.col("k").isin(*there)).count()
    assert rows == len(there)
    assert all(1 <= len(index.candidates([k])) <= 2 for k in there[:4])
    assert sum(len(index.candidates([k])) for k in absent[:4]) <= 1


def test_files_of_others_are_read(spark, scratch):
    many_files(spark).write.parquet(scratch + "/d")
    index = FileIndex(spark, scratch + "/d", "k")
    index.update()
    spark.createDataFrame([(7, "new")], "k bigint, v string").coalesce(1).write.mode("append").parquet(scratch + "/d")
    assert rows_of(index.open(index.candidates([7])).where("k = 7")) == Counter([(7, "v7"), (7, "new")])
    assert spark.read.parquet(scratch + "/d").count() == 4001


def test_regions_by_binary_search(spark):
    draw = random.Random(1)
    keys = ["", "a", "é", "😀", "zz", *("".join(draw.choices("abcé", k=3)) for _ in range(80))]
    for n in (0, 1, 2, 3, 7, 8, 50):
        splits = ["".join(draw.choices("abcdé", k=2)) for _ in range(n)]
        points = sorted(s.encode() for s in set(splits))
        got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", region_of(F.col("k"), splits).alias("r")).collect()
        assert all(r["r"] == bisect_right(points, r["k"].encode()) for r in got)


def test_regions_have_files_of_their_own(spark, scratch):
    cells = spark.range(3000).select(
        F.format_string("r%05d", "id").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.timestamp_seconds("id").alias("ts"), F.lit("v").alias("value"),
    )
    sink.write_bulk(cells, scratch + "/b", partitions=6, splits=["r00100", "r02900"])
    told = spark.read.parquet(scratch + "/b/_index/files").collect()
    by = sorted((r["file"].split("/")[0], r["low"], r["high"], r["rows"]) for r in told)
    assert all(a[2] < b[1] for a, b in zip(by, by[1:]))  # sorted by region, ranges don't overlap
    sizes = Counter()
    for region, *_, n in by:
        sizes[region] += n
    assert sizes == {"region=0": 100, "region=1": 2800, "region=2": 100}
    assert len([r for r in by if r[0] == "region=1"]) > 1  # the range with most cells is cut below
    one = sink.read_bulk(spark, scratch + "/b", row_keys=["r01234"], regions=True)
    assert len(one.inputFiles()) == 1 and one.count() == 1
    none = sink.read_bulk(spark, scratch + "/b", row_keys=["x"], regions=True)
    assert none.count() == 0 and none.columns == ["row_key", "family", "qualifier", "ts", "value"]
    late = sink.read_bulk(spark, scratch + "/b", min_ts=F.timestamp_seconds(F.lit(2990)), regions=True)
    assert late.count() == 10 and len(late.inputFiles()) == 1


def test_names_of_files_are_cut_without_a_pattern(spark, scratch):
    from millrace.sources.file_index import relative_name

    spark.range(3).coalesce(1).write.parquet(scratch + "/a b/c")
    named = spark.read.parquet(scratch + "/a b/c").select(F.col("_metadata.file_path").alias("path"), *[relative_name(n).alias(f"n{n}") for n in (0, 1, 2)])
    for r in named.collect():
        parts = r["path"].split("/")
        assert [r["n0"], r["n1"], r["n2"]] == ["/".join(parts[-n:]) for n in (1, 2, 3)]
    assert "regexp" not in named._jdf.queryExecution().toString()
