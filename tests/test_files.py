import gzip
import io
import os
import tarfile
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.plans.spec import SpecError
from millrace.session import collect_small, open_writers, scratch_path
from millrace.sinks.fanout import fan_out, with_target_name
from millrace.sinks.shards import NULL_KEY, Sharding, file_values, reject_null_keys, shard_counts, write_shard_files
from millrace.sinks.tables import ensure_table, insert_into, replace_by_key, run_statements, write_partitioned
from millrace.sinks.text import publish_path, write_delimited, write_sequence
from millrace.sources.archives import read_archive_lines, read_mixed_lines
from millrace.sources.files import manifest, paths_from_query
from millrace.sources.hadoop import read_rc, read_sequence
from millrace.sources.text import parse_fields, read_delimited, read_lines, read_plain


def put(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return f"{folder}/{name}"


def values(df):
    return [tuple(r) for r in df.collect()]


# --- text source


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a^b;c", ("a", "b", "c")),
        ("a^b", ("a", "b", None)),
        ("a^b^^;", ("a", "b", None)),
        ("^b^c", ("", "b", "c")),
        ("a^b^c^d", ("a", "b", "c")),
        ("^;^", (None, None, None)),
        (" x ^é,:$", (" x ", "é,:$", None)),
    ],
)
def test_regex_separator(spark, line, expected):
    df = spark.createDataFrame([(line,)], "value string")
    assert values(parse_fields(df, ["x", "y", "z"], r"[\^;]", regex=True)) == [expected]


def test_plain_separator_and_blank_lines(spark):
    df = spark.createDataFrame([("a|b",), ("",), (" \t ",), ("|",), ("a||",)], "value string")
    assert values(parse_fields(df, ["x", "y"], "|")) == [("a", "b"), (None, None), ("a", None)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sep=st.sampled_from([",", "||", "aa", "^;", "\\d", ".", "|#|"]),
    lines=st.lists(st.text("a|#^;,.d1 ", max_size=14), min_size=1, max_size=60),
)
def test_fields_by_left_to_right_split(spark, sep, lines):
    def fields(line):
        parts = line.split(sep)
        while parts and parts[-1] == "":
            parts.pop()
        return tuple((parts + [None] * 4)[:4])

    df = spark.createDataFrame([(v,) for v in lines], "value string")
    assert values(parse_fields(df, list("wxyz"), sep)) == [fields(v) for v in lines if v.strip()]


def test_typed_fields(spark):
    df = spark.createDataFrame([("1,x,2020-01-01 00:00:00",), ("z,y,never",)], "value string")
    out = values(parse_fields(df, "n int, s string, t timestamp_ntz"))
    assert out[0][:2] == (1, "x") and out[1] == (None, "y", None)


def test_long_record_separator_and_last_record(spark, scratch):
    path = put(scratch + "/d", "a.txt", "1^one\nstill|#\n2^two|#\n3^three")
    assert values(read_delimited(spark, path, ["id", "text"], "^", line_sep="|#\n")) == [
        ("1", "one\nstill"), ("2", "two"), ("3", "three")]


@pytest.mark.parametrize("limit", [None, 200])
def test_head_lines_of_every_file(spark, scratch, limit):
    for i in range(3):
        put(scratch + "/d", f"f{i}.txt", "h1\nh2\nh3\n" + "".join(f"{i}-{n}\n" for n in range(200)))
    put(scratch + "/d", "short.txt", "h1\nh2\n")
    if limit:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(limit))
    try:
        df = read_lines(spark, scratch + "/d", skip_lines=3)
        assert df.rdd.getNumPartitions() > (9 if limit else 0)
        got = sorted(r[0] for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(f"{i}-{n}" for i in range(3) for n in range(200))


def test_head_lines_beyond_the_first_split_are_an_error(spark, scratch):
    put(scratch + "/d", "f.txt", "".join(f"line {n}\n" for n in range(100)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        with pytest.raises(Exception, match="do not fit"):
            read_lines(spark, scratch + "/d", skip_lines=50).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("charset", ["gbk", "ISO-8859-1", "gb18030", "cp1252", "utf-8"])
def test_charsets(spark, scratch, charset):
    text = "é,ü" if charset in ("ISO-8859-1", "cp1252") else "数据,转换"
    put(scratch + "/d", "a.txt", "h\n".encode(charset) + (text + "\n").encode(charset) * 3)
    out = read_delimited(spark, scratch + "/d", ["a", "b"], charset=charset, skip_lines=1)
    assert values(out) == [tuple(text.split(","))] * 3


def test_wide_charsets_and_unknown_ones_are_errors(spark, scratch):
    with pytest.raises(ValueError):
        read_lines(spark, scratch, charset="utf-16")
    put(scratch + "/d", "a.txt", "x\n")
    with pytest.raises(LookupError):
        read_lines(spark, scratch + "/d", charset="no-such-charset")


def test_names_hidden_files_and_recursion(spark, scratch):
    for name in ("a1.txt", "a2.txt", "b1.txt", "_hidden.txt", ".dot.txt"):
        put(scratch + "/d", name, name + "\n")
    put(scratch + "/d/sub", "a3.txt", "a3.txt\n")
    read = lambda **o: sorted(r[0] for r in read_lines(spark, scratch + "/d", **o).collect())
    assert read(recursive=True) == ["a1.txt", "a2.txt", "a3.txt", "b1.txt"]
    assert read(recursive=True, name_regex=r"a\d\.txt") == ["a1.txt", "a2.txt", "a3.txt"]
    assert read(recursive=True, name_regex=r"a\d", name_regex_include=True) == []
    assert read(recursive=True, name_regex=r"a\d\.txt", name_regex_include=False) == ["b1.txt"]
    assert read(names=["b1.txt", "zz"]) == ["b1.txt"]
    assert read(names=[]) == []
    assert read(name_glob="b*") == ["b1.txt"]


def test_name_filter_prunes_files(spark, scratch):
    for i in range(4):
        put(scratch + "/d", f"f{i}.txt", "x\n" * 10)
    df = read_lines(spark, scratch + "/d", name_regex=r"f[01]\.txt")
    assert df.count() == 20
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_metadata" in plan or "file_name" in plan


def test_plain_reader(spark, scratch):
    put(scratch + "/d", "a.txt", 'h,h\n1,"q\n2,\n')
    assert values(read_plain(spark, scratch + "/d", "n int, s string", header=True)) == [(1, '"q'), (2, None)]


# --- archives


def test_archives(spark, scratch):
    folder = scratch + "/d"
    os.makedirs(folder)
    with zipfile.ZipFile(folder + "/a.zip", "w") as z:
        z.writestr("m1.txt", "1,a\n2,b")
        z.writestr("dir/m2.txt", "3,c\r\n")
    for name, mode in (("b.tar", "w"), ("c.tar.gz", "w:gz"), ("d.tgz", "w:gz")):
        with tarfile.open(f"{folder}/{name}", mode) as t:
            for member, data in (("x", b"4,d\n"), ("y", "5,数".encode("gbk"))):
                info = tarfile.TarInfo(member)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    df = read_archive_lines(spark, folder, charset="gbk")
    got = sorted((r._file_path.split("/")[-1], r._member, r._line, r.value) for r in df.collect())
    tar = lambda n: [(n, "x", 1, "4,d"), (n, "y", 1, "5,数")]
    assert got == [("a.zip", "dir/m2.txt", 1, "3,c"), ("a.zip", "m1.txt", 1, "1,a"), ("a.zip", "m1.txt", 2, "2,b"),
                   *tar("b.tar"), *tar("c.tar.gz"), *tar("d.tgz")]


def test_large_member_comes_in_batches(spark, scratch):
    os.makedirs(scratch + "/d")
    with zipfile.ZipFile(scratch + "/d/a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m", "".join(f"{i}\n" for i in range(25_001)))
    df = read_archive_lines(spark, scratch + "/d")
    assert df.agg(F.count("*"), F.max("_line"), F.sum(F.col("value").cast("bigint"))).first()[0:3] == (25_001, 25_001, 25_000 * 25_001 // 2)


def test_archives_beside_plain_files(spark, scratch):
    folder = scratch + "/d"
    put(folder, "a.txt", "h\n1\n")
    put(folder, "b.gz", gzip.compress(b"h\n2\n"))
    os.makedirs(folder + "/sub")
    with zipfile.ZipFile(folder + "/sub/c.ZIP", "w") as z:
        z.writestr("m", "h\n3\n")
        z.writestr("n", "h\n4\n")
    out = read_mixed_lines(spark, folder, skip_lines=1, provenance=True)
    assert sorted(r.value for r in out.collect()) == ["1", "2", "3", "4"]
    assert sorted(r[0] for r in read_mixed_lines(spark, folder, name_regex=".*ZIP").collect()) == ["3", "4", "h", "h"]
    assert read_archive_lines(spark, folder, names=["a.txt"]).count() == 0


def test_gzip_by_suffix(spark, scratch):
    put(scratch + "/d", "a.gz", gzip.compress(b"x\ny\n"))
    assert sorted(values(read_lines(spark, scratch + "/d"))) == [("x",), ("y",)]


# --- text sinks


def test_null_is_empty_and_separators(spark, scratch):
    df = spark.createDataFrame([("a", None, 1), (None, "b", None)], "x string, y string, n int").coalesce(1)
    write_delimited(df, scratch + "/o", sep="^;", line_sep="|\n", fields=["n", "x", "y"])
    data = "".join(open(f"{scratch}/o/{n}").read() for n in os.listdir(scratch + "/o") if n.startswith("part"))
    assert data == "1^;a^;|\n^;^;b|\n"
    with pytest.raises(ValueError):
        write_delimited(df, scratch + "/p", line_sep="|")


def test_column_line_in_every_file(spark, scratch):
    write_delimited(spark.range(0, 40, 1, 4), scratch + "/o", column_line=True)
    files = [open(f"{scratch}/o/{n}").read().splitlines() for n in os.listdir(scratch + "/o") if n.startswith("part")]
    assert len(files) == 4 and all(f[0] == "COLUMN_NAMES:id" and len(f) == 11 for f in files)
    assert read_lines(spark, scratch + "/o", skip_lines=1).count() == 40


@pytest.mark.parametrize("codec, suffix", [("gzip", ".gz"), ("bzip2", ".bz2"), ("default", ".deflate"), ("snappy", ".snappy")])
def test_codecs(spark, scratch, codec, suffix):
    write_delimited(spark.range(100), scratch + "/o", compression=codec)
    assert any(n.endswith(suffix) for n in os.listdir(scratch + "/o"))
    assert read_delimited(spark, scratch + "/o", "id bigint").agg(F.sum("id")).first()[0] == 4950
    with pytest.raises(ValueError):
        write_delimited(spark.range(1), scratch + "/p", compression="lzma")


def test_row_limit_of_files(spark, scratch):
    write_delimited(spark.range(0, 95, 1, 1), scratch + "/o", max_rows_per_file=10)
    assert sum(n.startswith("part") for n in os.listdir(scratch + "/o")) == 10
    write_delimited(spark.range(5), scratch + "/p", max_rows_per_file=-1)
    with pytest.raises(ValueError):
        write_delimited(spark.range(5), scratch + "/q", max_rows_per_file=0)


def test_rolled_files_have_no_checksum_files(spark, scratch):
    write_delimited(spark.range(0, 95, 1, 1), scratch + "/o", max_rows_per_file=10)
    assert not [n for n in os.listdir(scratch + "/o") if n.endswith(".crc")]
    assert read_delimited(spark, scratch + "/o", "id bigint").agg(F.sum("id")).first()[0] == sum(range(95))


@pytest.mark.parametrize("compression, block", [(None, True), ("gzip", True), ("default", False)])
def test_sequence_files(spark, scratch, compression, block):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    write_sequence(df, scratch + "/o", sep="|", compression=compression, block=block)
    assert sorted(values(read_sequence(spark, scratch + "/o", "n int, s string", sep="|"))) == [(1, "a"), (2, None)]


def test_rc_files_need_hive(spark):
    with pytest.raises(RuntimeError):
        read_rc(spark, "t")


def test_publish_path():
    assert publish_path("/t/", "r1") == "/t/batch=r1"


# --- tables


def test_partitions_of_a_hot_value_are_split(spark, scratch):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("p"),
        F.sha2(F.col("id").cast("string"), 512).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        write_partitioned(df, scratch + "/o", ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: sum(n.endswith(".parquet") for n in os.listdir(f"{scratch}/o/{d}")) for d in os.listdir(scratch + "/o") if d.startswith("p=")}
    assert files["p=hot"] > 1
    assert spark.read.parquet(scratch + "/o").count() == 60_000
    with pytest.raises(SpecError):
        write_partitioned(df, scratch + "/q", ["absent"])


def test_catalog_table(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    name = "t_" + os.path.basename(scratch).replace("-", "_")
    ensure_table(spark, name, df, location=scratch + "/t")
    insert_into(df.select("s", "n"), name)
    assert sorted(values(spark.table(name))) == [(1, "a"), (2, "b")]
    ensure_table(spark, name, df, truncate=True)
    assert spark.table(name).count() == 0
    with pytest.raises(SpecError):
        insert_into(df.select("n"), name)
    assert len(run_statements(spark, [("DROP TABLE absent_table", True)])) == 1
    with pytest.raises(Exception):
        run_statements(spark, "DROP TABLE absent_table")
    run_statements(spark, f"DROP TABLE {name};")


def test_replace_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "z")], "k int, v string")
    assert sorted(values(replace_by_key(old, new, ["k"]))) == [(1, "z"), (2, "c")]


# --- shards and several outputs


def test_null_keys_are_rejected_everywhere(spark, scratch):
    df = spark.createDataFrame([(1, 2.5, "a"), (None, 1.0, "b"), (512, 0.5, None)], "k bigint, d double, s string")
    sharding = Sharding("k", "int", [2], [512])
    marked = reject_null_keys(df, sharding)
    assert [r["_reject_reason"] for r in marked.filter("not _valid").collect()] == [NULL_KEY]
    write_shard_files(df, sharding, scratch + "/o", names={0: "alpha", 1: "beta"})
    assert read_lines(spark, scratch + "/o/_shard=alpha").collect()[0][0] == "1,2.5,a"
    assert read_lines(spark, scratch + "/o/_shard=beta").collect()[0][0] == "512,.5,"
    assert [(r.s, r["_reject_reason"]) for r in spark.read.parquet(scratch + "/o_rejected").collect()] == [("b", NULL_KEY)]


def test_shard_counts_sum_to_the_input(spark):
    df = spark.range(5000).select(F.concat(F.lit("key"), "id").alias("k"))
    counts = shard_counts(df, Sharding("k", "string", [4], [256], ":"))
    assert counts.agg(F.sum("row_count")).first()[0] == 5000


def test_each_shard_goes_to_its_own_database(spark, scratch, monkeypatch):
    """The write itself is replaced by a file write: no database is started."""
    from millrace.sinks import shards
    from millrace.sources.jdbc import Database

    monkeypatch.setattr(shards, "write_table", lambda df, db, table: df.write.parquet(f"{scratch}/{db.url}/{table}"))
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    counts = shards.write_shard_tables(df, Sharding("k", "int", [2], [512]), [Database("a"), Database("b")], "t")
    assert sum(counts.values()) == 2700
    for i, name in enumerate("ab"):
        back = spark.read.parquet(f"{scratch}/{name}/t")
        assert back.columns == ["k", "v"] and back.count() == counts[i]
        assert back.filter((F.col("k").bitwiseAND(F.lit(1023)) >= 512) != F.lit(bool(i))).count() == 0
    with pytest.raises(ValueError):
        shards.write_shard_tables(df, Sharding("k", "int", [2], [512]), [Database("a")], "t")


def test_file_values(spark):
    row = spark.sql("SELECT 1.25D a, 2D b, 0.1234567D c, timestamp_ntz'2020-01-02 03:04:05' t, 7 n")
    assert tuple(row.select(*file_values(row)).first()) == ("1.25", "2.0", ".123457", "2020-01-02 03:04:05", "7")


def test_fan_out_goes_on_after_a_failure(spark, scratch):
    def bad(_):
        raise OSError("gone")

    status = fan_out(spark.range(10), {"bad": bad, "good": lambda d: d.write.parquet(scratch + "/g")})
    assert [(s.target, s.ok) for s in status] == [("bad", False), ("good", True)]
    assert "gone" in status[0].error and spark.read.parquet(scratch + "/g").count() == 10


# --- manifests


def test_manifest(spark, scratch):
    put(scratch + "/d", "a1.dat", "xxx")
    put(scratch + "/d/other", "a2.dat", "x")
    put(scratch + "/d", "b.txt", "x")
    assert sorted(r.name for r in manifest(spark, scratch + "/d").collect()) == ["a1.dat", "a2.dat", "b.txt"]
    own = manifest(spark, scratch + "/d", r"a\d\.dat", exclude_roots=[scratch + "/d/other"])
    assert [(r.name, r["size"]) for r in own.collect()] == [("a1.dat", 3)]
    named = with_target_name(own, "{SF_NAME}.bak").first()
    assert named["target_name"] == "a1.dat.bak"
    assert paths_from_query(spark, own.select("name")) == ["a1.dat"]


def test_control_lists_are_bounded(spark):
    assert len(collect_small(spark.range(5), 5, "list")) == 5
    with pytest.raises(ValueError):
        collect_small(spark.range(6), 5, "list")


# --- session helpers


def test_open_writers_restores_the_setting(spark):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with open_writers(spark, 7):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "7"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_heads_that_span_splits(spark, scratch):
    """Small splits cut the head lines; each file loses exactly its own, whatever splits they lie in."""
    os.makedirs(scratch + "/in")
    for name, n in (("a", 5), ("b", 200), ("c", 2), ("d", 0)):
        with open(f"{scratch}/in/{name}.txt", "w") as f:
            f.write("".join(f"{name} head {i} {'x' * 300}\n" for i in range(min(n, 40))) + "".join(f"{name}{i}\n" for i in range(max(n - 40, 0))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        got = sorted(r[0] for r in read_lines(spark, scratch + "/in", skip_lines=40, skip_in="any split").collect())
        assert got == sorted(f"b{i}" for i in range(160))
        kept = read_lines(spark, scratch + "/in", skip_lines=3, skip_in="any split", provenance=True)
        assert kept.count() == 2 + 197 and kept.where("_file_path like '%/a.txt'").count() == 2
        with pytest.raises(Exception, match="any split"):
            read_lines(spark, scratch + "/in", skip_lines=40).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError):
        read_lines(spark, scratch + "/in", skip_lines=1, skip_in="elsewhere")
