"""Text, sequence and table round trips through the file sources and sinks."""

import io
import tarfile
import uuid
import zipfile
from functools import reduce

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.functions.text import file_name
from millrace.operators.hooks import prefix_with_file_name
from millrace.operators.rowops import FileNamePart, SourcePath
from millrace.session import collect_small, scratch_path, write_bytes
from millrace.sinks.fanout import fan_out
from millrace.sinks.tables import ensure_table, insert_into, replace_file_rows, run_statements, write_partitioned
from millrace.sinks.text import publish_path, write_delimited, write_sequence
from millrace.sources.archives import read_mixed_lines
from millrace.sources.files import manifest, paths_from_query
from millrace.sources.hadoop import read_query, read_sequence
from millrace.sources.text import parse_fields, read_delimited, read_lines, read_plain

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql

ORDERS = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
 o_orderdate timestamp_ntz, o_orderpriority string"""


@_R.add("SELECT * FROM orders")
def text_multi_char_separator(spark, d):
    path = scratch_path(spark, "text") + "/orders"
    write_delimited(table(spark, d, "orders"), path, sep="^;", line_sep="|\n")
    return read_delimited(spark, path, ORDERS, sep=r"\^;", regex=True, line_sep="|\n")


@_R.add("SELECT * FROM orders")
def text_plain_reader(spark, d):
    path = scratch_path(spark, "text") + "/orders"
    write_delimited(table(spark, d, "orders"), path, sep="|")
    return read_plain(spark, path, ORDERS, sep="|")


@_R.add("SELECT * FROM orders")
def text_skip_head_line(spark, d):
    path = scratch_path(spark, "text") + "/orders"
    write_delimited(table(spark, d, "orders"), path, column_line=True)
    return read_delimited(spark, path, ORDERS, skip_lines=1)


@_R.add("SELECT o_orderkey, o_orderpriority FROM orders")
def text_three_head_lines(spark, d):
    """Heads of three lines, found wherever a file's splits cut them."""
    path = scratch_path(spark, "text") + "/orders"
    o = table(spark, d, "orders").select(F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("line")).repartition(3)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    o.select(F.when(first, F.concat(F.lit("made by\na test\n"), F.lit("key,priority\n"), "line")).otherwise(F.col("line"))).write.text(path)
    return read_delimited(spark, path, "o_orderkey bigint, o_orderpriority string", skip_lines=3, skip_in="any split")


def _nation_lines(spark, d):
    """The few rows of a lookup table as text lines; the files made of them are read back by the engine."""
    rows = collect_small(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey"), 1000, "nations")
    return [f"{r[0]}^{r[1]}-\u4e2d\u56fd^{r[2]}" for r in rows]


_NATIONS = "SELECT n_nationkey, n_name || '-中国' AS n_name, n_regionkey FROM nation"
_NATION_FIELDS = "n_nationkey int, n_name string, n_regionkey int"


@_R.add(_NATIONS)
def text_gbk(spark, d):
    path = scratch_path(spark, "text") + "/nation.txt"
    write_bytes(spark, path, "\n".join(_nation_lines(spark, d)).encode("gbk"))
    return read_delimited(spark, path, _NATION_FIELDS, sep="^", charset="gbk").select(*_typed(spark, d))


@_R.add(_NATIONS)
def archive_members(spark, d):
    """Members of a zip, a tar.gz and a plain file of one folder as one set of lines, each with a head line."""
    path, lines = scratch_path(spark, "packed"), _nation_lines(spark, d)
    parts = [("head\n" + "\n".join(lines[i::4])).encode() for i in range(4)]
    packed, tarred = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", parts[0])
        z.writestr("folder/b.txt", parts[1])
    with tarfile.open(fileobj=tarred, mode="w:gz") as t:
        member = tarfile.TarInfo("c.txt")
        member.size = len(parts[2])
        t.addfile(member, io.BytesIO(parts[2]))
    for name, data in (("1.zip", packed.getvalue()), ("2.tar.gz", tarred.getvalue()), ("3.txt", parts[3])):
        write_bytes(spark, f"{path}/{name}", data)
    return parse_fields(read_mixed_lines(spark, path, skip_lines=1), _NATION_FIELDS, "^").select(*_typed(spark, d))


def _typed(spark, d):
    """Columns in the types of the table."""
    kinds = {f.name: f.dataType for f in table(spark, d, "nation").schema}
    return [F.col(c).cast(kinds[c]).alias(c) for c in ("n_nationkey", "n_name", "n_regionkey")]


@_R.add("SELECT conv_id, turn, replace(text, chr(10), ' ') AS text FROM conversations")
def text_charset(spark, d):
    # written in Latin-1 through the CSV writer; a separator that occurs in no text
    path = scratch_path(spark, "text") + "/latin"
    c = table(spark, d, "conversations")
    line = c.select(F.concat_ws("\x01", "conv_id", "turn", F.replace("text", F.lit("\n"), F.lit(" "))).alias("value"))
    line.write.options(encoding="ISO-8859-1", quote="", escape="", sep="\x02", ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(path)
    return read_delimited(spark, path, "conv_id bigint, turn bigint, text string", sep="\x01", charset="ISO-8859-1")


@_R.add("SELECT * FROM orders")
def text_codecs(spark, d):
    path = scratch_path(spark, "codecs")
    o = table(spark, d, "orders")
    for i, codec in enumerate(["gzip", "bzip2", "org.apache.hadoop.io.compress.DefaultCodec", "none"]):
        write_delimited(o.where(F.col("o_orderkey") % 4 == i), f"{path}/{i}", compression=codec)
    return read_delimited(spark, path, ORDERS, recursive=True)


@_R.add("SELECT * FROM customer")
def sequence_file(spark, d):
    path = scratch_path(spark, "seq") + "/customer"
    write_sequence(table(spark, d, "customer"), path, sep="\t", compression="gzip")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_sequence(spark, path, schema, sep="\t")


@_R.add("SELECT l_shipdate, round(sum(l_extendedprice * l_discount), 4) AS revenue FROM lineitem WHERE l_quantity < 24 GROUP BY l_shipdate")
def catalog_query(spark, d):
    view = f"lineitem_{uuid.uuid4().hex}"
    table(spark, d, "lineitem").createOrReplaceTempView(view)
    return read_query(
        spark,
        f"SELECT l_shipdate, round(sum(l_extendedprice * l_discount), 4) AS revenue FROM {view} "
        "WHERE l_quantity < 24 GROUP BY l_shipdate",
    )


@_R.add("SELECT o_orderkey, o_orderpriority FROM orders")
def files_by_name(spark, d):
    # files matched by a pattern and files not matched are the whole folder
    path = scratch_path(spark, "names") + "/orders"
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    write_delimited(o, path, max_rows_per_file=2000)
    picked = dict(fields="o_orderkey bigint, o_orderpriority string", name_regex=r"part-.*-c\d*[02468]\.txt")
    inside = read_delimited(spark, path, **picked)
    outside = read_delimited(spark, path, **picked, name_regex_include=False)
    return inside.unionByName(outside)


@_R.add("SELECT o_orderkey, o_orderpriority FROM orders")
def files_by_list(spark, d):
    path = scratch_path(spark, "names") + "/orders"
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    write_delimited(o, path, max_rows_per_file=2000)
    names = sorted(paths_from_query(spark, manifest(spark, path, r"part-.*").select("name")))
    fields = "o_orderkey bigint, o_orderpriority string"
    halves = [read_delimited(spark, path, fields, names=part) for part in (names[:2], names[2:])]
    return halves[0].unionByName(halves[1])


@_R.add("SELECT * FROM orders")
def files_from_query(spark, d):
    path = scratch_path(spark, "listed") + "/orders"
    write_delimited(table(spark, d, "orders"), path)
    return read_delimited(spark, paths_from_query(spark, manifest(spark, path, r"part-.*").select("path")), ORDERS)


@_R.add("SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus AS folder, 'part' AS by_split, 'part-' AS by_index, 'PART' AS by_regex FROM orders")
def provenance_fields(spark, d):
    path = scratch_path(spark, "prov") + "/orders"
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    write_delimited(o, path, partition_by=["o_orderstatus"])
    df = parse_fields(
        read_lines(spark, path, provenance=True), ["o_orderkey", "by_split", "by_index", "by_regex"]
    ).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))
    df = SourcePath("folder").apply(df)
    df = FileNamePart("by_split", "split", 0, pattern="-").apply(df)
    df = FileNamePart("by_index", "index", 0, 5).apply(df)
    df = FileNamePart("by_regex", "regex", pattern="^part-.*", replacement="PART").apply(df)
    return df.withColumn("folder", F.element_at(F.split("folder", "/"), -2)).drop("_file_path")


@_R.add("SELECT o_orderkey + 1 AS next_key, 'part-000' AS prefix FROM orders")
def line_prefixed_by_file(spark, d):
    path = scratch_path(spark, "prefix") + "/orders"
    write_delimited(table(spark, d, "orders").select("o_orderkey"), path)
    lines = prefix_with_file_name(read_lines(spark, path, provenance=True))
    df = parse_fields(lines, "prefix string, o_orderkey bigint")
    return df.select((F.col("o_orderkey") + 1).alias("next_key"), "prefix")


@_R.add("SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder FROM orders")
def file_manifest(spark, d):
    path = scratch_path(spark, "manifest") + "/orders"
    write_partitioned(table(spark, d, "orders"), path, ["o_orderstatus"])
    files = manifest(spark, path, r".*\.parquet").filter("size > 0")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct()


@_R.add("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def partitioned_output(spark, d):
    path = scratch_path(spark, "years") + "/orders"
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    write_partitioned(o, path, ["order_year"])
    # a second write of some years replaces exactly those
    write_partitioned(o.where("order_year >= 1999"), path, ["order_year"], replace_partitions=True)
    return spark.read.schema(o.schema).parquet(path)


@_R.add("SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS files_too_large FROM lineitem")
def rolled_files(spark, d):
    path = scratch_path(spark, "rolled") + "/lines"
    write_delimited(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), path, max_rows_per_file=1000)
    per_file = read_lines(spark, path, provenance=True).groupBy("_file_path").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum("n").alias("row_count"), F.sum((F.col("n") > 1000).cast("bigint")).alias("files_too_large")
    )


@_R.add("SELECT p_partkey, p_name, 'r1' AS batch FROM part WHERE p_size < 20 UNION ALL SELECT p_partkey, p_name, 'r2' FROM part WHERE p_size >= 20")
def published_batches(spark, d):
    target = scratch_path(spark, "publish")
    p = table(spark, d, "part")
    for run, cond in (("r1", "p_size < 20"), ("r2", "p_size >= 20")):
        p.where(cond).select("p_partkey", "p_name").write.parquet(publish_path(target, run))
    return spark.read.schema("p_partkey bigint, p_name string, batch string").parquet(target)


@_R.add("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def catalog_table_sink(spark, d):
    name, place = f"orders_{uuid.uuid4().hex}", scratch_path(spark, "catalog") + "/t"
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    ensure_table(spark, name, o, location=place, partition_by=["o_orderstatus"])
    ensure_table(spark, name, o)
    run_statements(spark, [("DROP TABLE no_such_table_here", True), f"REFRESH TABLE {name}"])
    insert_into(o, name)
    insert_into(o.where("o_orderstatus <> 'P'"), name, replace_partitions=True)
    run_statements(spark, f"ALTER TABLE {name} DROP IF EXISTS PARTITION (o_orderstatus = 'P')")
    return spark.table(name).select(*o.columns)


@_R.add("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, 'f' || o_orderkey % 3 AS file_id FROM orders")
def reprocessed_files(spark, d):
    path = scratch_path(spark, "byfile") + "/rows"
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.concat(F.lit("f"), F.col("o_orderkey") % 3).alias("file_id")
    )
    twice = o.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for rows in (twice.where("file_id <> 'f2'"), o.where("file_id = 'f2'"), twice.where("file_id = 'f2'")):
        kept = replace_file_rows(rows, path)
    return kept.read()


@_R.add("""
SELECT t AS target, CASE t WHEN 'broken' THEN false ELSE true END AS ok, CASE t WHEN 'broken' THEN 0 ELSE n END AS row_count
FROM (SELECT count(*) AS n FROM part), (VALUES ('parquet'), ('broken'), ('text')) v(t)""")
def fan_out_targets(spark, d):
    root = scratch_path(spark, "fan")

    def broken(_df):
        raise OSError("target is away")

    p = table(spark, d, "part")
    status = fan_out(
        p,
        {
            "parquet": lambda df: df.write.parquet(root + "/parquet"),
            "broken": broken,
            "text": lambda df: write_delimited(df, root + "/text", compression="gzip"),
        },
    )
    counts = {
        "parquet": spark.read.parquet(root + "/parquet").agg(F.count(F.lit(1)).alias("n")),
        "text": read_lines(spark, root + "/text").agg(F.count(F.lit(1)).alias("n")),
    }
    rows = [
        (counts[s.target] if s.ok else spark.range(1).select(F.lit(0).cast("bigint").alias("n"))).select(
            F.lit(s.target).alias("target"), F.lit(s.ok).alias("ok"), F.col("n").alias("row_count")
        )
        for s in status
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


@_R.add("SELECT event_id, user_id, 's' || event_id % 3 AS _shard FROM events")
def append_shards(spark, d):
    root = scratch_path(spark, "append")
    e = table(spark, d, "events").select("event_id", "user_id")
    for i in range(3):
        e.where(F.col("event_id") % 3 == i).write.parquet(f"{root}/s{i}")
    shards = [spark.read.parquet(f"{root}/s{i}").withColumn("_shard", F.lit(f"s{i}")) for i in range(3)]
    return reduce(lambda a, b: a.unionByName(b), shards)


@_R.add("SELECT count(*) AS row_count, count(*) AS named_rows FROM customer")
def file_names_of_rows(spark, d):
    path = scratch_path(spark, "names") + "/customer"
    write_delimited(table(spark, d, "customer"), path)
    named = read_lines(spark, path, provenance=True).withColumn("name", file_name(F.col("_file_path")))
    return named.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("name").like("part-%").cast("bigint")).alias("named_rows"))
