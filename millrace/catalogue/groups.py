"""Group-by jobs."""

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.operators.aggregate import summarize
from millrace.operators.rowops import Filter
from millrace.plans.job import build, run
from millrace.plans.properties import job_from_properties
from millrace.plans.spec import FieldMap, JobSpec, parse_mapping
from millrace.session import scratch_path
from millrace.sinks.tables import write_partitioned
from millrace.sinks.text import write_delimited
from millrace.sources.text import read_delimited

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql

FLAGSHIP = (
    "sid:l_returnflag:NONE,sprice:l_extendedprice:MIN,mprice:l_extendedprice:MAX,"
    "avgnumber:l_quantity:AVG,sumnumber:l_quantity:SUM,rowcounts:l_returnflag:COUNT"
)


@_R.add("""
SELECT l_returnflag AS sid, min(l_extendedprice) AS sprice, max(l_extendedprice) AS mprice,
       round(avg(l_quantity), 6) AS avgnumber, round(sum(l_quantity), 2) AS sumnumber, count(*) AS rowcounts
FROM lineitem GROUP BY l_returnflag""")
def flagship_group_by(spark, d):
    out = build(spark, JobSpec(source=table(spark, d, "lineitem"), mapping=FLAGSHIP))
    return out.withColumns({"avgnumber": F.round("avgnumber", 6), "sumnumber": F.round("sumnumber", 2)})


@_R.add("""
SELECT l_returnflag AS flag, l_linestatus AS status, round(sum(l_extendedprice), 2) AS total,
       round(avg(l_discount), 6) AS mean, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def group_two_keys(spark, d):
    mapping = parse_mapping(
        "flag:l_returnflag:NONE,status:l_linestatus:NONE,total:l_extendedprice:SUM,mean:l_discount:AVG,"
        "first_ship:l_shipdate:MIN,last_ship:l_shipdate:MAX,n:l_orderkey:COUNT"
    )
    out = summarize(table(spark, d, "lineitem"), mapping)
    return out.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6)})


@_R.add("""
SELECT l_orderkey AS okey, round(sum(l_extendedprice), 2) AS total, max(l_quantity) AS most, count(*) AS n
FROM lineitem GROUP BY 1""")
def group_many_keys(spark, d):
    mapping = parse_mapping("okey:l_orderkey:NONE,total:l_extendedprice:SUM,most:l_quantity:MAX,n:l_orderkey:COUNT")
    return summarize(table(spark, d, "lineitem"), mapping).withColumn("total", F.round("total", 2))


# a third of the measures are null and some are no numbers
_MESSY = """SELECT o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN
 CAST(o_custkey AS VARCHAR) ELSE 'n/a' END AS measure FROM orders"""


def _messy(spark, d):
    k = F.col("o_orderkey") % 3
    measure = F.when(k == 1, F.col("o_custkey").cast("string")).when(k == 2, F.lit("n/a"))
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", measure.alias("measure"))


@_R.add(f"""
SELECT o_orderstatus AS status, sum(coalesce(TRY_CAST(measure AS DOUBLE), 0)) AS total,
       round(sum(coalesce(TRY_CAST(measure AS DOUBLE), 0)) / count(*), 6) AS mean, count(*) AS n
FROM ({_MESSY}) GROUP BY 1""")
def group_nulls_as_zero(spark, d):
    mapping = parse_mapping("status:o_orderstatus:NONE,total:measure:SUM,mean:measure:AVG,n:measure:COUNT")
    return summarize(_messy(spark, d), mapping).withColumn("mean", F.round("mean", 6))


@_R.add(f"""
SELECT o_orderstatus AS status, sum(TRY_CAST(measure AS DOUBLE)) AS total,
       round(avg(TRY_CAST(measure AS DOUBLE)), 6) AS mean, count(*) AS n
FROM ({_MESSY}) GROUP BY 1""")
def group_sql_null_rule(spark, d):
    mapping = parse_mapping("status:o_orderstatus:NONE,total:measure:SUM,mean:measure:AVG,n:measure:COUNT")
    return summarize(_messy(spark, d), mapping, nulls_as_zero=False).withColumn("mean", F.round("mean", 6))


@_R.add("""
SELECT p_brand AS brand, CAST(min(p_size) AS VARCHAR) AS smallest, CAST(max(p_size) AS VARCHAR) AS largest,
       min(p_name) AS first_name, max(p_name) AS last_name
FROM part GROUP BY 1""")
def group_text_extremes(spark, d):
    p = table(spark, d, "part").withColumn("size_text", F.col("p_size").cast("string"))
    mapping = parse_mapping(
        "brand:p_brand:NONE,smallest:size_text:MIN,largest:size_text:MAX,first_name:p_name:MIN,last_name:p_name:MAX"
    )
    return summarize(p, mapping)


@_R.add("""
SELECT round(sum(l_extendedprice), 2) AS total, min(l_quantity) AS least, max(l_quantity) AS most, count(*) AS n
FROM lineitem""")
def global_aggregate(spark, d):
    mapping = parse_mapping("total:l_extendedprice:SUM,least:l_quantity:MIN,most:l_quantity:MAX,n:l_orderkey:COUNT")
    return summarize(table(spark, d, "lineitem"), mapping).withColumn("total", F.round("total", 2))


@_R.add("""
SELECT l_linestatus AS status, count(*) AS n, round(sum(l_extendedprice), 2) AS total
FROM lineitem WHERE l_linenumber IN (1, 2, 3) GROUP BY 1""")
def post_shuffle_filter(spark, d):
    mapping = parse_mapping("status:l_linestatus:NONE,n:l_linestatus:COUNT,total:l_extendedprice:SUM")
    out = summarize(table(spark, d, "lineitem"), mapping, post_shuffle_ops=[Filter("{l_linenumber}", "[1-3]")])
    return out.withColumn("total", F.round("total", 2))


@_R.add("""
SELECT nullif(CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderpriority END, '') AS priority,
       count(*) AS n FROM orders GROUP BY 1""")
def group_empty_and_null_keys(spark, d):
    k = F.col("o_orderkey") % 4
    o = table(spark, d, "orders").withColumn(
        "o_orderpriority", F.when(k == 0, F.lit("")).when(k != 1, F.col("o_orderpriority"))
    )
    return summarize(o, parse_mapping("priority:o_orderpriority:NONE,n:o_orderkey:COUNT"))


@_R.add("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus AS status, round(sum(o_totalprice), 2) AS total, count(*) AS n
FROM orders GROUP BY 1, 2""")
def group_then_partition(spark, d):
    o = table(spark, d, "orders").withColumn("order_year", F.year("o_orderdate"))
    mapping = parse_mapping("order_year:order_year:NONE,status:o_orderstatus:NONE,total:o_totalprice:SUM,n:o_orderkey:COUNT")
    out = summarize(o, mapping)
    path = scratch_path(spark, "years") + "/rows"
    write_partitioned(out, path, ["order_year"])
    return spark.read.schema(out.schema).parquet(path).withColumn("total", F.round("total", 2))


@_R.add("""
SELECT c_nationkey AS nation, coalesce(nullif(min(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END), ''),
       min(CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END), 'none') AS segment, count(*) AS n
FROM customer GROUP BY 1""")
def group_defaults(spark, d):
    c = table(spark, d, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).otherwise(F.lit(""))
    )
    mapping = parse_mapping("nation:c_nationkey:NONE,segment:c_mktsegment:MIN,n:c_custkey:COUNT")
    return summarize(c, mapping, defaults={"segment": "none"})


@_R.add("""
SELECT l_suppkey AS supplier, min(TRY_CAST(l_quantity AS BIGINT)) AS least, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1""")
def job_group_with_ops(spark, d):
    spec = JobSpec(
        source=table(spark, d, "lineitem"),
        ops="filter:{l_linestatus}:F,digit:{l_extendedprice}*(1-{l_discount})={revenue}",
        mapping=[
            FieldMap("supplier", "l_suppkey", "NONE"),
            FieldMap("least", "l_quantity", "MIN", cast="bigint"),
            FieldMap("revenue", "revenue", "SUM"),
        ],
    )
    return build(spark, spec).withColumn("revenue", F.round("revenue", 4))


@_R.add("""
SELECT o_orderstatus AS sid, count(*) AS rowcounts, min(o_totalprice) AS sprice, max(o_totalprice) AS mprice,
       round(avg(o_totalprice), 4) AS avgprice, 'none' AS note
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1""")
def job_from_flat_properties(spark, d):
    root = scratch_path(spark, "flat")
    write_delimited(table(spark, d, "orders"), root + "/in", sep="^")
    spec = job_from_properties(
        {
            "input.sys.mr.mapred.type": "FILETEXT",
            "mapreduce.input.fileinputformat.inputdir": root + "/in",
            "input.mr.mapred.file.field.split.chars": r"\^",
            "input.sys.mr.mapred.field.names": "key,customer,status,price,time,priority",
            "input.sys.mr.mapred.map.senior.conf": "filter:{priority}:5.*",
            "input.sys.mr.mapred.map.filter.flag": "false",
            "output.sys.mr.mapred.type": "FILETEXT",
            "mapreduce.output.fileoutputformat.outputdir": root + "/out",
            "output.mr.mapred.file.field.split.chars": "|",
            "output.sys.mr.mapred.field.names": "sid,sprice,mprice,avgprice,rowcounts,note",
            "output.sys.mr.mapred.group.field.method.rel":
                "sid:status:NONE,sprice:price:MIN,mprice:price:MAX,avgprice:price:AVG,rowcounts:key:COUNT",
        }
    )
    run(spark, spec)
    out = read_delimited(
        spark, root + "/out", "sid string, sprice double, mprice double, avgprice double, rowcounts bigint, note string", "|"
    )
    return out.withColumns({"avgprice": F.round("avgprice", 4), "note": F.coalesce("note", F.lit("none"))})
