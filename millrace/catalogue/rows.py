"""Row operations, projections, filters and rejects."""

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.functions import rules
from millrace.functions.text import template
from millrace.operators import hooks
from millrace.operators.project import apply_column_functions, apply_defaults, numbered_key, project, unique_key
from millrace.operators.rejects import count_rows, read_split, write_split
from millrace.operators.rowops import (
    Compute, Custom, Filter, ReplaceValue, Reverse, apply_ops, parse_ops, valid_rows,
)
from millrace.plans.job import build, row_hook, run
from millrace.plans.spec import FieldMap, JobSpec, parse_mapping
from millrace.session import scratch_path
from millrace.sources.text import parse_fields

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql


@_R.add("SELECT l_orderkey AS sid, l_extendedprice AS sprice, l_quantity AS snumber, l_returnflag AS smessage FROM lineitem")
def project_rename(spark, d):
    mapping = parse_mapping("sid:l_orderkey,sprice:l_extendedprice,snumber:l_quantity,smessage:l_returnflag")
    return project(table(spark, d, "lineitem"), mapping)


@_R.add("SELECT DISTINCT l_returnflag AS flag, l_linestatus AS status FROM lineitem WHERE false UNION ALL SELECT l_returnflag, l_linestatus FROM lineitem")
def project_all_none_keeps_rows(spark, d):
    return project(table(spark, d, "lineitem"), parse_mapping("flag:l_returnflag:NONE,status:l_linestatus:NONE"))


@_R.add("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE props END AS label FROM events""")
def project_last_nonempty(spark, d):
    e = table(spark, d, "events").withColumn("props", F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("props")))
    return project(e, parse_mapping("event_id:event_id,label:event_type,label:props"))


@_R.add("""
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'unrated') AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def default_values(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    text = joined.select("doc_id", F.col("quality").cast("string").alias("quality"), "toxic")
    return apply_defaults(text, {"quality": "unrated", "toxic": "-1"})


@_R.add("""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
       (l_partkey + 1) // 2 - 5 + l_suppkey * 3 + l_suppkey % 2 AS code,
       l_quantity > 30 AND NOT (l_linenumber = 3) AS big
FROM lineitem""")
def expression_columns(spark, d):
    ops = [
        Compute("{l_extendedprice}*(1-{l_discount})*(1+{l_tax})", "charge"),
        Compute("({l_partkey}+1)/2-5+{l_suppkey}*3+{l_suppkey}%2", "code"),
        Compute("{l_quantity} > 30 && !({l_linenumber} == 3)", "big"),
    ]
    done = valid_rows(apply_ops(table(spark, d, "lineitem"), ops))
    return done.select("l_orderkey", "l_linenumber", "charge", "code", "big")


@_R.add("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_custkey AS BIGINT) // 4 AS DOUBLE)
       ELSE o_totalprice / 4 END AS quarter
FROM orders""")
def expression_on_text(spark, d):
    o = table(spark, d, "orders").withColumn(
        "amount",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.col("o_totalprice").cast("string")),
    )
    return o.select("o_orderkey", rules.compute("{amount}/4", o.schema).alias("quarter"))


@_R.add("SELECT p_partkey, p_brand || '/' || p_type AS label, CAST(p_size * 2 + 1 AS VARCHAR) AS code FROM part")
def exec_template(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        rules.execute("exec:{p_brand}+'/'+{p_type}", p.schema).alias("label"),
        rules.execute("exec:p_size*2+1", p.schema).alias("code"),
    )


@_R.add("""
SELECT o_orderkey, 'tj-' || o_orderkey || '-' || strftime(o_orderdate, '%Y-%m-%d') AS row_key,
       strftime(o_orderdate, '%Y-%m-%d %H') || '{unknown}' || o_orderstatus AS other
FROM orders""")
def string_template(spark, d):
    o = table(spark, d, "orders")
    text = o.withColumn("date_text", F.col("o_orderdate").cast("string"))
    return text.select(
        "o_orderkey",
        template("tj-{o_orderkey}-{date_text, yyyy-MM-dd}", text.schema).alias("row_key"),
        template("{o_orderdate,yyyy-MM-dd HH}{unknown}{o_orderstatus}", text.schema).alias("other"),
    )


@_R.add("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'done' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def value_map(spark, d):
    op = ReplaceValue("o_orderstatus", {"F": "O", "O": "done"})
    return op.apply(table(spark, d, "orders")).select("o_orderkey", "o_orderstatus")


@_R.add("SELECT c_custkey, reverse(c_name) AS c_name, reverse(c_mktsegment) AS c_mktsegment FROM customer")
def reverse_fields(spark, d):
    return Reverse(["c_name", "c_mktsegment"]).apply(table(spark, d, "customer")).select("c_custkey", "c_name", "c_mktsegment")


@_R.add("SELECT count(*) AS rows_in, count(*) AS distinct_keys FROM lineitem")
def unique_row_keys(spark, d):
    keyed = table(spark, d, "lineitem").select(unique_key(F.col("l_orderkey").cast("string")).alias("k"))
    # two plain counts in one pass over distinct keys: no single-task distinct set
    per_key = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("distinct_keys"))


@_R.add("""
SELECT l_orderkey, l_linenumber, 'k-' || l_returnflag || '_' ||
  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS row_key FROM lineitem""")
def numbered_row_keys(spark, d):
    """Gapless numbers in a global order, the same in every run."""
    li = table(spark, d, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag")
    keyed = numbered_key(li, F.concat(F.lit("k-"), "l_returnflag"), ["l_shipdate", "l_orderkey", "l_linenumber"])
    return keyed.select("l_orderkey", "l_linenumber", "row_key")


@_R.add("""
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE l_returnflag END AS l_returnflag,
       l_quantity * 2 AS twice, reverse(l_linestatus) AS l_linestatus
FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag <> 'R'""")
def rowop_chain(spark, d):
    ops = parse_ops(
        "digit:{l_quantity}*2={twice},conreplace:{l_returnflag}:{A}-{1}:{N}-{2},filter:{l_linestatus}:O,"
        "filter:{l_returnflag}:[0-9]+,reverse:{l_linestatus}"
    )
    done = valid_rows(apply_ops(table(spark, d, "lineitem"), ops))
    return done.select("l_orderkey", "l_linenumber", "l_returnflag", "twice", "l_linestatus")


@_R.add("SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey FROM nation UNION ALL SELECT s_suppkey, upper(s_name), s_nationkey FROM supplier")
def column_functions(spark, d):
    n = table(spark, d, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("bigint"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey").toDF(*n.columns)
    return apply_column_functions(n.union(s), {"n_name": "upper"})


@_R.add("SELECT * FROM customer WHERE regexp_full_match(c_mktsegment || '-' || c_nationkey, '[A-M].*-1[0-9]')")
def regex_filter(spark, d):
    return valid_rows(apply_ops(table(spark, d, "customer"), [Filter("{c_mktsegment}-{c_nationkey}", "[A-M].*-1[0-9]")]))


@_R.add("SELECT * FROM customer WHERE NOT regexp_full_match(c_mktsegment, 'B.*|M.*')")
def regex_filter_negated(spark, d):
    return valid_rows(apply_ops(table(spark, d, "customer"), [Filter("{c_mktsegment}", "B.*|M.*", keep=False)]))


@_R.add("SELECT * FROM customer WHERE regexp_full_match(c_mktsegment, '[F-M].*')")
def filter_last_rule_wins(spark, d):
    ops = [Filter("{c_mktsegment}", "[A-C].*"), Filter("{c_mktsegment}", "[F-M].*")]
    return valid_rows(apply_ops(table(spark, d, "customer"), ops, combine="last"))


@_R.add("""
SELECT p_partkey, p_name, regexp_full_match(p_name, '.*o.*') AND p_size > 9 AS accepted,
       CASE WHEN NOT regexp_full_match(p_name, '.*o.*') THEN 'filter {p_name}:.*o.*'
            WHEN NOT p_size > 9 THEN 'filter {p_size}:[0-9]{2,}' ELSE '' END AS reason
FROM part""")
def reject_split(spark, d):
    marked = apply_ops(table(spark, d, "part"), [Filter("{p_name}", ".*o.*"), Filter("{p_size}", "[0-9]{2,}")])
    out = scratch_path(spark, "rejects") + "/rows"
    write_split(marked, out)
    good, bad = read_split(spark, out, marked.schema)
    good = good.withColumn("accepted", F.lit(True)).withColumn("reason", F.lit(""))
    bad = bad.withColumn("accepted", F.lit(False)).withColumnRenamed("_reject_reason", "reason")
    return good.unionByName(bad).select("p_partkey", "p_name", "accepted", "reason")


@_R.add("""
SELECT count(*) AS input_rows, count(*) FILTER (l_returnflag = 'R') AS valid_rows,
       count(*) FILTER (l_returnflag <> 'R') AS rejected_rows FROM lineitem""")
def validate_only_counts(spark, d):
    return count_rows(apply_ops(table(spark, d, "lineitem"), [Filter("{l_returnflag}", "R")]))


@_R.add("""
SELECT count(*) FILTER (length(text) < 200) AS rejected_rows, count(*) FILTER (length(text) >= 200) AS output_rows
FROM conversations""")
def hook_rejects(spark, d):
    def recode(row):
        return [row] if len(row["text"]) >= 200 else []

    c = table(spark, d, "conversations")
    marked = row_hook(recode, c.schema)(c)
    counts = count_rows(marked)
    return counts.select("rejected_rows", F.col("valid_rows").alias("output_rows"))


@_R.add("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'A'")
def pushed_condition(spark, d):
    return table(spark, d, "lineitem").where("l_quantity > 30 AND l_returnflag = 'A'").select("l_orderkey", "l_quantity")


@_R.add("""
SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations""")
def hook_rows(spark, d):
    def recode(row):
        return [{**row, "line": part} for part in row["text"].split("\n")]

    c = table(spark, d, "conversations")
    return hooks.flat_map_rows(c, recode, "conv_id bigint, turn bigint, line string", partitions=spark.sparkContext.defaultParallelism)


@_R.add("""
SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents WHERE lang <> 'en'""")
def hook_lines(spark, d):
    docs = table(spark, d, "documents")
    lines = docs.select("doc_id", F.concat_ws("|", "lang", "text").alias("value"))

    def line(text):
        return None if text.startswith("en|") else text[text.index("|") + 1:]

    return hooks.map_lines(lines, line, partitions=spark.sparkContext.defaultParallelism)


@_R.add("""
SELECT lower(s_name) AS name, s_acctbal AS balance, s_acctbal * 2 AS doubled FROM supplier WHERE s_nationkey > 4""")
def job_projection(spark, d):
    spec = JobSpec(
        source=table(spark, d, "supplier"),
        ops=[Compute("{s_acctbal}*2", "doubled"), Custom(lambda df: df), Filter("{s_nationkey}", "[5-9]|[0-9]{2,}")],
        mapping=[FieldMap("name", "s_name"), FieldMap("balance", "s_acctbal"), FieldMap("doubled", "doubled")],
        finalize=lambda df: df.filter(F.col("name").isNotNull()),
        column_functions={"name": "lower"},
    )
    return build(spark, spec)


@_R.add("""
SELECT count(*) AS input, count(*) FILTER (l_returnflag <> 'R') AS output, count(*) FILTER (l_returnflag = 'R') AS filtered,
       count(*) FILTER (l_returnflag <> 'R') AS stored, count(*) FILTER (l_returnflag <> 'R') AS written,
       count(*) FILTER (l_returnflag = 'R') AS rejected FROM lineitem""")
def job_counts_with_range_sink(spark, d):
    """A sink that ranges its rows reads them twice; the counts stay those of the rows."""
    place = scratch_path(spark, "counts")
    spec = JobSpec(
        source=table(spark, d, "lineitem"), ops=[Filter("{l_returnflag}", "R", keep=False)], mapping="k:l_orderkey,n:l_linenumber",
        sink=lambda df: df.repartitionByRange(4, "k", "n").sortWithinPartitions("k", "n").write.parquet(place + "/ok"),
        reject_sink=lambda df: df.write.parquet(place + "/bad"),
    )
    counts = run(spark, spec)
    told = {"input": counts.input, "output": counts.output, "filtered": counts.filtered, "stored": counts.stored}
    rejected = spark.read.parquet(place + "/bad").agg(F.count("*").alias("rejected"))
    written = spark.read.parquet(place + "/ok").agg(F.count("*").alias("written"))
    return written.select(*[F.lit(v).cast("bigint").alias(k) for k, v in told.items()], "written").crossJoin(rejected)


@_R.add("""
SELECT o_orderpriority AS priority, count(*) AS n FROM orders WHERE o_orderpriority NOT LIKE '4%' GROUP BY 1 HAVING count(*) % 2 = 0""")
def line_and_group_hooks(spark, d):
    """A hook on lines before parsing, and one on groups after the shuffle."""
    lines = table(spark, d, "orders").select(F.concat_ws(";", "o_orderkey", "o_orderpriority").alias("value"))
    spec = JobSpec(
        source=lines, line_hook=lambda t: None if t.split(";")[1].startswith("4") else t,
        parse=lambda df: parse_fields(df, ["key", "priority"], ";"), mapping="priority:priority:NONE,n:key:COUNT",
        group_hook=lambda df: df.filter(F.col("n") % 2 == 0),
    )
    return build(spark, spec)


@_R.add("""
SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'big' WHEN o_totalprice > 50000 THEN 'middle' ELSE 'small' END AS size,
       regexp_full_match(o_orderpriority, '[1-2]-.*') AS urgent, replace(o_orderpriority, '-', '/') AS priority FROM orders""")
def conditional_and_match_rules(spark, d):
    ops = [
        Compute("{o_totalprice} > 100000 ? 'big' : {o_totalprice} > 50000 ? 'middle' : 'small'", "size"),
        Compute("{o_orderpriority} =~ /[1-2]-.*/", "urgent"),
        Compute("string.replace_all({o_orderpriority}, '-', '/')", "priority"),
    ]
    return valid_rows(apply_ops(table(spark, d, "orders"), ops)).select("o_orderkey", "size", "urgent", "priority")


@_R.add("""
SELECT count(*) AS input, count(*) FILTER (l_quantity <= 10 AND l_returnflag = 'N') AS output,
       count(*) FILTER (NOT (l_quantity <= 10 AND l_returnflag = 'N')) AS filtered FROM lineitem""")
def rejects_after_grouping_are_counted(spark, d):
    spec = JobSpec(
        source=table(spark, d, "lineitem").where("l_quantity is not null").withColumn("small", (F.col("l_quantity") <= 10).cast("string")),
        ops=[Filter("{l_returnflag}", "N")], post_shuffle_ops=[Filter("{small}", "true")],
        mapping="status:l_linestatus:NONE,n:small:COUNT", sink=lambda df: df.write.format("noop").mode("overwrite").save(),
    )
    counts = run(spark, spec)
    return spark.range(1).select(*[F.lit(getattr(counts, k)).cast("bigint").alias(k) for k in ("input", "output", "filtered")])


@_R.add("SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 3")
def finalize_removes_groups(spark, d):
    """The last hook of a job may drop rows of the result."""
    spec = JobSpec(source=table(spark, d, "lineitem"), mapping="k:l_orderkey:NONE,n:l_linenumber:COUNT", finalize=lambda df: df.filter("n > 3"))
    return build(spark, spec)


@_R.add("""
SELECT l_linestatus AS mode, min(CAST(l_quantity AS DOUBLE)) AS low, max(CAST(l_quantity AS DOUBLE)) AS high,
       min(CASE WHEN l_linenumber = 1 THEN 'x' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END) AS first_text,
       max(CASE WHEN l_linenumber = 1 THEN 'x' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END) AS last_text
FROM lineitem GROUP BY 1""")
def extremes_of_numbers_and_mixed_text(spark, d):
    """Numbers in text compare as numbers; a group with any other text compares as text."""
    mixed = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("x"), "l_orderkey")).otherwise(F.col("l_orderkey").cast("string"))
    rows = table(spark, d, "lineitem").select("l_linestatus", F.col("l_quantity").cast("double").cast("string").alias("q"), mixed.alias("m"))
    out = build(spark, JobSpec(source=rows, mapping="mode:l_linestatus:NONE,low:q:MIN,high:q:MAX,first_text:m:MIN,last_text:m:MAX"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("low", "high")})
