"""Selections by key, latest rows, row windows, read splits and shards."""

from functools import reduce

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.functions import slots
from millrace.operators.latest import latest_per_key, row_window, within, without
from millrace.plans.ledger import failure_list, with_details
from millrace.session import collect_small, scratch_path
from millrace.sinks.keyed import KeyedTable
from millrace.sinks.shards import Sharding, shard_counts, with_shard, write_shard_files
from millrace.sinks.tables import delete_by_key, replace_by_key
from millrace.sources.quantiles import quantile_points
from millrace.sources.ranges import bind, hash_predicates, point_predicates, range_predicates, value_predicates
from millrace.sources.text import read_delimited

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql


@_R.add("""
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def drop_processed_inputs(spark, d):
    done = table(spark, d, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return without(table(spark, d, "orders"), done, ["o_orderkey"])


@_R.add("""
SELECT u.* FROM events u WHERE (user_id, ts) IN
  (SELECT user_id, max(ts) FROM events GROUP BY user_id) AND event_type = 'error'""")
def latest_attempt_failed(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id"], ["ts"]).filter("event_type = 'error'")


@_R.add("""
SELECT * FROM events WHERE user_id IN (
  SELECT user_id FROM events GROUP BY user_id HAVING max_by(event_type, ts) = 'error')""")
def inputs_of_failed_keys(spark, d):
    e = table(spark, d, "events")
    return within(e, latest_per_key(e, ["user_id"], ["ts"]).filter("event_type = 'error'"), ["user_id"])


@_R.add("""
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_returnflag
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE o.o_orderstatus = 'F'""")
def attempts_with_details(spark, d):
    attempts = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    details = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    return with_details(attempts, details, "o_orderkey")


@_R.add("""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderdate >= TIMESTAMP '1998-01-01'""")
def changed_inputs(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    collected = o.where("o_orderkey % 7 = 0").withColumn(
        "o_orderdate",
        F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.col("o_orderdate")),
    )
    return without(o, collected, ["o_orderkey", "o_orderdate"])


@_R.add("""
SELECT * FROM events e WHERE NOT EXISTS (SELECT 1 FROM events n WHERE n.user_id = e.user_id AND n.event_type = e.event_type AND n.ts > e.ts)""")
def latest_row_per_key(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts"])


@_R.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def ordered_rows(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@_R.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 20")
def row_page(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return row_window(o, [F.desc("o_totalprice"), F.col("o_orderkey")], limit=50, offset=20)


@_R.add("""
SELECT DISTINCT user_id, event_type FROM (SELECT user_id, event_type FROM events WHERE value > 50
 UNION SELECT user_id, event_type FROM events WHERE event_type = 'error')""")
def failure_union(spark, d):
    e = table(spark, d, "events")
    return failure_list(e.where("value > 50"), e.where("event_type = 'error'"), ["user_id", "event_type"])


@_R.add("SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def delete_rows_by_key(spark, d):
    keys = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return delete_by_key(table(spark, d, "orders"), keys, ["o_custkey"])


@_R.add("""
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def replace_rows_by_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    fresh = o.where("o_custkey % 5 = 0").withColumn("o_orderstatus", F.lit("X"))
    return replace_by_key(o, fresh, ["o_custkey"])


_AFTER_CHANGES = """
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 50 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders WHERE o_orderkey % 100 <> 3"""


def _changed_orders(spark, d):
    """Orders kept by key: a hundredth deleted by order, a fiftieth of the customers replaced."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    kept = KeyedTable(spark, scratch_path(spark, "keyed") + "/orders", ["o_custkey", "o_orderkey"]).create(o)
    kept.delete(o.where("o_orderkey % 100 = 3"))
    fresh = o.where("o_custkey % 50 = 1 and o_orderkey % 100 <> 3").withColumn("o_orderstatus", F.lit("X"))
    kept.replace(fresh)
    return kept


@_R.add(_AFTER_CHANGES)
def keyed_table_changes(spark, d):
    """Deleted and replaced rows beside base files that stay."""
    return _changed_orders(spark, d).read()


@_R.add(_AFTER_CHANGES)
def keyed_table_compacted(spark, d):
    """The same after the files that lost rows were rewritten and the old ones removed."""
    kept = _changed_orders(spark, d)
    kept.compact(share=0.0)
    kept.vacuum()
    return kept.read()


@_R.add("SELECT count(*) AS row_count, count(*) FILTER (o_orderkey % 100 = 3) AS deleted FROM orders")
def keyed_table_files(spark, d):
    """What the list of files says after a deletion."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    kept = KeyedTable(spark, scratch_path(spark, "keyed") + "/orders", ["o_orderkey"]).create(o)
    kept.delete(o.where("o_orderkey % 100 = 3").select("o_orderkey"))
    return kept.files().agg(F.sum("rows").alias("row_count"), F.sum("deleted").alias("deleted"))


# --- read splits: the predicates of a parallel database read, applied to a table


def _split_counts(df, predicates):
    """Rows per predicate; a row that met none or two of them would show up in ``wrong``."""
    conditions = [F.expr(p) for p in predicates]
    hits = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in conditions])
    number = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)])
    return (
        df.select(number.alias("split"), (hits != 1).cast("bigint").alias("bad"))
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("bad").alias("wrong"))
    )


def _bounds(df, column):
    return collect_small(df.agg(F.min(column), F.max(column)), 1, "bounds")[0]


def _range_sql(expression, relation, n, point="lo + (hi - lo) * i // {n}"):
    step = point.format(n=n)
    return f"""
WITH t AS (SELECT {expression} AS k FROM {relation}), b AS (SELECT min(k) AS lo, max(k) AS hi FROM t),
p AS (SELECT {step} AS point FROM b, range(1, {n}) r(i)), q AS (SELECT list(point ORDER BY point) AS points FROM p)
SELECT CAST(len(list_filter(points, lambda x: x <= k)) AS INTEGER) AS split, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong
FROM t, q GROUP BY 1"""


@_R.add("SELECT CAST(abs(o_orderkey % 16) AS INTEGER) AS split, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong FROM orders GROUP BY 1")
def split_by_hash(spark, d):
    return _split_counts(table(spark, d, "orders"), hash_predicates("o_orderkey", 16))


@_R.add(_range_sql("o_orderkey", "orders", 8))
def split_integer_ranges(spark, d):
    o = table(spark, d, "orders")
    return _split_counts(o, range_predicates("o_orderkey", "integer", *_bounds(o, "o_orderkey"), 8))


@_R.add(_range_sql("CAST(l_extendedprice AS DECIMAL(12,2))", "lineitem", 8, "CAST(lo + (hi - lo) * i / {n} AS DECIMAL(18,6))"))
def split_decimal_ranges(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_extendedprice").cast("decimal(12,2)").alias("k"))
    return _split_counts(li, range_predicates("k", "decimal", *_bounds(li, "k"), 8))


@_R.add(_range_sql("l_extendedprice", "lineitem", 8, "lo + (hi - lo) * i / {n}"))
def split_float_ranges(spark, d):
    li = table(spark, d, "lineitem")
    return _split_counts(li, range_predicates("l_extendedprice", "float", *_bounds(li, "l_extendedprice"), 8))


def _even_ranges(df, column, n):
    """Ranges at quantiles: their number, whether each is within a fifth of its share, and the rows they hold."""
    told = _split_counts(df, point_predicates(column, quantile_points(df, column, n)))
    share = F.sum("row_count") / n
    return told.agg(
        F.count("*").alias("ranges"), ((F.max("row_count") <= share * 1.2) & (F.min("row_count") >= share * 0.8)).alias("even"),
        F.sum("row_count").alias("row_count"), F.sum("wrong").cast("bigint").alias("wrong"),
    )


@_R.add("""
SELECT CAST(8 AS BIGINT) AS ranges, true AS even, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong FROM orders""")
def split_skewed_numbers(spark, d):
    """A key whose values crowd at the low end: even steps would put nearly all rows into the first range."""
    o = table(spark, d, "orders").select(F.pow("o_totalprice", F.lit(6.0)).alias("k"))
    return _even_ranges(o, "k", 8)


@_R.add("""
SELECT CAST(4 AS BIGINT) AS ranges, true AS even, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong FROM orders""")
def split_skewed_texts(spark, d):
    o = table(spark, d, "orders").select(F.concat(F.lit("o-"), F.conv(F.col("o_orderkey").cast("string"), 10, 2), F.lit("-"), "o_orderkey").alias("k"))
    return _even_ranges(o, "k", 4)


@_R.add("""
SELECT CASE WHEN toxic = 1 THEN 0 WHEN toxic = 0 THEN 1 ELSE 2 END AS split, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def split_boolean(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return _split_counts(docs.select((F.col("toxic") == 1).alias("k")), range_predicates("k", "boolean", None, None, 3))


@_R.add(_range_sql("CAST(o_orderdate AS DATE)", "orders", 8, "lo + CAST((hi - lo) * i // {n} AS INTEGER)"))
def split_date_ranges(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("k"))
    return _split_counts(o, range_predicates("k", "date", *_bounds(o, "k"), 8))


@_R.add(_range_sql("epoch_us(l_shipdate)", "lineitem", 8, "lo + (hi - lo) * i / {n}"))
def split_timestamp_ranges(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("k"))
    return _split_counts(li, range_predicates("k", "timestamp", *_bounds(li, "k"), 8))


@_R.add("""
SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS wrong, count(DISTINCT c_name) AS names FROM customer""")
def split_text_ranges(spark, d):
    c = table(spark, d, "customer")
    predicates = [F.expr(p) for p in range_predicates("c_name", "text", *_bounds(c, "c_name"), 8)]
    hits = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(False)).cast("int") for p in predicates])
    per_name = c.groupBy("c_name").agg(F.count(F.lit(1)).alias("n"), F.sum((hits != 1).cast("bigint")).alias("bad"))
    return per_name.agg(F.sum("n").alias("row_count"), F.sum("bad").alias("wrong"), F.count(F.lit(1)).alias("names"))


@_R.add("""
SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS split, row_count, CAST(0 AS BIGINT) AS wrong
FROM (SELECT o_orderpriority, count(*) AS row_count FROM orders GROUP BY 1)""")
def split_by_partition_value(spark, d):
    o = table(spark, d, "orders")
    values = sorted(r[0] for r in o.select("o_orderpriority").distinct().toLocalIterator())
    return _split_counts(o, value_predicates("o_orderpriority", values))


@_R.add("""
SELECT r_name, count(*) AS row_count FROM customer, nation, region
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND c_acctbal > r_regionkey * 100 GROUP BY 1""")
def parameter_rows_join(spark, d):
    params = table(spark, d, "region")
    data = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    condition = (F.col("n_regionkey") == F.col("r_regionkey")) & (F.col("c_acctbal") > F.col("r_regionkey") * 100)
    return params.join(data, condition).groupBy("r_name").agg(F.count(F.lit(1)).alias("row_count"))


@_R.add("""
SELECT CAST(n_nationkey AS INTEGER) AS split, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def parameter_splits(spark, d):
    rows = table(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey").toLocalIterator()
    return _split_counts(table(spark, d, "supplier"), [bind("s_nationkey = {n_nationkey}", r.asDict()) for r in rows])


# --- shards

_STRING_SLOT = """list_reduce(list_prepend(0, list_transform(string_split({0}, ''), lambda c: ascii(c))), lambda h, c: (h * 31 + c) & 1023)"""


@_R.add("SELECT o_orderkey, CAST((o_orderkey & 1023) // 256 AS INTEGER) AS shard FROM orders")
def shard_by_int_key(spark, d):
    out = with_shard(table(spark, d, "orders"), Sharding("o_orderkey", "int", [4], [256]), "shard")
    return out.select("o_orderkey", "shard")


@_R.add(f"""
SELECT c_name, CAST({_STRING_SLOT.format("substr(c_name, 13, 6)")} AS INTEGER) AS slot FROM customer""")
def slot_by_string_key(spark, d):
    return table(spark, d, "customer").select("c_name", slots.string_slot(F.col("c_name"), "12:18").alias("slot"))


@_R.add(f"""
SELECT doc_id, CAST(CASE WHEN s < 512 THEN s // 256 ELSE 2 END AS INTEGER) AS shard
FROM (SELECT doc_id, {_STRING_SLOT.format("text")} AS s FROM documents)""")
def shard_by_whole_text(spark, d):
    out = with_shard(table(spark, d, "documents"), Sharding("text", "string", [2, 1], [256, 512], ":"), "shard")
    return out.select("doc_id", "shard")


@_R.add("""
SELECT CAST((l_orderkey & 1023) // 128 AS INTEGER) AS shard, count(*) AS row_count FROM lineitem GROUP BY 1""")
def rows_per_shard(spark, d):
    return shard_counts(table(spark, d, "lineitem"), Sharding("l_orderkey", "int", [8], [128]))


@_R.add("""
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST((o_custkey & 1023) // 512 AS INTEGER) AS _shard FROM orders""")
def shard_files_read_back(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    sharding = Sharding("o_custkey", "int", [2], [512])
    path = scratch_path(spark, "shards") + "/files"
    write_shard_files(o, sharding, path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    rows = read_delimited(spark, path, schema, recursive=True, provenance=True)
    return rows.select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.regexp_extract("_file_path", "/_shard=([0-9]+)/", 1).cast("int").alias("_shard"),
    )


@_R.add("""
SELECT doc_id, true AS same_slot, true AS in_range FROM documents""")
def slots_of_wide_keys(spark, d):
    """Equal slices give equal slots whatever their spelling, for whole texts and for narrow slices of short keys."""
    wide, short = F.concat(F.lit("\U0001F600"), "text"), F.concat(F.lit("\U0001F600"), F.col("doc_id").cast("string"))
    slot = [slots.string_slot(wide, part) for part in (":", f"0:{2**31 - 1}", f"-{2**31 - 1}:")]
    few = [slots.string_slot(short, part) for part in (":", "0:32", "0:64", "-40:")]
    same = reduce(lambda a, b: a & b, [x == own[0] for own in (slot, few) for x in own[1:]])
    return table(spark, d, "documents").select("doc_id", same.alias("same_slot"), slot[0].between(0, 1023).alias("in_range"))


@_R.add("""
SELECT count(*) AS input_rows, count(*) FILTER (o_orderkey % 5 <> 0) AS stored, count(*) FILTER (o_orderkey % 5 = 0) AS rejected FROM orders""")
def null_shard_keys_rejected(spark, d):
    """Rows without a key reach the reject sink; stored and rejected rows together are the input."""
    place, bad = scratch_path(spark, "shards") + "/rows", scratch_path(spark, "shards") + "/bad"
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("key"), "o_orderstatus")
    write_shard_files(o, Sharding("key", "int", [4], [256]), place, reject_sink=lambda df: df.write.parquet(bad))
    told = [o.agg(F.count("*").alias("input_rows")), spark.read.text(place).agg(F.count("*").alias("stored"))]
    rejected = spark.read.parquet(bad).where("_reject_reason = 'null partition key'").agg(F.count("*").alias("rejected"))
    return told[0].crossJoin(told[1]).crossJoin(rejected)


@_R.add("""
SELECT n_nationkey, count(*) AS row_count FROM nation, customer
WHERE c_nationkey = n_nationkey AND n_name || '?' <> 'x' GROUP BY 1""")
def parameters_with_marks_in_values(spark, d):
    """Every nation as a parameter row; a ``?`` in a value or in quotes is text."""
    c = table(spark, d, "customer")
    params = table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit("?")).alias("label"))
    conditions = {r["n_nationkey"]: bind("c_nationkey = ? and '?' <> '{label}' and {label} <> 'x'", r.asDict()) for r in params.toLocalIterator()}
    number = reduce(lambda out, k: out.when(F.expr(conditions[k]), F.lit(k)), conditions, F)
    return c.select(number.alias("n_nationkey")).where("n_nationkey is not null").groupBy("n_nationkey").agg(F.count("*").alias("row_count"))
