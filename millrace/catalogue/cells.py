"""Wide-column tables."""

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.operators import cells as c
from millrace.session import scratch_path
from millrace.sinks import cells as sink
from millrace.sinks.keyed import KeyedTable

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql

_LAYOUT = "[f1:head:[o_custkey,o_orderstatus]]-[f2:price:[o_totalprice]]"
_KEY = "tj-{o_orderkey}"
_CELLS_SQL = """
(SELECT 'tj-' || o_orderkey AS row_key, 'f1' AS family, 'head' AS qualifier, o_orderdate AS ts, o_custkey || ',' || o_orderstatus AS value FROM orders
 UNION ALL SELECT 'tj-' || o_orderkey, 'f2', 'price', o_orderdate, CAST(o_totalprice AS VARCHAR) FROM orders)"""
_ROWS_SQL = """SELECT 'tj-' || o_orderkey AS row_key, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
 CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders"""


def _orders_as_cells(spark, d):
    o = table(spark, d, "orders")
    return c.to_cells(o, c.row_key(_KEY, o), c.parse_layout(_LAYOUT), F.col("o_orderdate"))


@_R.add(f"SELECT * FROM {_CELLS_SQL}")
def cells_from_rows(spark, d):
    return _orders_as_cells(spark, d)


@_R.add(_ROWS_SQL)
def cells_round_trip(spark, d):
    o = table(spark, d, "orders")
    path = scratch_path(spark, "cells") + "/table"
    sink.put(o, path, _KEY, c.parse_layout(_LAYOUT), F.col("o_orderdate"))
    return c.read_rows(spark.read.parquet(path), c.parse_layout(_LAYOUT))


@_R.add(f"""
SELECT * FROM {_CELLS_SQL} WHERE row_key >= 'tj-1000' AND row_key < 'tj-5' AND ts >= TIMESTAMP '1997-01-01'
 AND ts < TIMESTAMP '1999-06-01' AND family = 'f2'""")
def cell_scan(spark, d):
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    return c.scan(
        _orders_as_cells(spark, d), start_row="tj-1000", stop_row="tj-5",
        min_ts=ntz("1997-01-01"), max_ts=ntz("1999-06-01"), families=["f2"],
    )


@_R.add(f"""
SELECT * FROM {_CELLS_SQL} WHERE ts = TIMESTAMP '1998-10-03' AND (family = 'f1' AND qualifier = 'head')""")
def cell_scan_exact_time(spark, d):
    at = F.lit("1998-10-03").cast("timestamp_ntz")
    return c.scan(_orders_as_cells(spark, d), at_ts=at, columns=[("f1", "head")])


@_R.add("""
SELECT 'p' || p_partkey AS row_key, 'a' AS family, q AS qualifier, TIMESTAMP '2020-01-01' AS ts,
       CASE q WHEN 'brand' THEN p_brand ELSE p_type END AS value
FROM part, (VALUES ('brand'), ('type')) v(q)
WHERE (q = 'brand' OR p_size % 2 = 0) AND (p_size % 2 = 1 OR p_type <> 'SMALL')""")
def cell_value_filter(spark, d):
    p = table(spark, d, "part")
    both = c.to_cells(p, F.concat(F.lit("p"), "p_partkey"), c.parse_layout("[a:brand:[p_brand]]-[a:type:[p_type]]"),
                      F.lit("2020-01-01").cast("timestamp_ntz"))
    even = p.where("p_size % 2 = 0").select(F.concat(F.lit("p"), "p_partkey").alias("row_key"))
    sparse = both.filter("qualifier = 'brand'").unionByName(
        both.filter("qualifier = 'type'").join(even, "row_key", "left_semi")
    )
    return c.filter_rows(sparse, c.parse_filters("[filterType:17,family:a,qualifier:type,compareOp:NOT_EQUAL,value:SMALL]"))


@_R.add(f"""
SELECT * FROM ({_ROWS_SQL}) WHERE o_custkey || ',' || o_orderstatus < '5' AND o_totalprice >= '3'""")
def cell_filters_and(spark, d):
    filters = c.parse_filters(
        "[filterType:17,family:f1,qualifier:head,compareOp:LESS,value:5]"
        "-[filterType:17,family:f2,qualifier:price,compareOp:GREATER_OR_EQUAL,value:3]"
    )
    return c.read_rows(_orders_as_cells(spark, d), c.parse_layout(_LAYOUT), filters=filters)


@_R.add(f"SELECT * FROM {_CELLS_SQL} WHERE row_key NOT IN (SELECT 'tj-' || o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def cell_delete(spark, d):
    gone = table(spark, d, "orders").where("o_orderstatus = 'P'")
    return sink.delete(_orders_as_cells(spark, d), gone, _KEY)


@_R.add(f"SELECT * FROM {_CELLS_SQL}")
def cell_bulk_files(spark, d):
    path = scratch_path(spark, "bulk") + "/files"
    sink.write_bulk(_orders_as_cells(spark, d), path)
    return spark.read.parquet(path)


_SPLITS = ["tj-1500", "tj-2", "tj-30", "tj-7", "tj-70000"]


@_R.add(f"""
SELECT region, count(*) AS cells, min(row_key) AS first_row, max(row_key) AS last_row FROM (
  SELECT *, CAST({" + ".join(f"(row_key >= '{s}')::INT" for s in _SPLITS)} AS INTEGER) AS region FROM {_CELLS_SQL}) GROUP BY region""")
def cell_bulk_regions(spark, d):
    """Bulk files for the target's own split points: ranges of files don't overlap."""
    path = scratch_path(spark, "bulk") + "/files"
    sink.write_bulk(_orders_as_cells(spark, d), path, splits=_SPLITS)
    told = spark.read.parquet(f"{path}/_index/files")
    region = F.regexp_extract("file", "region=([0-9]+)/", 1).cast("int").alias("region")
    return told.groupBy(region).agg(F.sum("rows").alias("cells"), F.min("low").alias("first_row"), F.max("high").alias("last_row"))


@_R.add(f"SELECT * FROM {_CELLS_SQL} WHERE row_key IN ('tj-1', 'tj-101', 'tj-999', 'tj-none') AND family = 'f2'")
def cell_point_scan(spark, d):
    """Single rows from bulk files; only files whose zone map and Bloom filter let a key pass are opened."""
    path = scratch_path(spark, "bulk") + "/files"
    sink.write_bulk(_orders_as_cells(spark, d), path, partitions=16, bloom=True)
    return sink.read_bulk(spark, path, row_keys=["tj-1", "tj-101", "tj-999", "tj-none"], families=["f2"])


@_R.add(f"""
SELECT * FROM {_CELLS_SQL} WHERE row_key >= 'tj-1000' AND row_key < 'tj-5' AND ts >= TIMESTAMP '1997-01-01'
 AND ts < TIMESTAMP '1999-06-01'""")
def cell_range_scan_of_files(spark, d):
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    path = scratch_path(spark, "bulk") + "/files"
    sink.write_bulk(_orders_as_cells(spark, d), path, splits=_SPLITS)
    return sink.read_bulk(spark, path, start_row="tj-1000", stop_row="tj-5", min_ts=ntz("1997-01-01"), max_ts=ntz("1999-06-01"), regions=True)


@_R.add(f"SELECT * FROM {_CELLS_SQL} WHERE row_key NOT IN (SELECT 'tj-' || o_orderkey FROM orders WHERE o_orderkey % 100 = 3)")
def cell_delete_in_place(spark, d):
    """Rows deleted from a cell table kept by row key, whose files stay."""
    kept = KeyedTable(spark, scratch_path(spark, "cells") + "/kept", ["row_key"]).create(_orders_as_cells(spark, d))
    sink.delete_in(kept, table(spark, d, "orders").where("o_orderkey % 100 = 3"), _KEY)
    return kept.read()


@_R.add("SELECT p_partkey, p_brand, p_type, '' AS extra FROM part")
def pack_and_unpack(spark, d):
    p = table(spark, d, "part")
    packed = p.select("p_partkey", c.pack(["p_brand", "p_type"], "|").alias("cell"))
    return packed.select("p_partkey", *c.unpack(F.col("cell"), ["p_brand", "p_type", "extra"], "|"))
