"""Scalar functions of the data path."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.functions import numbers, text
from millrace.plans import measurements
from millrace.plans.macros import date_macros, now_macros, substitute

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql


@_R.add("""
SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice * (1 - l_discount)) AS two, format('{:,.1f}', l_extendedprice) AS grouped,
       printf('%.0f', l_quantity) AS whole, printf('%.8f', l_discount) AS eight
FROM lineitem""")
def decimal_texts(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        numbers.decimal_text(F.col("l_extendedprice") * (1 - F.col("l_discount")), "0.00").alias("two"),
        numbers.decimal_text(F.col("l_extendedprice"), "#,##0.0").alias("grouped"),
        numbers.decimal_text(F.col("l_quantity"), "0").alias("whole"),
        numbers.decimal_text(F.col("l_discount"), "0.00000000").alias("eight"),
    )


@_R.add("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS from_day,
       strftime(o_orderdate, '%Y-%m-%d 10:00:00') AS from_hour, CAST(NULL AS VARCHAR) AS from_month
FROM orders""")
def padded_timestamps(spark, d):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.expand_timestamp(day).alias("from_day"),
        text.expand_timestamp(F.concat(day, F.lit("10"))).alias("from_hour"),
        text.expand_timestamp(F.substring(day, 1, 6)).alias("from_month"),
    )


@_R.add("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain FROM events""")
def iso_timestamps(spark, d):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))
    return table(spark, d, "events").select("event_id", text.iso_datetime(iso).alias("plain"))


@_R.add("""
SELECT page_id, regexp_extract(url, '[^/]*$') AS name, regexp_extract(rtrim(url, '/'), '^(.*)/[^/]*$', 1) AS parent,
       length(url) - length(replace(url, '/', '')) AS slashes, replace(url, 'http', 'ftp') AS other,
       translate(url, '/?.', '_-') AS safe
FROM pages""")
def path_parts(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id",
        text.file_name(url).alias("name"),
        text.parent_path(url).alias("parent"),
        text.count_char(url, "/").cast("bigint").alias("slashes"),
        F.replace(url, F.lit("http"), F.lit("ftp")).alias("other"),
        text.replace_chars(url, "/?.", "_-").alias("safe"),
    )


@_R.add("""
SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 6, '0') AS padded,
       CASE WHEN length(p_brand) < 9 THEN rpad(p_brand, 9, '.') ELSE p_brand END AS filled,
       CASE WHEN length(p_name) < 8 THEN lpad(p_name, 8, ' ') ELSE p_name END AS kept
FROM part""")
def padded_texts(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        text.pad_left(F.col("p_size"), 6, "0").alias("padded"),
        text.pad_right(F.col("p_brand"), 9, ".").alias("filled"),
        text.pad_left(F.col("p_name"), 8).alias("kept"),
    )


@_R.add("""
SELECT event_id, coalesce(TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER), -1) AS k, 0.0::DOUBLE AS no_number,
       substr(props, 2, length(props) - 2) AS inner_text, event_type AS from_map
FROM events""")
def lenient_parsing(spark, d):
    pairs = F.concat(F.lit("a:1,type:"), F.col("event_type"), F.lit(",broken,a:2"))
    return table(spark, d, "events").select(
        "event_id",
        numbers.lenient_int(F.regexp_extract("props", "[0-9]+", 0), -1).alias("k"),
        numbers.lenient_double(F.col("event_type")).alias("no_number"),
        text.bracketed(F.col("props"), "{", "}").alias("inner_text"),
        text.pairs_to_map(pairs)["type"].alias("from_map"),
    )


@_R.add("""
SELECT doc_id, md5(text) AS m, sha1(text) AS s, sha256(text) AS s2, '7' || md5('7' || source) AS source_key FROM documents""")
def digests(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", text.digest(c).alias("m"), text.digest(c, "sha1").alias("s"), text.digest(c, "sha256").alias("s2"),
        text.file_id(7, F.col("source")).alias("source_key"),
    )


@_R.add("""
SELECT url, 'sfile_' || CASE WHEN regexp_matches(name, '[0-9]+') THEN regexp_extract(name, '[0-9]+') ELSE '$0' END || '_' || name || '.data' AS target_name
FROM (SELECT url, regexp_extract(url, '[^/]*$') AS name FROM pages)""")
def target_names(spark, d):
    return table(spark, d, "pages").select(
        "url", text.renamed(F.col("url"), "sfile_$0_{sf_name}.data", r"[0-9]+").alias("target_name")
    )


@_R.add("""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-15'""")
def macro_condition(spark, d):
    macros = {**date_macros("199803"), **now_macros(dt.datetime(1998, 4, 14, 23, 0, 0)), "low": "l_shipdate"}
    condition = substitute(
        "{LOW} >= to_timestamp_ntz('{yyyy}-{MM}-01') AND {low} < to_timestamp_ntz('{N_YYYYMMDDN}', 'yyyyMMdd')", macros
    )
    return table(spark, d, "lineitem").where(condition).select("l_orderkey", "l_linenumber", "l_shipdate")


_DOCUMENT = (
    '<measCollecFile><fileHeader fileFormatVersion="v1" vendorName="{event_type}"><fileSender elementType="ENB"/>'
    '<measCollec beginTime="{iso}+08:00"/></fileHeader><measData><managedElement '
    'localDn="Server={user_id},SBNID=5,ENODEBID={event_id}" userLabel="u{user_id}"/><measInfo>'
    '<granPeriod duration="PT900S" endTime="{iso}+08:00"/><measTypes>val key</measTypes>'
    '<measValue measObjLdn="x=1,CellID=c{event_id}"><measResults>{value} {key}</measResults>'
    "<suspect>false</suspect></measValue></measInfo></measData></measCollecFile>"
)


@_R.add("""
SELECT event_id, 'v1' AS "fileFormatVersion", event_type AS "vendorName", 'ENB' AS "elementType", t AS "beginTime",
       'u' || user_id AS "userLabel", CAST(user_id AS VARCHAR) AS "Server", '5' AS "SBNID",
       CAST(event_id AS VARCHAR) AS "ENODEBID", t AS "endTime", 'PT900S' AS "duration", 'c' || event_id AS "CellID",
       'false' AS "suspect", k AS "measType", CASE k WHEN 'val' THEN CAST(value AS VARCHAR) ELSE regexp_extract(props, '[0-9]+') END AS "value"
FROM (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events), (VALUES ('val'), ('key')) v(k)""")
def measurement_counters(spark, d):
    e = table(spark, d, "events").select(
        "event_id", "event_type", "user_id", "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.regexp_extract("props", "[0-9]+", 0).alias("key"),
    )
    return measurements.counters(e.select("event_id", text.template(_DOCUMENT, e.schema).alias("value")), partitions=spark.sparkContext.defaultParallelism)
