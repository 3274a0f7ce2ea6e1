"""Performance-measurement XML: one row per object and counter.

A user-level job on Spark's own XML functions: each document is parsed once
with a fixed schema, then objects and counters are exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.text import iso_datetime

SCHEMA = """
fileHeader struct<_fileFormatVersion:string, _vendorName:string,
  fileSender:struct<_elementType:string>, measCollec:struct<_beginTime:string>>,
measData array<struct<
  managedElement:struct<_localDn:string, _userLabel:string>,
  measInfo:array<struct<
    granPeriod:struct<_duration:string, _endTime:string>,
    measTypes:string,
    measValue:array<struct<_measObjLdn:string, measResults:string, suspect:string>>>>>>
"""

# Output columns in their order.
COLUMNS = (
    "fileFormatVersion", "vendorName", "elementType", "beginTime", "userLabel", "Server", "SBNID",
    "ENODEBID", "endTime", "duration", "CellID", "suspect", "measType", "value",
)


def _part(names: Column, key: str) -> Column:
    """Value of ``key`` in ``Server=1,SBNID=2``; "" when absent."""
    return F.coalesce(F.regexp_extract(names, rf"(?:^|,){key}=([^,]*)", 1), F.lit(""))


def _words(text: Column) -> Column:
    return F.split(F.trim(text), " ")


def counters(documents: DataFrame, xml: str = "value", partitions: int | None = None) -> DataFrame:
    """Rows of 14 text columns from a column of XML documents; other columns are passed on.

    ``partitions`` deals the documents out first, for a small input that Spark can't split.
    """
    if partitions:
        documents = documents.repartition(partitions)
    others = [c for c in documents.columns if c != xml]
    doc = documents.select(*others, F.from_xml(F.col(xml), SCHEMA, {"rowTag": "measCollecFile"}).alias("d"))
    data = doc.select(*others, "d.fileHeader", F.explode("d.measData").alias("m"))
    info = data.select(*others, "fileHeader", "m.managedElement", F.explode("m.measInfo").alias("i"))
    value = info.select(*others, "fileHeader", "managedElement", "i.granPeriod", "i.measTypes",
                        F.explode("i.measValue").alias("v"))
    pairs = F.arrays_zip(_words(F.col("measTypes")).alias("t"), _words(F.col("v.measResults")).alias("r"))
    pair = value.withColumn("p", F.explode(pairs)).filter(F.col("p.t").isNotNull())
    dn = F.col("managedElement._localDn")
    out = {
        "fileFormatVersion": F.col("fileHeader._fileFormatVersion"),
        "vendorName": F.col("fileHeader._vendorName"),
        "elementType": F.col("fileHeader.fileSender._elementType"),
        "beginTime": iso_datetime(F.col("fileHeader.measCollec._beginTime")),
        "userLabel": F.col("managedElement._userLabel"),
        "Server": _part(dn, "Server"),
        "SBNID": _part(dn, "SBNID"),
        "ENODEBID": _part(dn, "ENODEBID"),
        "endTime": iso_datetime(F.col("granPeriod._endTime")),
        "duration": F.col("granPeriod._duration"),
        "CellID": _part(F.col("v._measObjLdn"), "CellID"),
        "suspect": F.col("v.suspect"),
        "measType": F.col("p.t"),
        "value": F.col("p.r"),
    }
    return pair.select(*others, *[F.coalesce(c, F.lit("")).alias(n) for n, c in out.items()])


def read_measurements(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Measurement files, one document each (compressed ones by suffix).

    A document is one row while it is parsed, so a file must stay well below
    2 GiB; files are read in parallel.
    """
    return counters(spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True))
