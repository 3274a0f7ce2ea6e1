"""Split points at quantiles of skewed keys."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.sources import jdbc
from millrace.sources.jdbc import Database
from millrace.sources.quantiles import quantile_points, quantile_query
from millrace.sources.ranges import point_predicates


def sizes(df, predicates):
    """Rows of each range; every row lies in exactly one."""
    hit = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    row = df.agg(*[F.sum(h).alias(f"r{i}") for i, h in enumerate(hit)], F.sum(sum(hit[1:], hit[0])).alias("all"), F.count("*").alias("n")).first()
    assert row["all"] == row["n"]
    return [row[f"r{i}"] for i in range(len(hit))]


@pytest.mark.parametrize("key", [
    "cast(pow(1.002, id) as bigint)", "pow(id / 10000.0, 9)", "cast(pow(id / 100.0, 3) as decimal(20, 4))", "date_add(date '2000-01-01', cast(sqrt(id) * 10 as int))",
    "timestamp_seconds(cast(pow(1.001, id) as bigint))", "concat(repeat('a', cast(10 * rand(3) * rand(4) as int)), id)", "concat('é', char(65 + id % 2), uuid())",
])
def test_ranges_are_even(spark, key):
    df = spark.createDataFrame(spark.range(10_000).selectExpr(f"{key} AS k").collect(), spark.range(1).selectExpr(f"{key} AS k").schema)
    points = quantile_points(df, "k", 8)
    own = sizes(df, point_predicates("k", points))
    assert len(own) == 8 and all(1000 <= n <= 1500 for n in own), own


def test_ties_nulls_and_empty_tables(spark):
    heavy = spark.createDataFrame([(5,)] * 700 + [(None,)] * 50 + [(i,) for i in range(100)], "k int")
    points = quantile_points(heavy, "k", 10)
    assert points == sorted(set(points))
    assert sum(sizes(heavy, point_predicates("k", points))) == 850
    assert quantile_points(heavy.limit(0), "k", 4) == [] == quantile_points(heavy, "k", 1)
    assert quantile_points(spark.createDataFrame([("a",)] * 9 + [(None,)], "k string"), "k", 3) == []
    with pytest.raises(ValueError):
        quantile_points(spark.createDataFrame([([1],)], "k array<int>"), "k", 3)


def test_a_source_gives_its_own_points(spark, monkeypatch):
    """The query, run by Spark in place of a database, and the reads made of its answer."""
    draw = random.Random(2)
    rows = [(int(1000 * draw.paretovariate(0.5)) % 10**15 + i, dt.date(2020, 1, 1)) for i in range(2000)] + [(None, None)] * 7
    spark.createDataFrame(rows, "k bigint, day date").createOrReplaceTempView("skewed_source")
    asked = []

    def read(session, db, relation, predicates=(), where=None):
        asked.append((relation, list(predicates)))
        return session.sql(relation if relation.startswith("SELECT") else f"SELECT * FROM {relation}")

    monkeypatch.setattr(jdbc, "read_table", read)
    jdbc.read_by_range(spark, Database("jdbc:x"), "skewed_source", "k", None, 8, even=True)
    own = sizes(spark.table("skewed_source"), asked[1][1])
    assert sum(own) == 2007 and max(own) <= 1.2 * 2007 / 8
    tiles = [r[0] for r in spark.sql(quantile_query("skewed_source", "k", 4)).collect()]
    whole = sorted(r[0] for r in rows if r[0] is not None)
    assert tiles == sorted({whole[500], whole[1000], whole[1500]}) and Counter(tiles).most_common(1)[0][1] == 1
    spark.createDataFrame([(1,)] * 90 + [(2,)] * 10, "k int").createOrReplaceTempView("skewed_source")
    assert [r[0] for r in spark.sql(quantile_query("skewed_source", "k", 20)).collect()] == [2]
    spark.catalog.dropTempView("skewed_source")
