"""Range joins by bins against all pairs of a small fixture."""

from pyspark.sql import functions as F

from chainframe.operators import joins


def test_within_against_all_pairs(spark):
    points = [("a" if i % 3 else None, i * 7 % 90 if i % 11 else None, i) for i in range(60)]
    ranges = [("a", s, s + n, k) for k, (s, n) in enumerate([(0, 0), (5, 40), (9, 1), (10, 10), (19, 1), (80, 500), (30, -1), (-20, 25)])] + [(None, 0, 90, 99), ("a", None, 5, 98)]
    got = joins.within(
        spark.createDataFrame(points, "g string, at long, p long"), spark.createDataFrame(ranges, "g string, s long, e long, r long"), ["g"], "at", F.col("s"), F.col("e"), 10
    )
    want = sorted((p, r) for g, at, p in points for h, s, e, r in ranges if g is not None and g == h and None not in (at, s) and s <= at <= e)
    assert sorted((x.p, x.r) for x in got.collect()) == want
    assert set(got.columns) == {"g", "at", "p", "s", "e", "r"}


def test_within_empty(spark):
    none = spark.createDataFrame([], "g string, at long")
    ranges = spark.createDataFrame([("a", 1, 2)], "g string, s long, e long")
    assert joins.within(none, ranges, ["g"], "at", F.col("s"), F.col("e"), 10).collect() == []
