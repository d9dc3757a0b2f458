"""Joins by ranges, made equi-joins by bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: Column, end: Column, width: int) -> DataFrame:
    """Pairs of points and ranges of equal keys in which the point's ``at`` lies from start to end, both included.

    A range stands in each bin of ``width`` that it touches and a point in one, so a pair meets once and no task gets more
    than the points of a bin. Points and ranges with nulls in these columns meet nothing. Points and ranges share no column names but the keys.
    """
    bins = F.explode(F.sequence(F.floor(start / width), F.floor(end / width)))
    r = ranges.withColumns({"_start": start, "_end": end}).where("_start <= _end").withColumn("_bin", bins)
    p = points.withColumn("_bin", F.floor(F.col(at) / width))
    return p.join(r, [*keys, "_bin"]).where(F.col(at).between(F.col("_start"), F.col("_end"))).drop("_bin", "_start", "_end")
