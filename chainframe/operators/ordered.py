"""Global order without one task for all rows: rows go to range partitions, and each partition gets the sum of those before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.sources.shared import cut


def laid_out(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df in the shared folder with ``_part``: the range of the order that a row lies in, ascending, as many as shuffle partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)


def numbered(df: DataFrame, order: list[Column], number: str = "place", first: int = 1, name: str = "numbered") -> DataFrame:
    """df with the place of each row in the order (rows of equal order: in any). Only the counts of the partitions meet in one task."""
    laid = laid_out(df, order, name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = laid.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = laid.withColumn(number, F.row_number().over(Window.partitionBy("_part").orderBy(*order)).cast("long"))
    return placed.join(F.broadcast(offsets), "_part").withColumn(number, F.col(number) + F.col("_before") + (first - 1)).drop("_part", "_before")


def running(df: DataFrame, by: str, order: str, name: str, **values: tuple[str, Column, bool]) -> DataFrame:
    """df with running sums or maxima in a group: values: column=("sum" or "max", of what, whether the row itself counts).

    A group may hold all rows: it lies in many partitions, each of which folds its own rows, and what comes before a partition is
    carried to it (a row for each partition and group that meet).
    """
    fold = {"sum": F.sum, "max": F.max}
    laid = laid_out(df.select("*", *(of.alias(f"_of_{c}") for c, (_, of, _) in values.items())), [F.col(by), F.col(order)], name)
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("_part", by).agg(*(fold[kind](f"_of_{c}").alias(f"_all_{c}") for c, (kind, _, _) in values.items()))
    carried = parts.select("_part", by, *(fold[kind](f"_all_{c}").over(before).alias(f"_before_{c}") for c, (kind, _, _) in values.items()))
    inner = Window.partitionBy("_part", by).orderBy(order)
    rows = laid.select("*", *(fold[kind](f"_of_{c}").over(inner.rowsBetween(Window.unboundedPreceding, 0 if own else -1)).alias(f"_own_{c}") for c, (kind, _, own) in values.items()))

    def both(c: str, kind: str) -> Column:
        a, b = F.col(f"_own_{c}"), F.col(f"_before_{c}")
        return F.greatest(a, b) if kind == "max" else F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))

    return rows.join(carried, ["_part", by]).select(*df.columns, *(both(c, kind).alias(c) for c, (kind, _, _) in values.items()))
