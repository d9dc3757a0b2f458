"""Mixing: targets against plain water filling, and what pivotal rounding promises."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chainframe.llm import mixing


def plain_targets(sizes, share=1.5, weights=(5, 2, 1), most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = total / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in over}
        total -= sum(out[s] for s in over)
        open_ -= over
    return out


@pytest.fixture(scope="module")
def rows():
    names = ["a"] * 400 + ["b"] * 90 + ["c"] * 8 + [None] * 30 + ["e"] * 3
    return [(i, s, 0 if i % 17 == 0 else 1 + (i * 37) % 300) for i, s in enumerate(names)] + [(None, "a", 12), (5, "a", 12), (5, "a", 12)]


def test_targets_and_taken(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    got = mixing.plan(docs, F.col("words")).collect()
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    want = plain_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2 * r.n_rows
        taken[r.source] += r.copies * r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s], s
    assert sum(r.n_rows for r in got) == len(rows)


def test_reruns_agree_and_rows_come_as_often_as_planned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long").withColumn("bucket", F.lit("extra"))
    one, two = (sorted(map(str, mixing.mix(d, F.col("words")).collect())) for d in (docs, docs.repartition(7)))
    assert one == two
    planned = mixing.plan(docs, F.col("words")).agg(F.sum("copies")).first()[0]
    assert len(one) == planned


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, "a", 0), (2, "a", 0)]])
def test_no_words(spark, rows):
    got = mixing.plan(spark.createDataFrame(rows, "doc_id long, source string, words long"), F.col("words")).collect()
    assert [(r.target, r.copies) for r in got] == [(0.0, 0)] * len(rows)


@pytest.mark.parametrize("same", [True, False])
def test_rows_without_a_key_and_equal_rows_come_near_their_target(spark, same):
    """1,000 rows of 100 words without a doc_id: within a row of the target, no row above 2 times, and mixed as planned."""
    docs = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit(100).alias("words"), (F.lit("t") if same else F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(1, "b", 7, "u"), (2, "b", 90, "v")], docs.schema))
    rows = mixing.per_row(mixing.plan(docs, F.col("words"))).collect()
    assert len(rows) == 1002 and all(0 <= r.copies <= 2 for r in rows)
    for source in "ab":
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.copies * r["size"] for r in mine) - mine[0].target) <= 100
    assert mixing.mix(docs, F.col("words")).count() == sum(r.copies for r in rows)


def test_many_sources_and_odd_columns(spark):
    """Sources beyond the broadcast, and columns that hash only as text."""
    docs = spark.range(300).select("id", F.concat(F.lit("s"), F.col("id") % 90).alias("source"), (F.col("id") % 23).alias("words"), F.create_map(F.lit("k"), "id").alias("extra")).withColumnRenamed("id", "doc_id")
    held, mixing.BROADCAST_SOURCES = mixing.BROADCAST_SOURCES, 10
    try:
        salted = sorted(map(str, mixing.plan(docs, F.col("words")).collect()))
        assert mixing.mix(docs, F.col("words")).columns == docs.columns
    finally:
        mixing.BROADCAST_SOURCES = held
    assert salted == sorted(map(str, mixing.plan(docs, F.col("words")).collect()))
    sizes = {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum("words")).collect()}
    want = plain_targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) for r in mixing.plan(docs, F.col("words")).collect())
