"""Approximate nearest neighbours: exact scores and order, recall against brute force, odd vectors."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainframe.llm import ann, queries


def brute(ids, vectors, asked, k=5):
    unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
    out = {}
    for q in asked:
        i = int(np.flatnonzero(ids == q)[0])
        score = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_over_embeddings(spark, sf_dir):
    table = queries.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").toPandas().dropna()
    fine = [v is not None and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float)) for v in table["embedding"]]
    table = table[fine]
    vectors = np.stack([np.array(v, float) for v in table["embedding"]])
    ids = table["vec_id"].to_numpy()
    want = brute(ids, vectors, ids[ids % 50 == 0])
    rows = queries.op7_ann(spark, sf_dir).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    assert all(len(got[q]) == len(want[q]) for q in want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    place = {v: i for i, v in enumerate(ids)}
    for q, found in got.items():
        a = vectors[place[q]]
        for v, score in found:
            b = vectors[place[v]]
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_odd_vectors_ties_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, None]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 0.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0)]


def test_lengths_and_precision(spark):
    """Vectors meet those of their length; double components count in full."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0 + 1e-9]), (2, [0.6, 0.8]), (50, [1.0, 0.0, 0.0]), (51, [1.0, 1.0, 1.0]), (52, [0.0, 1.0, 0.0]), (100, [1.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    assert {k: v[0] for k, v in found.items()} == {(0, 1): 1, (0, 2): 2, (50, 1): 51, (50, 2): 52}
    assert abs(found[0, 1][1] - 1 / np.sqrt(1 + (1 + 1e-9) ** 2)) < 1e-15


def clustered(n, dim, size, noise, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(n // size, dim))
    centres /= np.sqrt((centres**2).sum(1, keepdims=True))
    return (np.repeat(centres, size, 0) + noise * draw.normal(size=(n, dim)) / np.sqrt(dim)).astype(np.float32)


@pytest.mark.parametrize(("size", "noise"), [(256, 0.15), (2048, 0.15), (4096, 0.3), (1, 0.0)])
def test_recall_in_clusters_and_answers_that_batches_do_not_change(spark, size, noise):
    vectors = clustered(32_768, 64, size, noise)
    ids = np.arange(len(vectors))
    frame = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.FixedSizeListArray.from_arrays(vectors.ravel(), 64).cast(pa.list_(pa.float32()))}))
    want = brute(ids, vectors.astype(float), ids[ids % 500 == 0])
    held, answers = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), []
    for rows, parts in ((700, 3), (4096, 7)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        answers.append(sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(frame, F.col("vec_id") % 500 == 0).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert answers[0] == answers[1]
    got = {}
    for q, _, v, _ in answers[0]:
        got.setdefault(q, set()).add(v)
    hits = sum(len(got[q] & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.999 * 5 * len(want)


def test_the_bound_spares_most_vectors():
    vectors = ann._unit(clustered(8_192, 64, 1, 0.0).astype(float))
    books = ann.fit(vectors[:2000])
    tile = ann._Tile(np.arange(64) + 10**6, vectors[:64], books, 5, 1.0)
    tile.meet(np.arange(8_192), vectors, *ann.encode(vectors, books))
    assert tile.reranked < 0.06 * 64 * 8_192


def test_a_crowd_of_equal_vectors(spark):
    rows = [(i, [0.5, 0.25, 1.0, 0.0]) for i in range(700)] + [(1000 + i, [float(np.cos(i)), float(np.sin(i)), 0.0, 0.1]) for i in range(50)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 100).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4]


def test_empty(spark):
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).collect() == []


def test_anisotropic_codes_lower_the_parallel_error():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(2000, 16))
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    books = ann.fit(x)
    parts = ann._split(x)

    def along(weight):
        codes = ann.assign(parts, books, weight)
        made = np.stack([b[c] for b, c in zip(books, codes, strict=True)])
        return ((((parts - made) * parts).sum((0, 2))) ** 2).mean()

    assert along(8.0) < 0.7 * along(1.0)
