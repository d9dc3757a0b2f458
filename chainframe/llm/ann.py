"""Nearest neighbours by score-aware anisotropic quantisation.

Vectors are scaled to length one, so the cosine is an inner product. A product quantiser with four-bit
codes is fitted under a loss that weighs the residual parallel to a vector more than the rest, because
that part changes the inner products that matter (those near the maximum). Every vector is encoded, and two numbers are kept of its
residual: the part along the vector and the length of the rest. Queries and vectors meet in tiles (a block of queries and a slice
of the vectors): a tile streams its vectors, scores them by table look-ups (two codes a byte), and reranks exactly, in double
precision, every vector whose score and residual leave it a chance to be among the k best so far. With ``slack`` 1 that
chance is a bound (the rest of the residual can change an inner product s by at most its length times sqrt(1 - s^2)), so the
result is that of a full comparison, whatever the partitions and batches; a smaller slack reranks less and may miss some.

The codebooks are fitted on a bounded sample of vectors of each length; everything else covers all. Vectors meet those
of their own length only, whatever lengths a table has. Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
without an id. A query id that repeats stands for its smallest vector. Repeated candidate rows are
candidates each. Ties go to the smaller id. With fewer candidates than ``k`` all are returned. Further columns are left aside; an
empty table gives an empty result. Very long vectors make smaller blocks of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.common import bound_batches, cut

#: Numbers of a sample that the codebooks of a length are fitted on, at most about this many, chosen by the hash of id and vector.
SAMPLE_NUMBERS = 640_000
CENTRES, ROUNDS = 16, 6
#: Components of a subspace (one four-bit code each).
SUBSPACE = 1
#: Inner products from this share of the maximum on are those that the quantiser is fitted for.
THRESHOLD = 0.2
#: Vectors reranked before the bound is known, and vectors scored at a time.
RERANK, BLOCK = 64, 4_096
#: Queries scored at a time; numbers of a block of queries, of a slice of the vectors, and of what is reranked at a time.
QUERY_STEP, QUERY_NUMBERS, SLICE_NUMBERS, PAIR_NUMBERS = 128, 1 << 21, 1 << 28, 1 << 21
#: What the sums of single-precision table entries may be off by.
ROUNDING = 1e-4


def parallel_weight(dim: int, threshold: float = THRESHOLD) -> float:
    """How much more the parallel residual weighs, for vectors of length one."""
    return max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))


def _split(x: np.ndarray) -> np.ndarray:
    """(n, dim) to (subspaces, n, SUBSPACE), padded with zeros."""
    pad = -x.shape[1] % (2 * SUBSPACE)  # an even number of codes
    x = np.pad(x, ((0, 0), (0, pad)))
    return np.ascontiguousarray(x.reshape(len(x), -1, SUBSPACE).swapaxes(0, 1))


def assign(parts: np.ndarray, books: np.ndarray, weight: float, passes: int = 2) -> np.ndarray:
    """Codes (subspaces, n) by coordinate descent on |r|^2 + (weight - 1) (r.x)^2, r being the residual of x."""
    step = max(1, (1 << 20) // max(1, parts.shape[0] * CENTRES))
    done = [_assign(parts[:, at : at + step], books, weight, passes) for at in range(0, parts.shape[1], step)]
    return np.concatenate(done, axis=1) if done else np.zeros(parts.shape[:2], np.int64)


def _assign(parts: np.ndarray, books: np.ndarray, weight: float, passes: int) -> np.ndarray:
    gaps = ((parts[:, :, None] - books[:, None]) ** 2).sum(-1)
    along = ((parts[:, :, None] - books[:, None]) * parts[:, :, None]).sum(-1)
    codes = gaps.argmin(-1)
    rows = np.arange(parts.shape[1])
    total = sum(along[m, rows, codes[m]] for m in range(len(parts)))
    for _ in range(passes):
        for m in range(len(parts)):
            others = total - along[m, rows, codes[m]]
            codes[m] = (gaps[m] + (weight - 1) * (others[:, None] + along[m]) ** 2).argmin(-1)
            total = others + along[m, rows, codes[m]]
    return codes


def fit(sample: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (subspaces, CENTRES, SUBSPACE) for vectors of length one."""
    parts, weight = _split(sample), parallel_weight(sample.shape[1])
    start = np.linspace(0, len(sample) - 1, CENTRES).astype(int)
    order = np.argsort(parts[:, :, 0], axis=1)
    books = np.stack([p[o[start]] for p, o in zip(parts, order, strict=True)])
    eye = np.eye(SUBSPACE)
    for _ in range(rounds):
        codes = assign(parts, books, weight)
        rows = np.arange(parts.shape[1])
        along = np.stack([((p - b[c]) * p).sum(-1) for p, b, c in zip(parts, books, codes, strict=True)])
        total = along.sum(0)
        for m, (p, c) in enumerate(zip(parts, codes, strict=True)):
            reach = (total - along[m] + (p * p).sum(-1))[:, None] * p
            for k in range(CENTRES):
                mine = rows[c == k]
                if len(mine):
                    x = p[mine]
                    books[m, k] = np.linalg.solve(len(mine) * eye + (weight - 1) * x.T @ x, x.sum(0) + (weight - 1) * reach[mine].sum(0))
    return books


def _plain_books(dim: int) -> np.ndarray:
    """Codebooks without a sample: even steps."""
    n = (dim + dim % (2 * SUBSPACE)) // SUBSPACE
    return np.repeat(np.repeat(np.linspace(-1, 1, CENTRES)[None, :, None], n, 0), SUBSPACE, 2)


def encode(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of vectors of length one: bytes (n, subspaces / 2) of two codes each, the residual along each vector, and the length of the rest of it."""
    parts = _split(vectors)
    codes = assign(parts, books, parallel_weight(vectors.shape[1]))
    rest = np.concatenate([p - b[c] for p, b, c in zip(parts, books, codes, strict=True)], axis=1)
    along = np.einsum("ij,ij->i", rest, parts.swapaxes(0, 1).reshape(len(vectors), -1))
    across = np.sqrt(np.maximum(0.0, (rest**2).sum(1) - along**2))
    codes = codes.astype(np.uint8)
    return np.ascontiguousarray((codes[0::2] | codes[1::2] << 4).T), along, across


def tables(queries: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(queries, bytes, 256): what each value of a byte adds to the inner product."""
    each = np.einsum("mqd,mkd->qmk", _split(queries), books).astype(np.float32)
    return (each[:, 1::2, :, None] + each[:, 0::2, None, :]).reshape(len(queries), -1, CENTRES * CENTRES)


class _Tile:
    """The best k of each query of a tile so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, books: np.ndarray, k: int, slack: float):
        self.ids, self.k, self.slack = ids, k, slack
        self.vectors = vectors
        self.norms = np.sqrt((vectors**2).sum(1))
        self.books = books
        self.best = np.full((len(ids), k), -np.inf)
        self.found = np.zeros((len(ids), k), np.int64)
        self.pairs = max(1, PAIR_NUMBERS // vectors.shape[1])
        self.reranked = 0

    def meet(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, along: np.ndarray, across: np.ndarray) -> None:
        """Vectors pass the queries, at most BLOCK at a time."""
        for at in range(0, len(ids), BLOCK):
            part = slice(at, at + BLOCK)
            some, norms = vectors[part], np.sqrt((vectors[part] ** 2).sum(1))
            for q in range(0, len(self.ids), QUERY_STEP):
                self._score(q, ids[part], some, norms, codes[part], along[part], across[part])

    def _score(self, at, ids, vectors, norms, codes, along, across) -> None:
        mine = slice(at, at + QUERY_STEP)
        table = tables(self.vectors[mine] / self.norms[mine, None], self.books)
        scores = np.zeros((len(table), len(ids)), np.float32)
        for byte in range(codes.shape[1]):
            scores += table[:, byte].take(codes[:, byte], axis=1)
        close = self._close(mine, scores, along, across)
        most = close.sum(axis=1)
        crowded = np.flatnonzero(most > RERANK)  # the best by their codes first: they raise the bar for the rest
        if len(crowded):
            first = np.argpartition(-np.where(close[crowded], scores[crowded], -np.inf), RERANK, axis=1)[:, :RERANK]
            self._rerank(at + np.repeat(crowded, RERANK), first.ravel(), ids, vectors, norms)
            close[crowded] = self._close(mine, scores, along, across)[crowded]
            close[np.repeat(crowded, RERANK), first.ravel()] = False
        near, rows = np.nonzero(close)
        self._rerank(at + near, rows, ids, vectors, norms)

    def _close(self, mine: slice, scores: np.ndarray, along: np.ndarray, across: np.ndarray) -> np.ndarray:
        """Which vectors may reach the k-th best inner product s of a query: score >= s (1 - along) - sqrt(1 - s^2) across."""
        least = self.best[mine, -1]
        bar = np.clip(least, 0.0, 1.0)
        need = bar[:, None] * (1 - along) - (self.slack * np.sqrt(1 - bar**2))[:, None] * across - ROUNDING
        return (scores >= need) | (least < 0)[:, None]

    def _rerank(self, near, rows, ids, vectors, norms) -> None:
        self.reranked += len(near)
        for a in range(0, len(near), self.pairs):
            self._merge(near[a : a + self.pairs], rows[a : a + self.pairs], ids, vectors, norms)

    def _merge(self, near, rows, ids, vectors, norms) -> None:
        other = self.ids[near] != ids[rows]
        near, rows = near[other], rows[other]
        exact = np.einsum("ij,ij->i", self.vectors[near], vectors[rows]) / (self.norms[near] * norms[rows])
        touched = np.unique(near)
        held = self.best[touched] > -np.inf
        q = np.concatenate([near, np.repeat(touched, self.k)[held.ravel()]])
        score, found = np.concatenate([exact, self.best[touched][held]]), np.concatenate([ids[rows], self.found[touched][held]])
        order = np.lexsort((found, -score, q))
        q, score, found = q[order], score[order], found[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        kept = place < self.k
        self.best[touched] = -np.inf
        self.best[q[kept], place[kept]], self.found[q[kept], place[kept]] = score[kept], found[kept]

    def rows(self) -> pa.RecordBatch:
        q, place = np.nonzero(self.best > -np.inf)
        return pa.RecordBatch.from_pydict({"query_id": self.ids[q], "vec_id": self.found[q, place], "score": self.best[q, place]})


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v**2).sum(1, keepdims=True))


def usable(vector: str) -> Column:
    """Vectors that have a direction."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _fitted(good: DataFrame, shapes: DataFrame) -> dict[int, np.ndarray]:
    """Codebooks by length, fitted in tasks, each on a bounded sample."""
    sample = good.join(F.broadcast(shapes), "dim").where(F.pmod(F.xxhash64("id", "v"), F.col("every")) == 0).select("dim", F.col("v").cast("array<double>").alias("v"))

    def run(rows: pa.Table) -> pa.Table:
        dim = rows.column("dim")[0].as_py()
        points = _matrix(rows.column("v").combine_chunks(), dim)
        points = points[np.lexsort(points.T[::-1])]  # whatever the order of the rows
        return pa.table({"dim": pa.array([dim], pa.int32()), "books": pa.array([fit(_unit(points)).ravel()], pa.list_(pa.float64()))})

    found = sample.groupBy("dim").applyInArrow(run, "dim int, books array<double>").toArrow()  # a row a length
    return {dim: np.array(books).reshape(-1, CENTRES, SUBSPACE) for dim, books in zip(found.column("dim").to_pylist(), found.column("books").to_pylist(), strict=True)}


def search(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", slack: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` holds for, the k rows of largest cosine found, without its own."""
    spark = bound_batches(vectors.sparkSession, rows=BLOCK, size="16m")
    own = vectors.schema[vector].dataType
    kind = own.simpleString() if isinstance(own, T.ArrayType) and isinstance(own.elementType, (T.FloatType, T.DoubleType)) else "array<double>"
    good = vectors.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"), F.size(vector).alias("dim"), queries.alias("asks"))
    counted = [(r["dim"], r["n"], r["asked"]) for r in good.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("asked")).collect()]  # a row a length
    if not any(asked for _, _, asked in counted):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tasks, shapes = int(spark.conf.get("spark.sql.shuffle.partitions")), []
    for dim, n, asked in counted:
        q_blocks = max(1, -(-asked * dim // QUERY_NUMBERS))
        slices = max(-(-n * dim // SLICE_NUMBERS), -(-tasks // q_blocks)) if asked else 0
        shapes.append((dim, max(1, n * dim // SAMPLE_NUMBERS), q_blocks, slices))
    shape = spark.createDataFrame([s for s in shapes if s[3]], "dim int, every long, q_blocks long, slices long")
    shared = spark.sparkContext.broadcast(_fitted(good, shape))  # 16 numbers a component of each length

    def index(batches):
        for batch in batches:
            lengths = batch.column("dim").to_numpy()
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                books = shared.value.get(dim, _plain_books(dim))
                codes, along, across = encode(_unit(_matrix(part.column("v"), dim)), books)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(along), pa.array(across)], names=[*part.schema.names, "codes", "along", "across"])

    met = good.join(F.broadcast(shape.select("dim", "q_blocks", "slices")), "dim")
    indexed = cut(met.mapInArrow(index, T.StructType([*met.schema.fields, T.StructField("codes", T.BinaryType()), T.StructField("along", T.DoubleType()), T.StructField("across", T.DoubleType())])), "ann-index")
    once = indexed.where("asks").groupBy("dim", "id", "q_blocks", "slices").agg(F.min("v").alias("v"))
    nothing = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("along"), F.lit(None).cast("double").alias("across")]
    tile = lambda q, s: F.struct(F.col("dim"), q.alias("q"), s.alias("s")).alias("tile")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asking = once.withColumn("s", upto("slices")).select(tile(F.pmod(F.xxhash64("id"), F.col("q_blocks")), F.col("s")), F.lit(0).alias("kind"), "id", "v", *nothing)
    asked_of = indexed.withColumn("q", upto("q_blocks")).select(tile(F.col("q"), F.pmod(F.xxhash64("id", "v"), F.col("slices"))), F.lit(1).alias("kind"), "id", "v", "codes", "along", "across")
    n_tiles = sum(q * s for _, _, q, s in shapes)
    tiles = asking.unionByName(asked_of).repartition(min(n_tiles, 100_000), "tile").sortWithinPartitions("tile", "kind").select("tile.*", "kind", "id", "v", "codes", "along", "across")

    def scan(batches):
        current, tile, asking, kept, n = None, None, [], [], 0

        def pass_on():
            nonlocal current, kept, n
            if kept and asking:
                dim = tile[0]
                current = current or _Tile(*map(np.concatenate, zip(*asking, strict=True)), shared.value.get(dim, _plain_books(dim)), k, slack)
                current.meet(*map(np.concatenate, zip(*kept, strict=True)))
            kept, n = [], 0

        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("dim", "q", "s", "kind")])
            edges = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if a == b:
                    continue
                run, named = batch.slice(a, b - a), tuple(names[:3, a].tolist())
                if named != tile:
                    pass_on()
                    if current:
                        yield current.rows()
                    tile, current, asking = named, None, []
                ids, v = run.column("id").to_numpy(), _matrix(run.column("v"), named[0])
                if names[3, a] == 0:
                    asking.append((ids, v))
                    continue
                codes = np.frombuffer(b"".join(run.column("codes").to_pylist()), np.uint8).reshape(b - a, -1)
                kept.append((ids, v, codes, run.column("along").to_numpy(), run.column("across").to_numpy()))
                n += b - a
                if n >= BLOCK:
                    pass_on()
        pass_on()
        if current:
            yield current.rows()

    near = tiles.mapInArrow(scan, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
