"""N-gram Jaccard join with Bayesian pruning of candidates.

Documents link if the Jaccard similarity of their sets of word n-grams reaches a threshold. Documents of
equal words form one text; only distinct texts are compared:

1. MinHash values in bands make buckets. At a similarity of 0.8 two texts share none with a chance of 5e-8.
2. Buckets of the same texts are merged into one list by a fingerprint, so a group of near copies is one
   list rather than one for each band. Long lists, by texts or by n-grams, are cut into blocks, and each pair of blocks is a tile.
3. A tile holds the n-grams of one block and streams the texts of the other past it. It compares MinHash values of
   its pairs some at a time, and drops a pair once the posterior probability that its similarity reaches the threshold falls
   below a tolerance. The remaining pairs are verified on the n-grams themselves. A pair that shares several lists is
   compared in the first.
4. A tile returns a row a text (its links and the smallest text it hangs together with), never a row a pair.
   Classes are the connected components of these.

Words are runs without ASCII white space. A text of fewer words than n has one n-gram, all its words; a text
without words (or null) links to nothing. Rows without a key take no part and keep a null class. Repeated rows are copies; a
key with several texts stands for each of them on its own, and its rows come back once for each text. Further columns are left
aside. An empty table gives an empty result. Very long texts are compared whole: a tile holds at most about BLOCK_GRAMS n-grams (or
one text) and one text that streams past, so its memory follows neither the length of a group's texts nor their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainframe.llm.common import bound_batches, cut, slices, words_digest

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
#: Pairs whose chance to reach the threshold is below this, given the MinHash values compared so far, are dropped.
TOLERANCE = 1e-6
#: MinHash values compared before each look at the posterior.
STEP = 16
#: Texts of a block, and their n-grams (16 bytes each at most in a tile's index).
BLOCK, BLOCK_GRAMS = 512, 2_000_000
#: Hashes of words that a worker keeps, and postings that it adds up at a time.
KNOWN_WORDS, POSTINGS = 50_000, 1_000_000
_SEED = np.random.default_rng(20240229)
_TIMES = _SEED.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_PLUS = _SEED.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def ngrams(text: str, known: dict[bytes, int], n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams. known: hashes of words so far."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    fresh = set(words).difference(known)
    known.update((w, xxhash.xxh64_intdigest(w)) for w in fresh)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = _mixed(out * _PRIME + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def minhash(grams: np.ndarray) -> np.ndarray:
    """BANDS * ROWS values of a set of n-grams."""
    least = np.full(len(_TIMES), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 4096):
        least = np.minimum(least, (grams[None, at : at + 4096] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1))
    return (least >> _SHIFT).astype(np.uint32)


def prune_table(hashes: int, threshold: float, tolerance: float) -> dict[int, int]:
    """After so many hashes compared: the fewest matches with which a pair stays.

    With a uniform prior, similarity given m of n matches is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    out = {}
    for n in range(STEP, hashes + 1, STEP):
        tail, least = 0.0, n
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                least = m
                break
        out[n] = least
    return out


class Block:
    """The texts that a tile holds: their n-grams and MinHash values, and an index of the n-grams once many pairs ask for it."""

    def __init__(self, grams: list[np.ndarray], mask: int):
        self.grams = grams
        self.sizes = np.array([len(g) for g in grams], np.int64)
        self.values = np.stack([minhash(g) for g in grams])
        self.mine = np.array([mask >> k & 1 for k in range(BANDS)], bool)
        self.index = None

    def candidates(self, values: np.ndarray, since: int, table: dict[int, int]) -> np.ndarray:
        """Texts from place ``since`` on that share a bucket with these values (the first such one in this tile's list) and that the posterior leaves."""
        bands = self.values[since:].reshape(-1, BANDS, ROWS)
        same = (bands == values.reshape(BANDS, ROWS)).all(axis=2)
        first = same.argmax(axis=1)
        near = since + np.flatnonzero(same[np.arange(len(same)), first] & self.mine[first])
        matches = np.zeros(len(near), np.int64)
        for n, least in table.items():
            if not len(near):
                break
            matches += (self.values[near, n - STEP : n] == values[n - STEP : n]).sum(axis=1)
            stay = matches >= least
            near, matches = near[stay], matches[stay]
        return near

    def common(self, grams: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of a set of n-grams with those of the texts near."""
        if len(near) <= 8:
            return np.array([_shared(grams, self.grams[i]) for i in near], np.int64)
        if self.index is None:
            every = np.concatenate(self.grams)
            order = np.argsort(every, kind="stable")
            owner = np.repeat(np.arange(len(self.grams), dtype=np.int32), self.sizes)[order]
            every = every[order]
            starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            self.index = every[starts], np.append(starts, len(every)), owner
        keys, starts, owner = self.index
        place = np.searchsorted(keys, grams)
        place = place[keys[np.minimum(place, len(keys) - 1)] == grams]
        first, n = starts[place], starts[place + 1] - starts[place]
        ends = np.cumsum(n)
        both, at = np.zeros(len(self.grams), np.int64), 0
        while at < len(n):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTINGS, "right")))
            some = n[at:stop]
            rows = np.repeat(first[at:stop] - (np.cumsum(some) - some), some) + np.arange(int(some.sum()))
            both += np.bincount(owner[rows], minlength=len(both))
            at = stop
        return both[near]

    def linked(self, grams: np.ndarray, values: np.ndarray, since: int, threshold: float, table: dict[int, int]) -> np.ndarray:
        """Texts from place ``since`` on that a text links to."""
        near = self.candidates(values, since, table)
        if not len(near):
            return near
        both = self.common(grams, near)
        return near[both >= threshold * (self.sizes[near] + len(grams) - both) - 1e-9]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[place] == a).sum())


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each place hangs together with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


class _Tile:
    """Links of one tile: texts of the held block come first, then those that stream past (none if it is a block with itself)."""

    def __init__(self, mask: int, within: bool, threshold: float, table: dict[int, int]):
        self.mask, self.within, self.threshold, self.table = mask, within, threshold, table
        self.digests, self.copies, self.grams = [], [], []
        self.block, self.a, self.b = None, [], []

    def meet(self, place: int, grams: np.ndarray, values: np.ndarray, since: int) -> None:
        near = self.block.linked(grams, values, since, self.threshold, self.table)
        self.a.append(np.full(len(near), place))
        self.b.append(near)

    def add(self, digest: bytes, copies: int, streams: bool, grams: np.ndarray) -> None:
        self.digests.append(digest)
        self.copies.append(copies)
        if not streams:
            self.grams.append(grams)
            return
        if self.block is None:
            self.block = Block(self.grams, self.mask) if self.grams else False
        if self.block:
            self.meet(len(self.digests) - 1, grams, minhash(grams), 0)

    def rows(self, schema: pa.Schema) -> pa.RecordBatch | None:
        if self.within and len(self.grams) > 1:
            self.block = Block(self.grams, self.mask)
            for i, grams in enumerate(self.grams[:-1]):
                self.meet(i, grams, self.block.values[i], i + 1)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.a, self.b))
        if not len(a):
            return None
        copies, n = np.array(self.copies), len(self.digests)
        links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        # the root of a component is its smallest digest, so places go by the order of digests
        order = sorted(range(n), key=self.digests.__getitem__)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        root = _roots(n, rank[a], rank[b])
        hit = np.flatnonzero(links)
        named = [self.digests[order[root[rank[i]]]] for i in hit]
        return pa.RecordBatch.from_arrays([pa.array([self.digests[i] for i in hit], pa.binary()), pa.array(links[hit].astype(np.int64)), pa.array(named, pa.binary())], schema=schema)


def _tiles(tiled: DataFrame, n: int, threshold: float) -> DataFrame:
    """(digest, links, root) of each tile. tiled: tile, within, mask, streams, copies, digest, text; in its partitions sorted by tile,
    streams and digest."""
    table = prune_table(BANDS * ROWS, threshold, TOLERANCE)
    schema = pa.schema([("digest", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        name, tile, last = None, None, None
        for batch in slices(batches, "text"):
            columns = [batch.column(c).to_pylist() for c in ("tile", "within", "streams", "copies", "mask", "digest", "text")]
            for at, within, streams, copies, mask, digest, text in zip(*columns, strict=True):
                if at != name:
                    if tile and (out := tile.rows(schema)) is not None:
                        yield out
                    name, tile, last = at, _Tile(mask, within, threshold, table), None
                if digest == last:  # a repeated row
                    continue
                last = digest
                if len(known) > KNOWN_WORDS:
                    known.clear()
                tile.add(digest, copies, streams, ngrams(text, known, n))
        if tile and (out := tile.rows(schema)) is not None:
            yield out

    return tiled.mapInArrow(run, "digest binary, links long, root binary")


def _sketched(docs: DataFrame, n: int) -> DataFrame:
    """(id, digest, grams, bands) of rows (id, digest, text); bands is null without words."""
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("grams", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in slices(batches, "text"):
            sizes, bands = [], []
            for text in batch.column("text").to_pylist():
                if len(known) > KNOWN_WORDS:
                    known.clear()
                grams = ngrams(text or "", known, n)
                sizes.append(len(grams))
                if not len(grams):
                    bands.append(None)
                    continue
                values = minhash(grams).reshape(BANDS, ROWS).astype(np.uint64)
                key = np.zeros(BANDS, np.uint64)
                for k in range(ROWS):
                    key = _mixed(key * _PRIME + values[:, k])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(run, "id long, digest binary, grams long, bands array<long>")


def _shared_buckets(texts: DataFrame) -> DataFrame:
    """(band, bucket, short) of the texts of each bucket of several, with the bucket's number of texts and n-grams and its fingerprint
    (least, x, y). Every bucket of every text is shuffled here and only here, before its hashes for the fingerprint are made."""
    bucket = Window.partitionBy("band", "bucket")
    return (
        texts.select("short", "grams", F.posexplode("bands").alias("band", "bucket"))
        .repartition("band", "bucket")
        .select("band", "bucket", "short", F.count("*").over(bucket).alias("n"), F.sum("grams").over(bucket).alias("all_grams"), F.min("short").over(bucket).alias("least"), *(F.bit_xor(h).over(bucket).alias(c) for c, h in (("x", F.xxhash64("short")), ("y", F.xxhash64("short", F.lit(1))))))
        .where("n > 1")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each id of edges (a, b) hangs together with.

    Labels sink to the smallest label of a neighbour and then to the label of the label, so long chains
    shorten by doubling. Each round is written to the shared folder.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).select(F.col("a").alias("id"), "root"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("id")).agg(F.min("r").alias("r"))
        sunk = labels.join(near, "id").select("id", F.least("root", "r").alias("to"), F.col("root").alias("was"))
        jumps = labels.select(F.col("id").alias("to"), F.col("root").alias("further"))
        lower = cut(sunk.join(jumps, "to").select("id", F.least("to", "further").alias("root"), "was"), "labels")
        changed = lower.where("root <> was").limit(1).count()
        labels = lower.select("id", "root")
        if not changed:
            return labels


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """As ``join``, with ``digest`` (words_digest of the row's text) and ``root``, that of the text that its class is named by: two rows are in
    one class if their roots are equal. root is null without words or key."""
    spark = bound_batches(docs.sparkSession, size="4m")
    named = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = cut(_sketched(named.select("id", words_digest(F.col("text")).alias("digest"), "text"), n), "sketches")
    texts = cut(
        sketched.where("bands is not null").groupBy("digest").agg(F.min(F.struct("id", "grams", "bands")).alias("x"), F.count("*").alias("copies")).select("digest", F.xxhash64("digest").alias("short"), "x.*", "copies"),
        "texts",
    )
    # short names a text until it meets its digest again; two texts of one name are only compared more often
    shared = cut(_shared_buckets(texts), "buckets")
    lists = (
        shared.groupBy("n", "all_grams", "least", "x", "y")
        .agg(F.min(F.struct("band", "bucket")).alias("at"), F.expr("bit_or(shiftleft(1L, band))").alias("mask"))
        .select("n", "all_grams", "mask", "at.band", "at.bucket")
    )
    blocks = F.greatest(F.ceil(F.col("n") / block), F.least("n", F.ceil(F.col("all_grams") / block_grams))).cast("int")
    members = shared.select("band", "bucket", "short").join(lists, ["band", "bucket"]).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("short", F.lit(2)), F.col("blocks")).cast("int"))
    tiled = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws(":", "band", "bucket", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        "mask",
        "short",
        (F.col("own") == F.col("other")).alias("within"),
        (F.col("own") > F.col("other")).alias("streams"),
    )
    # each text is shuffled once by its key, where repeated rows become one, and then once for each of its tiles
    once = named.groupBy("id", words_digest(F.col("text")).alias("digest")).agg(F.first("text").alias("text"))
    known = tiled.join(texts.select("short", "id", "digest", "copies"), "short").join(once, ["id", "digest"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = known.select("tile", "within", "mask", "streams", "copies", "digest", "text").repartition(parts, "tile").sortWithinPartitions("tile", "streams", "digest")
    found = cut(_tiles(met, n, threshold), "links")
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    rooted = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "digest")
    least = rooted.join(texts.select("digest", "id"), "digest").groupBy("root").agg(F.min("id").alias("class_id"))
    per_text = (
        texts.select("digest", F.col("id").alias("text_id"), "copies")
        .join(links, "digest", "left")
        .join(rooted.join(least, "root"), "digest", "left")
        .select("digest", F.coalesce("root", "digest").alias("root"), F.coalesce("class_id", "text_id").alias("class_id"), "text_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    )
    return (
        sketched.select("id", "digest")
        .join(per_text, "digest", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("class_id", "id").alias("class_id"),
            F.coalesce("text_id", "id").alias("text_id"),
            F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
            F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
            "digest",
            "root",
        )
    )


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """A row a document: key, ``class_id`` (the smallest key of its class), ``text_id`` (the smallest key of equal
    words), ``n_copies`` (documents of equal words) and ``n_links`` (other documents that it links to, copies among them)."""
    out = classes(docs, key, text, n, threshold, block).drop("digest", "root")
    nothing = F.lit(None).cast("long")
    nameless = docs.where(F.col(key).isNull()).select(nothing.alias(key), nothing.alias("class_id"), nothing.alias("text_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(nameless)
