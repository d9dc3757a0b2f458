"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts are cut into chunks of ``chunk_chars`` characters that overlap. A text of one chunk has no boundary to stitch and
is encoded where it is: what the steps below give for one chunk, without its shuffle. Of longer ones, each chunk is pre-tokenised on its own task, neighbours are stitched at the first
position in their overlap where both have a pre-token boundary, and the pieces between those positions
are encoded in parallel. A chunk without such a position (a run longer than the overlap) is joined, with
all that follows it, to the piece before, so the result never depends on the chunking. Decoding
concatenates the bytes of the ids.

Null texts count as empty. Repeated rows, repeated or null keys and further columns are kept as they
are (a column named like a result, ``ids`` or ``decoded``, is replaced); an empty table gives an empty result. Texts of several chunks are
worked on once per distinct text, and their memory is that of a chunk but where the ids come together.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.common import bound_batches, others, slices

CHUNK_CHARS, OVERLAP_CHARS = 65_536, 1_024
#: A boundary this near the cut end of a chunk may move when more text is seen: contractions look at three characters.
LOOKAHEAD = 3
#: A single space between two visible characters always starts a pre-token, whatever stands before.
_UNSAFE_SPACE = re.compile(r"\s\x20|\x20\s|^\x20|\x20$")
_SAFE_SPACE = re.compile(r"(?<=\S)\x20(?=\S)")
_CACHE_ENTRIES, _SHORT_UNIT = 100_000, 64


@functools.lru_cache(4)
def _ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


@functools.lru_cache(4)
def _tokens(data: bytes) -> pa.Array:
    """The bytes of each id, null where there is none."""
    by_id = {rank: token for token, rank in _ranks(data).items()}
    return pa.array(map(by_id.get, range(max(by_id) + 1)), pa.binary())


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged until none is left, the leftmost first among equals."""
    if piece in ranks:
        return [ranks[piece]]
    end = len(piece)
    after = list(range(1, end + 1))  # by the start of a part: where it ends
    before = list(range(-1, end))  # where the part before it starts
    heap = [(ranks[pair], i, i + 2) for i in range(end - 1) if (pair := piece[i : i + 2]) in ranks]
    heapq.heapify(heap)
    gone = bytearray(end + 1)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= end or after[j] != stop:
            continue
        gone[j] = 1
        after[i] = stop
        before[stop] = i
        if stop < end and (rank := ranks.get(piece[i : after[stop]])) is not None:
            heapq.heappush(heap, (rank, i, after[stop]))
        if i > 0 and (rank := ranks.get(piece[before[i] : stop])) is not None:
            heapq.heappush(heap, (rank, before[i], stop))
    ids, i = [], 0
    while i < end:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class _Known(dict):
    """Ids of short units, as 32-bit numbers in bytes, found when first asked for."""

    def __init__(self, find: Callable[[str], list[int]], lead: str):
        super().__init__()
        self.find, self.lead = find, lead

    def __missing__(self, part: str) -> bytes:
        ids = array("i", self.find(self.lead + part)).tobytes()
        if len(part) <= _SHORT_UNIT:
            if len(self) >= _CACHE_ENTRIES:
                self.clear()
            self[part] = ids
        return ids


class _Encoder:
    """Encodes pieces that start and end at pre-token boundaries; keeps what it found for frequent units.

    Short units go to tiktoken; long ones, on which its merging takes quadratic time, to ``merge``.
    """

    def __init__(self, data: bytes, pattern: str):
        self.ranks, self.find = _ranks(data), regex.compile(pattern).findall
        self.short = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary
        self.first, self.spaced = _Known(self.unit, ""), _Known(self.unit, " ")

    def unit(self, text: str) -> list[int]:
        if len(text) > _SHORT_UNIT:
            return [i for piece in self.find(text) for i in merge(piece.encode(), self.ranks)]
        return self.short(text)

    def packed(self, text: str) -> bytes:
        """The ids as 32-bit numbers in bytes."""
        if not text:
            return b""
        parts = _SAFE_SPACE.split(text) if _UNSAFE_SPACE.search(text) else text.split(" ")
        return self.first[parts[0]] + b"".join(map(self.spaced.__getitem__, parts[1:]))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()


def _encode_column(df: DataFrame, column: str, data, pattern: str) -> DataFrame:
    """Replaces a text column by its ids."""
    keep = [c for c in df.columns if c != column]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        encoder = _Encoder(data.value, pattern)
        for batch in slices(batches, column):
            packed = [encoder.packed(t or "") for t in batch.column(column).to_pylist()]
            stops = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(stops), pa.Array.from_buffers(pa.int32(), int(stops[-1]), [None, pa.py_buffer(b"".join(packed))]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], names=[*keep, "ids"])

    return df.select(*keep, column).mapInArrow(run, schema)


def _boundaries(df: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Pre-tokenises chunks; head and tail: pre-token starts in the overlap with the chunk before and the one after."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.ArrayType(T.LongType()), False) for c in ("head", "tail"))])

    def run(batches):
        find = regex.compile(pattern).finditer
        for batch in batches:
            heads, tails = [], []
            for k, text, last in zip(*(batch.column(c).to_pylist() for c in ("chunk", "slice", "last")), strict=True):
                starts = [m.start() for m in find(text)]
                trusted = len(text) if last else len(text) - LOOKAHEAD
                starts = [p + k * chunk for p in starts if p <= trusted]
                heads.append([p for p in starts if p - k * chunk <= overlap])
                tails.append([p for p in starts if p >= (k + 1) * chunk])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, kind), pa.array(tails, kind)], names=[*batch.schema.names, "head", "tail"])

    return df.mapInArrow(run, schema)


def _pieces(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(text_key, start, piece) of distinct long texts: pieces that may be encoded apart."""
    chunks = (
        long.select("text_key", "text", F.length("text").alias("n"))
        .select("text_key", "text", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / chunk))).alias("chunk"))
        .select("text_key", "chunk", F.expr(f"substring(text, cast(chunk * {chunk} + 1 as int), {chunk + overlap})").alias("slice"), (F.col("n") <= F.col("chunk") * chunk + chunk + overlap).alias("last"))
    )
    spread = chunks.repartition("text_key", "chunk")
    order = Window.partitionBy("text_key").orderBy("chunk")
    stitched = (
        _boundaries(spread, pattern, chunk, overlap)
        .withColumn("start", F.when(F.col("chunk") == 0, 0).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(order)))).cast("long"))
        .withColumn("lost", F.max(F.col("start").isNull()).over(order))  # from the first chunk without a common boundary on
        .withColumn("stop", F.lead("start").over(order))
        .withColumn("joins", F.coalesce(F.lead("lost").over(order), F.lit(False)))
        .where(~F.col("lost"))
    )
    inner = stitched.where(~F.col("joins")).select("text_key", "start", F.expr(f"substring(slice, cast(start - chunk * {chunk} + 1 as int), cast(coalesce(stop - start, length(slice)) as int))").alias("piece"))
    rest = stitched.where("joins").select("text_key", "start").join(long.select("text_key", "text"), "text_key").select("text_key", "start", F.expr("substring(text, cast(start + 1 as int))").alias("piece"))
    return inner.unionByName(rest)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """docs without its text column, with ``ids``, an array of token ids.

    vocabulary: path of a rank file (base64 token and rank a line), read by the driver; its size is that
    of the vocabulary, not of the data. pattern: the pre-tokenisation pattern.
    """
    spark = bound_batches(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    keep = others(docs, text, "ids")
    rows = docs.select((F.struct(*keep) if keep else F.struct(F.lit(0).alias("none"))).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = _encode_column(rows.where(F.length("text") <= chunk_chars), "text", data, pattern)
    keyed = rows.where(F.length("text") > chunk_chars).withColumn("text_key", F.sha2("text", 256))
    # distinct long texts: equal copies meet before the shuffle and are chunked once
    long = keyed.groupBy("text_key").agg(F.first("text").alias("text"))
    pieces = _encode_column(_pieces(long, pattern, chunk_chars, overlap_chars).repartition("text_key", "start"), "piece", data, pattern)
    whole = pieces.groupBy("text_key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "ids"))), lambda x: x["ids"])).alias("ids"))
    joined = keyed.select("row", "text_key").join(whole, "text_key").select("row", "ids")
    return short.unionByName(joined).select(*([F.col("row.*")] if keep else []), "ids")


def _bytes_of(ids: pa.Array, token: pa.Array) -> pa.Array:
    """The bytes of each list of ids: those of its tokens, which already lie one after the other."""
    taken = token.take(ids.flatten())
    if taken.null_count:
        raise ValueError("an id is no token of the vocabulary")
    stops = np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)])
    bounds = np.concatenate([[0], np.cumsum(pc.binary_length(taken).to_numpy(zero_copy_only=False), dtype=np.int64)])
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(bounds[stops].astype(np.int32)), taken.buffers()[2] or pa.py_buffer(b"")])


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for, as binary (null ids: empty). An id that is no token is an error."""
    with open(vocabulary, "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())
    df = df.select(*others(df, out))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType(), False)])

    def run(batches):
        token = _tokens(data.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _bytes_of(batch.column(ids), token)], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)
