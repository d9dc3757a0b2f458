"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.sources.shared import cut, new_path, shared_dir

__all__ = ["ASCII_SPACE", "WORD_RE", "bound_batches", "cut", "new_path", "others", "row_hashes", "shared_dir", "slices", "word_count", "words_digest"]

#: White space of the word contracts: space and the five ASCII control spaces.
ASCII_SPACE = "\x20\t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"


def bound_batches(spark: SparkSession, rows: int = 2_000, size: str = "8m") -> SparkSession:
    """Bounds the Arrow batches that Python workers get, so that their memory follows neither the
    length of texts nor a row count meant for narrow rows. A smaller setting of the session stays. Only memory hangs on it:
    no operator's result depends on where batches end."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(rows, int(spark.conf.get(key)))))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark


def word_count(text) -> F.Column:
    """Words of a text as the contracts define them (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def words_digest(text) -> Column:
    """128 bits that tell texts apart by their words (null: as without words)."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.md5(F.trim(spaced)))


def others(df: DataFrame, *taken: str) -> list[str]:
    """The columns of df whose names, in any case, are none of those taken."""
    lower = {name.lower() for name in taken}
    return [c for c in df.columns if c.lower() not in lower]


def row_hashes(df: DataFrame, columns: list[str]) -> list[Column]:
    """128 bits, as two numbers, of the values of columns. Equal rows are told apart by nothing."""
    plain = [F.to_json(F.struct(F.col(c))) if "map<" in df.schema[c].dataType.simpleString() else F.col(c) for c in sorted(columns)]
    nulls = F.concat_ws("", *(F.col(c).isNull().cast("string") for c in sorted(columns)))  # a null leaves a hash as it was
    return [F.xxhash64(F.lit(seed), nulls, *plain) for seed in (1, 2)]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20, rows: int = 1_024) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose texts hold at most so many bytes (a longer text is a part of its own). Workers serve one
    operator after the other, so at the end what the parts took is given back."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right"))
            stop = min(max(stop, at + 1), at + rows)
            yield batch.slice(at, stop - at)
            at = min(stop, batch.num_rows)
    pa.default_memory_pool().release_unused()
