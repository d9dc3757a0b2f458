"""Block-range feeds: one row a network of each message, as a DataFrame or a stream.

Columns: stream, seq (order within the stream), ranges_complete, network, start_block, end_block, hash, prev_hash.
A stream is the unit of order; everything else partitions freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZERO_HASH = "0x" + "0" * 64
HASH_RE = "^0x[a-z0-9]{64}"
RANGE = "struct<network:string,numbers:struct<start:bigint,end:bigint>,hash:string,prev_hash:string>"
METADATA = f"struct<ranges:array<{RANGE}>,ranges_complete:boolean>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hash(*parts: Column) -> Column:
    return F.concat(F.lit("0x"), F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256))


def synthetic_feed(events: DataFrame, stream: str = "events") -> DataFrame:
    """A valid feed over the ids of events: 20 events a batch, 10 blocks, two networks; kinds 0 data, 1 watermark,
    2 reorg on eth (after every 7th batch, two batches deep after every 21st), 3 watermark of the new branch."""
    b = events.select(F.floor(F.col("event_id") / 20).cast("long").alias("b")).distinct()
    reorg = F.col("b") % 7 == 6
    kinds = F.when(reorg, F.array(*map(F.lit, range(4)))).otherwise(F.array(F.lit(0), F.lit(1)))
    depth = F.when((F.col("kind") >= 2) & (F.col("b") % 21 == 20), 2).otherwise(1)
    rows = (
        b.withColumn("kind", F.explode(kinds))
        .withColumn("network", F.explode(F.array(F.lit("eth"), F.lit("polygon"))))
        .withColumn("redone", (F.col("network") == "eth") & (F.col("kind") >= 2))
        .withColumn("start_block", F.when(F.col("redone"), (F.col("b") - depth + 1) * 10).otherwise(F.col("b") * 10))
        .withColumn("end_block", F.col("b") * 10 + 9)
    )
    before = F.when((F.col("network") == "eth") & (F.col("kind") < 2) & ((F.floor(F.col("start_block") / 10) - 1) % 7 == 6), 1).otherwise(0)
    return rows.select(
        F.lit(stream).alias("stream"),
        (F.col("b") * 4 + F.col("kind")).cast("long").alias("seq"),
        F.col("kind").isin(1, 3).alias("ranges_complete"),
        "network",
        F.col("start_block").cast("long").alias("start_block"),
        F.col("end_block").cast("long").alias("end_block"),
        _hash(F.col("network"), F.col("end_block"), F.col("redone").cast("int")).alias("hash"),
        F.when(F.col("start_block") > 0, _hash(F.col("network"), F.col("start_block") - 1, before)).alias("prev_hash"),
    )


def from_metadata(batches: DataFrame, metadata: str = "app_metadata") -> DataFrame:
    """Decodes the JSON metadata of record batches (columns stream, seq, n_rows and the metadata) into feed rows, with ``ordinal``.

    Networks are lower-cased. A null prev_hash and an absent one are the same.
    """
    decoded = batches.withColumn("_m", F.from_json(F.col(metadata).cast("string"), METADATA))
    exploded = decoded.select(*[c for c in batches.columns if c != metadata], F.col("_m.ranges_complete").alias("ranges_complete"), F.posexplode("_m.ranges").alias("ordinal", "r"))
    return exploded.select("*", F.lower("r.network").alias("network"), F.col("r.numbers.start").alias("start_block"), F.col("r.numbers.end").alias("end_block"), F.col("r.hash").alias("hash"), F.col("r.prev_hash").alias("prev_hash")).drop("r")


def to_metadata(feed: DataFrame) -> DataFrame:
    """The JSON metadata of each message of a feed: stream, seq, app_metadata."""
    one = F.struct("network", F.struct(F.col("start_block").alias("start"), F.col("end_block").alias("end")).alias("numbers"), "hash", "prev_hash")
    return feed.groupBy("stream", "seq").agg(F.to_json(F.struct(F.array_sort(F.collect_list(one)).alias("ranges"), F.bool_and("ranges_complete").alias("ranges_complete"))).alias("app_metadata"))


def resume_cursor(feed: DataFrame) -> DataFrame:
    """The last range of each network: where a restarted reader resumes."""
    return feed.groupBy("stream", "network").agg(F.max_by(F.struct("end_block", "hash"), "seq").alias("x")).select("stream", "network", F.col("x.end_block").alias("number"), F.col("x.hash").alias("hash"))


def extracted(rows: DataFrame, block: str = "block_num", start_block: int | None = None, finalized: DataFrame | None = None) -> DataFrame:
    """The rows of a raw dataset from a start block on and, with finalized (network, finalized_block), up to the finalized block of their
    network; networks without one have no finalized rows. The start is a plain filter, so it reaches the scan."""
    rows = rows if start_block is None else rows.where(F.col(block) >= start_block)
    if finalized is None:
        return rows
    return rows.join(finalized.select("network", "finalized_block"), "network").where(F.col(block) <= F.col("finalized_block")).select(rows.columns)


def event_rows(events: DataFrame) -> DataFrame:
    """The rows of data messages: b (batch), network, block_num, event_id, value."""
    return events.select(
        F.floor(F.col("event_id") / 20).cast("long").alias("b"),
        F.when(F.col("user_id") % 2 == 0, "eth").otherwise("polygon").alias("network"),
        F.floor(F.col("event_id") / 2).cast("long").alias("block_num"),
        "event_id",
        "event_type",
        "value",
    )


def registry(documents: DataFrame) -> DataFrame:
    """A dataset registry derived from documents."""
    d = F.col("doc_id")
    text = lambda c: c.cast("string")
    return documents.select(
        d.cast("long").alias("ds_id"),
        F.concat(F.lit("org_"), text(d % 17)).alias("namespace"),
        F.concat(F.lit("ds_"), text(d)).alias("name"),
        F.concat(F.lit("owner_"), text(d % 11)).alias("owner"),
        F.array_compact(F.array("lang", F.when(d % 3 == 0, "mainnet"))).alias("indexing_chains"),
        F.array_compact(F.array("source", F.when(d % 5 == 0, "defi"))).alias("keywords"),
        F.element_at(F.array(*map(F.lit, ("draft", "published", "deprecated", "archived"))), (d % 4 + 1).cast("int")).alias("status"),
        F.when(d % 6 == 0, "private").otherwise("public").alias("visibility"),
        (d % 400).cast("long").alias("age_days"),
        F.concat(text(d % 3), F.lit("."), text(d % 12), F.lit("."), text(d % 7), F.when(d % 10 == 0, "-dev1").otherwise("")).alias("version_tag"),
    )
