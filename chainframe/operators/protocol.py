"""The protocol layer: validation of hash chains, reorganisations, and messages.

Previous state is that of the message before. Which one that is comes from running maxima over ranges of the order, and its ranges
from a join by stream, message and network: so the messages of a single stream run in parallel too. Of several networks of a
message, the first is that of the smallest ``ordinal`` where the feed has one (their order in the message), else of the smallest name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.operators.ordered import running
from chainframe.sources.feed import ZERO_HASH
from chainframe.sources.shared import cut


#: Ranges of the order that messages are dealt out by, with their stream.
RANGES = 64


def is_zero(h: Column) -> Column:
    return h == ZERO_HASH


def prev_hash_error() -> Column:
    """The first block has no parent; every other one names it."""
    none = F.col("prev_hash").isNull() | is_zero(F.col("prev_hash"))
    return F.when((F.col("start_block") == 0) & ~none, "InvalidPrevHashError").when((F.col("start_block") > 0) & none, "MissingPrevHashError")


def overlaps(a: str, b: str) -> Column:
    """Whether range b lies in what range a invalidates (same network, inclusive ends)."""
    return (F.col(f"{a}.network") == F.col(f"{b}.network")) & (F.col(f"{b}.end_block") >= F.col(f"{a}.start_block")) & (F.col(f"{a}.end_block") >= F.col(f"{b}.start_block"))


def places(feed: DataFrame) -> DataFrame:
    """stream, seq, place (from 0), before (the seq of the message before, null: none) of each message, in the shared folder."""
    messages = feed.select("stream", "seq").distinct()
    ran = running(messages, "stream", "seq", "messages", place=("sum", F.lit(1).cast("long"), False), before=("max", F.col("seq"), False))
    return cut(ran.withColumn("place", F.coalesce("place", F.lit(0))), "places")


def place_in_message(feed: DataFrame, prefix: str = "") -> Column:
    """What orders the networks of a message."""
    return F.col(prefix + ("ordinal" if "ordinal" in feed.columns else "network"))


def paired(feed: DataFrame) -> DataFrame:
    """A row a message: stream, seq, ranges (its rows of the feed), before and previous (the seq and ranges of the message before, null: none).

    The feed is shuffled once, by stream and range of seq; what is last in a range is carried to the next one of the stream. Ranges hold
    equal shares of the rows of all streams, so a large stream lies in many of them.
    """
    named = feed.where("stream is not null and seq is not null")
    bounds = named.agg(F.percentile_approx("seq", [k / RANGES for k in range(1, RANGES)])).first()[0]
    at = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b < F.col("seq"))) if bounds else F.lit(0)
    dealt = named.withColumn("_range", at).repartition("stream", "_range")
    whole = dealt.groupBy("stream", "_range", "seq").agg(F.collect_list(F.struct(*(c for c in feed.columns if c not in ("stream", "seq")))).alias("ranges"))
    order = Window.partitionBy("stream", "_range").orderBy("seq")
    near = whole.select("*", F.lag("seq").over(order).alias("before"), F.lag("ranges").over(order).alias("previous"), F.lead("seq").over(order).alias("_next"))
    carried = Window.partitionBy("stream").orderBy("_range")
    ends = near.where("_next is null").select("stream", "_range", F.lag("seq").over(carried).alias("_seq"), F.lag("ranges").over(carried).alias("_ranges"))
    previous = F.when(F.col("before").isNull(), F.col("_ranges")).otherwise(F.col("previous"))
    return near.join(ends, ["stream", "_range"], "left").select("stream", "seq", "ranges", F.coalesce("before", "_seq").alias("before"), previous.alias("previous"))


def with_previous(feed: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """Adds p_start, p_end, p_hash, p_prev: the range of the same network in the message before (null: none). placed: the places of the
    feed, where they are at hand."""
    ranges = feed.groupBy(F.col("stream"), F.col("seq").alias("before"), F.col("network")).agg(F.max(F.struct("start_block", "end_block", "hash", "prev_hash")).alias("_p"))
    known = feed.join((placed or places(feed)).select("stream", "seq", "before"), ["stream", "seq"])
    return known.join(ranges, ["stream", "before", "network"], "left").select(
        *feed.columns, "before", F.col("_p.start_block").alias("p_start"), F.col("_p.end_block").alias("p_end"), F.col("_p.hash").alias("p_hash"), F.col("_p.prev_hash").alias("p_prev")
    )


def _same() -> Column:
    return (F.col("start_block") == F.col("p_start")) & (F.col("end_block") == F.col("p_end")) & F.col("hash").eqNullSafe(F.col("p_hash")) & F.col("prev_hash").eqNullSafe(F.col("p_prev"))


def consecutiveness_error() -> Column:
    """Over with_previous: a range follows the one before it, repeats it, or jumps back onto another parent."""
    next_block = F.col("p_end") + 1
    linked = F.col("prev_hash").eqNullSafe(F.col("p_hash"))
    return (
        F.when(F.col("p_end").isNull() | _same(), F.lit(None).cast("string"))
        .when((F.col("start_block") == next_block) & ~linked, "HashMismatchOnConsecutiveBlocksError")
        .when((F.col("start_block") < next_block) & linked, "InvalidReorgError")
        .when(F.col("start_block") > next_block, "GapError")
    )


def _network_error() -> Column:
    """Over n ranges of a message, its networks and those of the message before (p)."""
    return (
        F.when(F.size("networks") < F.col("n"), "DuplicateNetworkError")
        .when(F.col("p").isNotNull() & (F.size("p") != F.size("networks")), "NetworkCountChangedError")
        .when(F.col("p").isNotNull() & (F.size(F.array_except("networks", "p")) > 0), "UnexpectedNetworkError")
    )


def network_errors(feed: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """stream, seq, error: repeated networks, another number of networks, an unknown network."""
    batches = feed.groupBy("stream", "seq").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("network")).alias("networks"))
    earlier = batches.select("stream", F.col("seq").alias("before"), F.col("networks").alias("p"))
    known = batches.join((placed or places(feed)).select("stream", "seq", "before"), ["stream", "seq"])
    return known.join(earlier, ["stream", "before"], "left").select("stream", "seq", _network_error().alias("error"))


def first_errors(feed: DataFrame) -> DataFrame:
    """stream, seq, error of the first message of each stream that fails: hashes, then networks, then order."""
    names = lambda ranges: F.array_distinct(F.array_compact(F.transform(ranges, lambda r: r["network"])))
    messages = paired(feed).select("stream", "seq", "ranges", "previous", F.size("ranges").alias("n"), names(F.col("ranges")).alias("networks"), names(F.col("previous")).alias("p"))
    ranges = messages.select("stream", "seq", "previous", _network_error().alias("e2"), F.explode("ranges").alias("r"))
    # of a network that the message before repeats, its largest range
    same = F.transform(F.filter("previous", lambda r: r["network"] == F.col("r.network")), lambda r: F.struct(*(r[c].alias(f"col{k}") for k, c in enumerate(("start_block", "end_block", "hash", "prev_hash"), 1))))
    known = ranges.select("stream", "seq", "e2", place_in_message(feed, "r.").alias("first"), *(f"r.{c}" for c in ("start_block", "end_block", "hash", "prev_hash")), F.array_max(same).alias("_p"))
    known = known.select("*", *(F.col("_p")[k].alias(p) for k, p in (("col1", "p_start"), ("col2", "p_end"), ("col3", "p_hash"), ("col4", "p_prev"))))
    failed = known.select("stream", "seq", "first", prev_hash_error().alias("e1"), "e2", consecutiveness_error().alias("e3")).where("coalesce(e1, e2, e3) is not null")
    first = lambda e: F.min_by(e, F.when(F.col(e).isNotNull(), F.col("first")))
    both = failed.groupBy("stream", "seq").agg(F.coalesce(first("e1"), F.max("e2"), first("e3")).alias("error"))
    return both.where("error is not null").groupBy("stream").agg(F.min(F.struct("seq", "error")).alias("x")).select("stream", "x.*")


def reorgs(feed: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """stream, seq, network, inv_start, inv_end: ranges that a message invalidates."""
    back = F.col("p_end").isNotNull() & ~_same() & (F.col("start_block") < F.col("p_end") + 1)
    return with_previous(feed, placed).where(back).select("stream", "seq", "network", F.col("start_block").alias("inv_start"), F.greatest("end_block", "p_end").alias("inv_end"))


def classify(feed: DataFrame, n_rows: Column | None = None, invalidated: DataFrame | None = None) -> DataFrame:
    """A row a message: stream, seq, tag, n_networks, inv_start, inv_end (the extent of what it invalidates).

    A message that invalidates anything is a Reorg, whatever rows it carries; a complete one without rows is
    a Watermark; any other is Data. n_rows: rows of a message (default: a complete message has none).
    invalidated: the reorgs of the feed, where they are at hand.
    """
    rows = F.when(F.col("ranges_complete"), 0).otherwise(1) if n_rows is None else n_rows
    messages = feed.groupBy("stream", "seq").agg(F.bool_and("ranges_complete").alias("complete"), F.max(rows).alias("n_rows"), F.count("*").alias("n_networks"))
    back = (reorgs(feed) if invalidated is None else invalidated).groupBy("stream", "seq").agg(F.min("inv_start").alias("inv_start"), F.max("inv_end").alias("inv_end"))
    tag = F.when(F.col("inv_start").isNotNull(), "Reorg").when(F.col("complete") & (F.col("n_rows") == 0), "Watermark").otherwise("Data")
    return messages.join(back, ["stream", "seq"], "left").select("stream", "seq", tag.alias("tag"), "n_networks", "inv_start", "inv_end")


#: Edits of a valid feed, one for each error; the name is the stream.
DEFECTS = ("duplicate_network", "network_dropped", "network_renamed", "prev_hash_missing", "prev_hash_zero", "prev_hash_on_first", "wrong_parent", "same_parent_back", "gap")


def defective_feeds(feed: DataFrame, at: int) -> DataFrame:
    """A stream for each defect: the feed with the message ``at`` (a data message) edited."""
    here, eth = F.col("seq") == at, F.col("network") == "eth"
    d = lambda name: F.col("stream") == name
    rows = feed.drop("stream").withColumn("stream", F.explode(F.array(*map(F.lit, DEFECTS)))).select("stream", *[c for c in feed.columns if c != "stream"])
    rows = rows.where(~(d("network_dropped") & here & ~eth)).where(~(d("gap") & (F.col("seq") < at) & (F.col("seq") >= at - 4)))
    other = F.when(d("duplicate_network") & here, "eth").when(d("network_renamed") & here & ~eth, "base").otherwise(F.col("network"))
    first = d("prev_hash_on_first") & (F.col("seq") == 0) & eth
    prev = (
        F.when((d("prev_hash_missing") & here & eth), F.lit(None).cast("string"))
        .when(d("prev_hash_zero") & here & eth, ZERO_HASH)
        .when(first | (d("wrong_parent") & here & eth), "0x" + "a" * 64)
        .otherwise(F.col("prev_hash"))
    )
    back = d("same_parent_back") & here & eth
    before = feed.where((F.col("seq") < at) & eth).agg(F.max(F.struct("seq", "hash"))["hash"].alias("_h"))
    return rows.crossJoin(F.broadcast(before)).select(
        "stream", "seq", "ranges_complete", other.alias("network"), F.when(back, F.col("start_block") - 5).otherwise(F.col("start_block")).alias("start_block"), "end_block", "hash", F.when(back, F.col("_h")).otherwise(prev).alias("prev_hash")
    )
