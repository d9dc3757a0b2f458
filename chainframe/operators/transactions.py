"""The transactional layer over whole feeds: ids, undo ranges, recovery and pruning points as joins and windows.

Valid for streams in which every message carries every network, ranges are contiguous for each network, and events are
committed at once; chainframe.streaming keeps the general state machine. Watermarks may be as rare as they like. Joins of watermarks
with reorganisations go by network and block bin, so their cost follows the depth of reorganisations and the length of the feed.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainframe.operators import protocol
from chainframe.operators.ordered import running
from chainframe.sources.shared import cut

RETENTION = 128


def tx_ids(feed: DataFrame, invalidated: DataFrame | None = None, placed: DataFrame | None = None) -> DataFrame:
    """Messages with ``tx_id``: their place in the stream, from 0. invalidated, placed: as for protocol.classify and with_previous."""
    placed = placed or protocol.places(feed)
    found = protocol.classify(feed, invalidated=invalidated or protocol.reorgs(feed, placed))
    return found.join(placed.select("stream", "seq", F.col("place").alias("tx_id")), ["stream", "seq"])


class Marks:
    """The watermarks and reorganisations of a feed, by transaction id.

    What several results share (the feed, its messages, the fate of its watermarks) is written once to the shared folder.
    """

    def __init__(self, feed: DataFrame, retention: int = RETENTION):
        self.retention = retention
        feed = cut(feed, "feed")
        placed, self.first = protocol.places(feed), protocol.place_in_message(feed)
        invalidated = cut(protocol.reorgs(feed, placed), "reorgs")
        self.events = ids = cut(tx_ids(feed, invalidated, placed), "messages")
        self.watermarks = ids.where("tag = 'Watermark'").select("stream", "seq", F.col("tx_id").alias("w_id")).join(feed, ["stream", "seq"]).select("stream", "w_id", "network", self.first.alias("first"), "start_block", "end_block")
        self.points = ids.where("tag = 'Reorg'").select("stream", "seq", F.col("tx_id").alias("r_id")).join(invalidated, ["stream", "seq"]).select("stream", "r_id", "network", "inv_start", "inv_end")
        # one bin holds any retention window's edge and any range
        span = feed.agg(F.max(F.col("end_block") - F.col("start_block") + 1)).first()[0] or 1
        self.bin = max(retention, span, 1)

    def killed(self) -> DataFrame:
        """stream, w_id, killed_by: the first reorganisation after a watermark that starts at or before it on some network."""
        bins = F.sequence(F.floor(F.col("inv_start") / self.bin), F.floor(F.col("inv_end") / self.bin))
        p = self.points.withColumn("bin", F.explode(bins))
        w = self.watermarks.withColumn("bin", F.floor(F.col("start_block") / self.bin))
        met = w.join(p, ["stream", "network", "bin"]).where("r_id > w_id and start_block >= inv_start")
        return met.groupBy("stream", "w_id").agg(F.min("r_id").alias("killed_by"))

    @functools.cached_property
    def alive(self) -> DataFrame:
        """The watermarks with killed_by (null: never)."""
        return cut(self.watermarks.join(self.killed(), ["stream", "w_id"], "left"), "watermarks")

    @functools.cached_property
    def below(self) -> DataFrame:
        """stream, id, below: the newest surviving watermark before each watermark, and after each reorganisation (null: none).

        Starts of surviving watermarks ascend, so a reorganisation takes the newest ones and watermarks are a stack: what
        lies at a level is the last watermark that was put there.
        """
        w = self.alive.select("stream", "w_id", "killed_by").distinct()
        moves = w.select("stream", F.col("w_id").alias("id"), F.lit(1).alias("step"), F.lit(True).alias("put"))
        moves = moves.unionByName(w.where("killed_by is not null").select("stream", F.col("killed_by").alias("id"), F.lit(-1).alias("step"), F.lit(False).alias("put")))
        moves = moves.unionByName(self.points.select("stream", F.col("r_id").alias("id"), F.lit(0).alias("step"), F.lit(False).alias("put")))
        each = moves.groupBy("stream", "id").agg(F.sum("step").alias("step"), F.max("put").alias("put"))
        each = running(each, "stream", "id", "stack", height=("sum", F.col("step"), True))
        put = each.where("put").select("stream", "id", F.col("height").alias("level"), F.col("id").alias("mark"))
        ask = each.select("stream", "id", F.when(F.col("put"), F.col("height") - 1).otherwise(F.col("height")).alias("level"), F.lit(None).cast("long").alias("mark"))
        last = F.last("mark", ignorenulls=True).over(Window.partitionBy("stream", "level").orderBy("id"))
        return cut(put.unionByName(ask).withColumn("below", last).where("mark is null").select("stream", "id", "below"), "below")

    def prunes(self) -> DataFrame:
        """stream, w_id, prune: the last watermark that lies behind the retention window of w on every network, if that moves on."""
        cutoff = F.greatest(F.lit(0), F.col("start_block") - self.retention)
        w = self.watermarks.select("stream", "w_id", "network", cutoff.alias("cutoff")).where("cutoff > 0").withColumn("bin", F.floor(F.col("cutoff") / self.bin))
        # a watermark and the next one above it hold the cutoffs between their ends; all blocks between have messages, so bins are as few as those
        v = self.watermarks.select("stream", "network", F.col("w_id").alias("v_id"), F.col("end_block").alias("v_end"))
        c = self.alive.join(self.below.where("below is not null").select("stream", F.col("id").alias("w_id"), F.col("below").alias("v_id")), ["stream", "w_id"])
        c = c.select("stream", "network", "v_id", F.col("w_id").alias("c_id"), F.col("end_block").alias("c_end"), "killed_by").join(v, ["stream", "network", "v_id"]).where("v_end < c_end")
        c = c.withColumn("bin", F.explode(F.sequence(F.floor((F.col("v_end") + 1) / self.bin), F.floor(F.col("c_end") / self.bin))))
        met = w.join(c, ["stream", "network", "bin"]).where("c_id <= w_id and v_end < cutoff and cutoff <= c_end and (killed_by is null or killed_by > w_id)")
        newest = met.groupBy("stream", "w_id", "network").agg(F.max("v_id").alias("v_id"))
        n = self.watermarks.groupBy("stream", "w_id").agg(F.count("*").alias("n"))
        every = newest.groupBy("stream", "w_id").agg(F.min("v_id").alias("prune"), F.count("*").alias("k")).join(n, ["stream", "w_id"]).where("k = n")
        every = running(every.select("stream", "w_id", "prune"), "stream", "w_id", "prunes", before=("max", F.col("prune"), False))
        return every.where("before is null or prune > before").select("stream", "w_id", "prune")

    def recoveries(self) -> DataFrame:
        """stream, r_id, recovery, floor: the newest watermark before a reorganisation that none killed so far and none pruned (null: none left)."""
        first = self.points.select("stream", "r_id").distinct()
        marks = self.prunes().select("stream", F.col("w_id").alias("id"), F.lit(0).alias("kind"), "prune")
        floors = marks.unionByName(first.select("stream", F.col("r_id").alias("id"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("prune")))
        # ids are of one message each, so no watermark has that of a reorganisation
        floors = running(floors, "stream", "id", "floors", floor=("max", F.col("prune"), False)).where("kind = 1").select("stream", F.col("id").alias("r_id"), "floor")
        # pruning takes the oldest, so if it took the newest that is left it took all
        left = self.below.select("stream", F.col("id").alias("r_id"), "below")
        recovery = F.when(F.col("floor").isNull() | (F.col("below") > F.col("floor")), F.col("below"))
        return floors.join(left, ["stream", "r_id"], "left").select("stream", "r_id", recovery.alias("recovery"), "floor")

    def undos(self) -> DataFrame:
        """stream, r_id, undo_start, undo_end."""
        start = F.coalesce(F.col("recovery") + 1, F.lit(0).cast("long"))
        return self.recoveries().select("stream", "r_id", start.alias("undo_start"), F.greatest(start, F.col("r_id") - 1).alias("undo_end"))

    def partial(self) -> DataFrame:
        """stream, r_id, network: reorganisations that start inside their recovery watermark's range, which cannot be undone."""
        met = self.recoveries().join(self.watermarks.withColumnRenamed("w_id", "recovery"), ["stream", "recovery"]).join(self.points, ["stream", "r_id", "network"])
        return met.where("start_block < inv_start and inv_start <= end_block").groupBy("stream", "r_id").agg(F.min_by("network", "first").alias("network"))

    def commits(self) -> DataFrame:
        """stream, w_id: watermarks left in the store at the end, inserts less what reorganisations and pruning took."""
        last = self.prunes().groupBy("stream").agg(F.max("prune").alias("cut"))
        w = self.alive.where("killed_by is null").select("stream", "w_id").distinct()
        return w.join(last, "stream", "left").where("cut is null or w_id > cut").select("stream", "w_id")

    def rewinds(self, upto: int) -> DataFrame:
        """stream, undo_start, undo_end of a restart after the events with tx_id < upto (no row: nothing to undo)."""
        done = self.events.where(F.col("tx_id") < upto)
        last = done.groupBy("stream").agg((F.max("tx_id") + 1).alias("next"))
        kept = self.alive.where((F.col("w_id") < upto) & (F.col("killed_by").isNull() | (F.col("killed_by") >= upto))).groupBy("stream").agg(F.max("w_id").alias("w"))
        start = F.coalesce(F.col("w") + 1, F.lit(0).cast("long"))
        return last.join(kept, "stream", "left").where(F.col("next") > start).select("stream", start.alias("undo_start"), (F.col("next") - 1).alias("undo_end"))
