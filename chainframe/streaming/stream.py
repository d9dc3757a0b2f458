"""Consuming the events of a stream with commits: each micro-batch is one unit of work that a restart repeats whole.

Everything is keyed by the micro-batch: a batch writes its own folder and replaces what an interrupted run left there, and the
query's checkpoint moves on only after that. So nothing is lost or handed on twice, whatever stops between two steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainframe.operators import cdc
from chainframe.sources.stores import BatchStore


def resume_point(watermark_ranges: list[Row]) -> dict[str, tuple[int, str]]:
    """Where a source resumes: (block, hash) by network of the ranges of the last committed watermark."""
    return {r["network"]: (r["end"], r["hash"]) for r in watermark_ranges}


def for_each(events: DataFrame, handler: Callable[[DataFrame, int], None], progress: str, **trigger) -> StreamingQuery:
    """Calls handler with the events of each micro-batch and its number, and commits it; a handler that raises ends the query and leaves its
    batch uncommitted: a restart with the same progress folder hands it out again. trigger: as for writeStream.trigger."""
    return events.writeStream.foreachBatch(handler).option("checkpointLocation", progress).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def changes(rows: DataFrame, store: BatchStore, out: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes Insert and Delete changes to ``out`` (batch=n). rows: stream, seq and data of the data messages.

    Data is stored before its inserts are written. An undo deletes the stored rows of the transactions in its range that none deleted
    before, found by bins of ids. Watermarks prune the store. Undone and pruned transactions leave the store's live ones.
    """
    columns = [c for c in rows.columns if c not in ("stream", "seq")]

    def handle(events: DataFrame, batch: int) -> None:
        events = events.persist()
        inserted = events.where("tag = 'Data'").select("stream", "seq", "tx_id").join(rows, ["stream", "seq"]).select("stream", "tx_id", *columns)
        store.append(inserted, batch)
        held = store.load(upto=batch)
        ids = held.select("stream", "tx_id").distinct()
        undos = events.where("tag = 'Undo'").select("stream", F.col("tx_id").alias("r_id"), "undo_start", "undo_end")
        gone = store.gone(before=batch)
        undone = cdc.seek(ids, undos).groupBy("stream", "tx_id").agg(F.min("r_id").alias("r_id")).join(gone, ["stream", "tx_id"], "left_anti")
        store.forget(undone, batch)
        deleted = held.join(store.gone(before=batch + 1).where(F.col("batch") == batch).drop("batch"), ["stream", "tx_id"])
        change = inserted.select("stream", "tx_id", F.lit("insert").alias("change"), F.col("tx_id").alias("of_tx"), *columns)
        change.unionByName(deleted.select("stream", F.col("r_id").alias("tx_id"), F.lit("delete").alias("change"), F.col("tx_id").alias("of_tx"), *columns)).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        store.prune(events.where("prune is not null").groupBy("stream").agg(F.max("prune").alias("prune")), batch)
        events.unpersist()

    return handle
