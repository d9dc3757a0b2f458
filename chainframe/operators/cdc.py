"""Change events: rows inserted by Data messages and deleted by undo ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.operators import joins
from chainframe.operators.transactions import Marks


def seek(batches: DataFrame, ranges: DataFrame, width: int = 64) -> DataFrame:
    """Ids of batches (stream, tx_id) inside id ranges (stream, r_id, undo_start, undo_end), by bins of ids."""
    return joins.within(batches, ranges, ["stream"], "tx_id", F.col("undo_start"), F.col("undo_end"), width).select("stream", "r_id", "tx_id")


def changes(marks: Marks, rows: DataFrame) -> DataFrame:
    """stream, tx_id (of the change), change, of_tx (of the rows), and the columns of rows.

    rows: stream, seq and data. Data messages insert their rows; an undo deletes those of each transaction in
    its range that is still there. Rows of the message that reveals a reorganisation are not carried, as
    in the stream itself.
    """
    data = marks.events.where("tag = 'Data'").select("stream", "seq", "tx_id")
    inserted = data.join(rows, ["stream", "seq"])
    undone = seek(data.select("stream", "tx_id"), marks.undos()).groupBy("stream", "tx_id").agg(F.min("r_id").alias("r_id"))
    columns = [c for c in rows.columns if c not in ("stream", "seq")]
    deleted = inserted.join(undone, ["stream", "tx_id"]).select("stream", F.col("r_id").alias("tx_id"), F.lit("delete").alias("change"), F.col("tx_id").alias("of_tx"), *columns)
    return inserted.select("stream", "tx_id", F.lit("insert").alias("change"), F.col("tx_id").alias("of_tx"), *columns).unionByName(deleted)


def live_rows(changed: DataFrame) -> DataFrame:
    """What is left of changes: inserts whose transaction was not deleted."""
    gone = changed.where("change = 'delete'").select("stream", "of_tx").distinct()
    return changed.where("change = 'insert'").join(gone, ["stream", "of_tx"], "left_anti").drop("change", "tx_id")
