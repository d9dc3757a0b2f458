"""Structured Streaming over feeds: messages in, transaction events out; one key a stream."""

from __future__ import annotations

import heapq
import json
import operator
import os
import tempfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chainframe.streaming.state import RETENTION, StreamState

EVENTS = "stream string, seq long, tx_id long, tag string, cause string, undo_start long, undo_end long, prune long"
MESSAGE = "array<struct<network:string,start:bigint,end:bigint,hash:string,prev_hash:string>>"
#: Rows of a run that a merge holds at a time, runs that are merged at once, and events that a worker hands on at once.
SLICE, RUNS, EVENTS_AT_ONCE = 500, 64, 10_000
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def messages(feed: DataFrame) -> DataFrame:
    """A row a message of a batch feed: stream, seq, ranges_complete, n_rows, ranges."""
    one = F.struct("network", F.col("start_block").alias("start"), F.col("end_block").alias("end"), "hash", "prev_hash")
    return feed.groupBy("stream", "seq").agg(F.bool_and("ranges_complete").alias("ranges_complete"), F.array_sort(F.collect_list(one)).alias("ranges")).withColumn("n_rows", F.when(F.col("ranges_complete"), 0).otherwise(1).cast("long"))


def _run(path: str) -> Iterator[tuple]:
    with pa.OSFile(path) as file, pa.ipc.open_file(file) as run:
        for k in range(run.num_record_batches):
            yield from zip(*run.get_batch(k).to_pydict().values(), strict=True)


def in_order(frames: Iterator[pd.DataFrame], columns: list[str], slice_rows: int = SLICE, runs: int = RUNS) -> Iterator[tuple]:
    """The rows of frames as tuples of columns, ascending in the first one.

    Each frame becomes a sorted run in a temporary file, and so many runs become one longer run. So a worker holds one frame and some
    rows of each run, however many rows there are.
    """
    with tempfile.TemporaryDirectory() as folder:
        levels: list[list[str]] = []
        made = 0

        def merged(paths: list[str]) -> Iterator[tuple]:
            return heapq.merge(*map(_run, paths), key=operator.itemgetter(0))

        def new_path() -> str:
            nonlocal made
            made += 1
            return f"{folder}/{made}"

        def add(path: str, level: int, schema: pa.Schema) -> None:
            if level == len(levels):
                levels.append([])
            levels[level].append(path)
            if len(levels[level]) < runs:
                return
            longer, some = new_path(), []
            with pa.ipc.new_file(longer, schema) as out:
                for row in merged(levels[level]):
                    some.append(row)
                    if len(some) == slice_rows:
                        out.write_batch(pa.record_batch(list(map(list, zip(*some, strict=True))), schema=schema))
                        some = []
                if some:
                    out.write_batch(pa.record_batch(list(map(list, zip(*some, strict=True))), schema=schema))
            for old in levels[level]:
                os.remove(old)
            levels[level] = []
            add(longer, level + 1, schema)

        for frame in frames:
            table = pa.Table.from_pandas(frame[columns].sort_values(columns[0]), preserve_index=False)
            del frame
            path = new_path()
            with pa.ipc.new_file(path, table.schema) as out:
                out.write_table(table, max_chunksize=slice_rows)
            add(path, 0, table.schema)
        yield from merged([path for level in levels for path in level])


def _events(some: list[dict]) -> pd.DataFrame:
    made = pd.DataFrame(some)
    for c in ("undo_start", "undo_end", "prune"):
        made[c] = made[c].astype("Int64")
    return made


class TransactionProcessor(StatefulProcessor):
    """Holds a StreamState for each stream; watermarks are committed as they come. Of the messages of a micro-batch, which come in any
    order, a worker holds some at a time."""

    def __init__(self, retention: int = RETENTION):
        self.retention = retention

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = StreamState.loads(self.state.get()[0]) if self.state.exists() else StreamState(self.retention)
        out = []
        for seq, complete, n_rows, ranges in in_order(rows, ["seq", "ranges_complete", "n_rows", "ranges"]):
            event = state.message(json.loads(ranges), bool(complete), int(n_rows))
            state.commit(event["tx_id"])
            out.append({"stream": key[0], "seq": int(seq), **event})
            if len(out) == EVENTS_AT_ONCE:
                yield _events(out)
                out = []
        self.state.update((state.dumps(),))
        if out:
            yield _events(out)

    def close(self) -> None:
        pass


def transactions(stream: DataFrame, retention: int = RETENTION) -> DataFrame:
    """The events of a streaming DataFrame of messages. A message that breaks the protocol ends the query with its error."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    # ranges as text: a worker would make several objects of each
    plain = stream.select("stream", "seq", "ranges_complete", "n_rows", F.to_json("ranges", {"ignoreNullFields": "false"}).alias("ranges"))
    return plain.groupBy("stream").transformWithStateInPandas(TransactionProcessor(retention), EVENTS, "Append", "None")


def windowed_counts(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums of a stream of events (ts, event_type, value) in tumbling or sliding windows. start is of the type of ts."""
    kind = events.schema["ts"].dataType
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return timed.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast(kind).alias("start"), "event_type", "n", "total")
