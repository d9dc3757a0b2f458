"""Durable stores of a stream: its state, and the rows of the batches it delivered. In any file system that Spark or pyarrow opens."""

from __future__ import annotations

import pyarrow.fs
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.streaming.state import StreamState


class StoreError(RuntimeError):
    """What a store could not do: operation is one of advance, load, append, forget, prune."""

    def __init__(self, operation: str, reason: Exception):
        super().__init__(f"{operation}: {reason}")
        self.operation, self.reason = operation, reason


class StateStore:
    """The state of one stream as small numbered files. A state is written under the next number and never changed, so no store has to
    replace a file at once; the newest whole one counts."""

    KEEP = 2

    def __init__(self, uri: str):
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path, recursive=True)

    def _numbers(self) -> list[int]:
        names = (f.base_name for f in self.fs.get_file_info(pyarrow.fs.FileSelector(self.path)))
        return sorted(int(n.removeprefix("state-").removesuffix(".json")) for n in names if n.startswith("state-"))

    def _read(self, number: int) -> StreamState | None:
        with self.fs.open_input_stream(f"{self.path}/state-{number:020d}.json") as f:
            text = f.read().decode()
        return StreamState.loads(text[:-1]) if text.endswith("\n") else None  # a write that broke off has no end of line

    def load(self) -> StreamState:
        try:
            return next((s for n in reversed(self._numbers()) if (s := self._read(n))), None) or StreamState()
        except OSError as e:
            raise StoreError("load", e) from e

    def save(self, state: StreamState) -> None:
        try:
            numbers = self._numbers()
            with self.fs.open_output_stream(f"{self.path}/state-{(numbers[-1] if numbers else 0) + 1:020d}.json") as f:
                f.write(state.dumps().encode() + b"\n")
            for old in numbers[: -self.KEEP]:
                self.fs.delete_file(f"{self.path}/state-{old:020d}.json")
        except OSError as e:
            raise StoreError("advance", e) from e


class BatchStore:
    """Rows (stream, tx_id, ...) of delivered micro-batches as Parquet, what undos took from them, and how far they are pruned.

    Each is written by micro-batch, so doing a batch again replaces what it did. Rows lie in the store's folder until all of their
    batch are pruned; what counts is decided by joins, not by moving rows.
    """

    ROWS, GONE, PRUNED = "rows", "gone", "pruned"

    def __init__(self, spark: SparkSession, uri: str, schema: str):
        """schema: of the rows, as DDL."""
        self.spark, self.uri, self.schema = spark, uri.rstrip("/"), schema
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(self.uri)
        self._kinds = {self.ROWS: schema, self.GONE: "stream string, tx_id long, r_id long", self.PRUNED: "stream string, prune long"}

    def _write(self, df: DataFrame, kind: str, batch: int, operation: str) -> None:
        try:
            df.write.mode("overwrite").parquet(f"{self.uri}/{kind}/batch={batch}")
        except (PySparkException, Py4JJavaError) as e:
            raise StoreError(operation, e) from e

    def _batches(self, kind: str) -> list[int]:
        found = self.fs.get_file_info(pyarrow.fs.FileSelector(f"{self.path}/{kind}", allow_not_found=True))
        return sorted(int(f.base_name.removeprefix("batch=")) for f in found if f.base_name.startswith("batch="))

    def _read(self, kind: str, last: int | None) -> DataFrame:
        some = [b for b in self._batches(kind) if last is None or b <= last]
        if not some:
            return self.spark.createDataFrame([], f"{self._kinds[kind]}, batch int")
        return self.spark.read.schema(f"{self._kinds[kind]}, batch int").option("basePath", f"{self.uri}/{kind}").parquet(*(f"{self.uri}/{kind}/batch={b}" for b in some))

    def append(self, rows: DataFrame, batch: int) -> None:
        """Stores a batch; one that is there is replaced."""
        self._write(rows, self.ROWS, batch, "append")

    def load(self, upto: int | None = None) -> DataFrame:
        """The rows of the batches up to one, that no pruning took."""
        pruned = self._read(self.PRUNED, None if upto is None else upto - 1).groupBy("stream").agg(F.max("prune").alias("prune"))
        return self._read(self.ROWS, upto).drop("batch").join(pruned, "stream", "left").where("prune is null or tx_id > prune").drop("prune")

    def seek(self, start: int, end: int) -> DataFrame:
        """stream, tx_id from start to end, both included, that are there."""
        return self.load().where(F.col("tx_id").between(start, end)).select("stream", "tx_id").distinct()

    def forget(self, undone: DataFrame, batch: int) -> None:
        """Notes the transactions (stream, tx_id, r_id) that undos of a batch took."""
        self._write(undone.select("stream", "tx_id", "r_id"), self.GONE, batch, "forget")

    def gone(self, before: int) -> DataFrame:
        """stream, tx_id, r_id, batch: what undos of batches before one took."""
        return self._read(self.GONE, before - 1)

    def prune(self, upto: DataFrame, batch: int) -> None:
        """Notes up to which id (stream, prune) rows are not needed any more, and removes batches that held no other before this one; doing it again changes nothing."""
        self._write(upto.select("stream", "prune"), self.PRUNED, batch, "prune")
        # what earlier batches pruned is never asked for again, not even by a restart that does this batch anew
        pruned = self._read(self.PRUNED, batch - 1).groupBy("stream").agg(F.max("prune").alias("prune"))
        old = self._read(self.ROWS, batch - 1).join(pruned, "stream", "left")
        idle = old.groupBy("batch").agg(F.bool_and(F.coalesce(F.col("tx_id") <= F.col("prune"), F.lit(False))).alias("idle")).where("idle")
        for (done,) in idle.select("batch").collect():  # numbers of batches
            self.fs.delete_dir(f"{self.path}/{self.ROWS}/batch={done}")
