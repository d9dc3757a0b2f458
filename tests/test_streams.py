"""Streams that stop and start again, and the stores behind them."""

import json
import random
import tracemalloc
import weakref

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainframe.functions import domain
from chainframe.operators import catalog, cdc, ordered, protocol
from chainframe.operators.transactions import Marks
from chainframe.queries import _feed
from chainframe.sources import arrow_types
from chainframe.sources.feed import event_rows, table
from chainframe.sources.shared import new_path
from chainframe.sources.stores import BatchStore, StateStore, StoreError
from chainframe.streaming import processor, stream
from chainframe.streaming.state import StreamState


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_stream_that_breaks_off_ends_like_one_that_does_not(spark, sf_dir, fails):
    feed = _feed(spark, sf_dir)
    made = processor.messages(feed).persist()
    source, progress, kept, out = (new_path(spark, x) for x in ("messages", "progress", "store", "out"))
    for k in range(4):
        made.where((F.col("seq") >= k * 60) & (F.col("seq") < (k + 1) * 60 if k < 3 else F.lit(True))).coalesce(1).write.mode("append").parquet(source)
    rows = event_rows(table(spark, sf_dir, "events")).select(F.lit("events").alias("stream"), (F.col("b") * 4).alias("seq"), "network", "block_num", "event_id")
    store = BatchStore(spark, kept, "stream string, tx_id long, network string, block_num long, event_id long")
    handle, broken = stream.changes(rows, store, out), []

    def flaky(events, batch):
        if batch == 2 and not broken and fails == "before":
            broken.append(batch)
            raise RuntimeError("lost")
        handle(events, batch)
        if batch == 2 and not broken:
            broken.append(batch)
            raise RuntimeError("lost")

    def events():
        read = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(source)
        return processor.transactions(read)

    with pytest.raises(Exception, match="lost"):
        stream.for_each(events(), flaky, progress).awaitTermination()
    stream.for_each(events(), flaky, progress).awaitTermination()
    assert broken == [2]
    assert rows_of(spark.read.parquet(out).drop("batch")) == rows_of(cdc.changes(Marks(feed), rows))


def test_batch_store(spark):
    store = BatchStore(spark, new_path(spark, "store"), "stream string, tx_id long, v long")
    rows = lambda *ids: spark.createDataFrame([("s", i, i * 10) for i in ids], "stream string, tx_id long, v long")
    assert store.load().collect() == []
    store.append(rows(1, 3), 0)
    store.append(rows(5), 1)
    store.append(rows(5, 2), 1)  # the same batch again
    assert sorted(r.tx_id for r in store.load().collect()) == [1, 2, 3, 5]
    assert sorted(r.tx_id for r in store.seek(1, 3).collect()) == [1, 2, 3]
    for batch in (2, 2, 3):
        store.prune(spark.createDataFrame([("s", 3)], "stream string, prune long"), batch)
        assert sorted(r.tx_id for r in store.load().collect()) == [5]
    assert store._batches(store.ROWS) == [1]
    with pytest.raises(StoreError) as e:
        BatchStore(spark, "file:///proc/nowhere", "stream string, tx_id long, v long").append(rows(1), 0)
    assert e.value.operation == "append"


def test_state_store_takes_the_newest_whole_state(spark, tmp_path):
    store = StateStore(f"file://{tmp_path}/state")
    assert store.load() == StreamState()
    for n in range(1, 6):
        store.save(StreamState(next=n))
    assert StateStore(f"file://{tmp_path}/state").load().next == 5
    assert len(store._numbers()) <= store.KEEP + 1
    (tmp_path / "state" / f"state-{99:020d}.json").write_text(StreamState(next=99).dumps()[:-3])  # broke off
    assert store.load().next == 5


def test_networks_go_by_their_order_in_the_message(spark):
    hashes = {k: "0x" + k * 64 for k in "abc"}
    rows = [("s", 0, True, n, o, 0, 9, hashes["a"], None) for o, n in enumerate(("zeta", "alpha"))]
    rows += [("s", 1, False, "zeta", 0, 10, 19, hashes["b"], None), ("s", 1, False, "alpha", 1, 10, 19, hashes["b"], hashes["c"])]
    feed = spark.createDataFrame(rows, "stream string, seq long, ranges_complete boolean, network string, ordinal int, start_block long, end_block long, hash string, prev_hash string")
    assert [(r.seq, r.error) for r in protocol.first_errors(feed).collect()] == [(1, "MissingPrevHashError")]
    wrong = feed.withColumn("prev_hash", F.when((F.col("seq") == 1) & (F.col("network") == "zeta"), hashes["c"]).otherwise(F.col("prev_hash"))).withColumn("start_block", F.when((F.col("seq") == 1) & (F.col("network") == "zeta"), 30).otherwise(F.col("start_block")))
    assert [r.error for r in protocol.first_errors(wrong).collect()] == ["GapError"]
    assert [r.error for r in protocol.first_errors(wrong.drop("ordinal")).collect()] == ["HashMismatchOnConsecutiveBlocksError"]


def test_running_values_over_ranges(spark):
    rows = [(f"g{i % 3 if i % 5 else 0}", i, (i * 37) % 11 if i % 4 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(5)
    got = {r.i: (r.n, r.total, r.most) for r in ordered.running(df, "g", "i", "t", n=("sum", F.lit(1), True), total=("sum", F.col("v"), False), most=("max", F.col("v"), False)).collect()}
    for g, i, _ in rows:
        before = [v for h, j, v in rows if h == g and j < i]
        known = [v for v in before if v is not None]
        assert got[i] == (len(before) + 1, sum(known) if known else None, max(known, default=None))
    places = {r.i: r.place for r in ordered.numbered(df, [F.col("g").desc(), F.col("i")]).collect()}
    assert places == {i: k + 1 for k, (_, i) in enumerate(sorted(((g, i) for g, i, _ in rows), key=lambda x: (-int(x[0][1]), x[1])))}


def test_resolve_and_upserts(spark):
    rows = [("o", "d", "1.0.0", "a" * 64, 1, "published"), ("o", "d", "1.10.0", "b" * 64, 2, "published"), ("o", "d", "1.9.0", "c" * 64, 3, "draft"), ("o", "d", "1.10.0-rc", "d" * 64, 4, "draft")]
    versions = spark.createDataFrame(rows, "namespace string, name string, version string, hash string, registered long, status string")
    refs = spark.createDataFrame([("o/d@latest",), ("o/d@dev",), ("o/d@1.9.0",), ("o/d@" + "A" * 64,), ("o/d",), ("o/x@latest",), ("o/d@9.9.9",)], "ref string")
    got = {r.ref: r.version for r in catalog.resolve(refs, versions).collect()}
    assert got == {"o/d@latest": "1.10.0", "o/d@dev": "1.10.0-rc", "o/d@1.9.0": "1.9.0", "o/d@" + "A" * 64: "1.0.0", "o/d": "1.10.0-rc"}
    done = catalog.with_status(versions, spark.createDataFrame([("o", "d", "1.0.0")], "namespace string, name string, version string"), ["namespace", "name", "version"], "archived")
    assert {r.version: r.status for r in done.collect()} == {"1.0.0": "archived", "1.10.0": "published", "1.9.0": "draft", "1.10.0-rc": "draft"}


def test_lists_and_validators(spark):
    df = spark.createDataFrame([("a%2Fb,c",), ("",), (None,)], "p string")
    assert [r[0] for r in df.select(catalog.list_parameter(F.col("p"))).collect()] == [["a/b", "c"], [], []]
    cases = {"user_id": ("c" + "a1" * 12, "did:privy:x"), "token_duration": ("7 Days from now", "7 fortnights"), "dataset_reference": ("o/d@1", "o/d"), "dataset_tag": ("dev", "latest1"), "address": ("0x" + "aB" * 20, "0x12"), "block_hash": ("0x" + "a" * 64, "0xA")}
    for kind, (good, bad) in cases.items():
        assert [r[0] for r in spark.createDataFrame([(good,), (bad,)], "v string").select(domain.is_valid(kind, F.col("v"))).collect()] == [True, False], kind
    challenge = spark.createDataFrame([("dBjftJeZ4CVP-mB92K27uhbUJU1p1r_wW1gFWFOEjXk",)], "v string").select(domain.pkce_challenge(F.col("v"))).first()[0]
    assert challenge == "E9Melhoa2OwvFrEMTJguCHaoeK1t8URWbuGJSstw-cM"  # the example of RFC 7636


@pytest.mark.parametrize("codec", [None, "lz4", "zstd"])
def test_arrow_streams(spark, tmp_path, codec):
    plain = pa.table({
        "half": pa.array([1.5, None, -2.0], pa.float16()),
        "word": pa.array(["a", "b", None]).dictionary_encode(),
        "ms": pa.array([1, None, -1_500], pa.timestamp("ms")),
        "ns": pa.array([1_000, 2_000, None], pa.timestamp("ns")),
        "big": pa.array([2**63, 0, None], pa.uint64()),
        "nested": pa.array([{"k": [1, 2]}, None, {"k": None}], pa.struct([("k", pa.large_list(pa.uint8()))])),
        "pairs": pa.array([[("x", 1), ("x", 2)], [], None], pa.map_(pa.string(), pa.int32())),
    })
    for k in range(2):
        with pa.ipc.new_stream(f"{tmp_path}/{k}.arrow", plain.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as w:
            w.write_table(plain, max_chunksize=2)
    got = arrow_types.read_ipc(spark, f"file://{tmp_path}").collect()
    assert len(got) == 6
    first = next(r for r in got if r.word == "a")
    assert (first.half, int(first.big), list(first.nested.k)) == (1.5, 2**63, [1, 2])
    assert [(p.key, p.value) for p in first.pairs] == [("x", 1), ("x", 2)]
    assert arrow_types.read_ipc(spark, f"file://{tmp_path}").select(F.unix_micros(F.col("ms").cast("timestamp")).alias("u")).where("u < 0").first().u == -1_500_000
    value = arrow_types.to_json(arrow_types.read_ipc(spark, f"file://{tmp_path}").where("word = 'a'").select("big", "nested", "pairs")).first().value
    assert value == '{"big":"9223372036854775808","nested":{"k":[1,2]},"pairs":[{"key":"x","value":1},{"key":"x","value":2}]}'


class _Held:
    """A value state without Spark."""

    def __init__(self):
        self.value = None

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_a_worker_holds_some_messages_of_a_micro_batch_at_a_time(monkeypatch):
    monkeypatch.setattr(processor, "EVENTS_AT_ONCE", 7)
    hashes = ["0x" + f"{i + 1:064x}" for i in range(200)]
    messages = [(i, json.dumps([{"network": "eth", "start": i * 10, "end": i * 10 + 9, "hash": hashes[i], "prev_hash": hashes[i - 1] if i else None}])) for i in range(200)]
    random.Random(1).shuffle(messages)
    frames, most = [], 0

    def rows():
        nonlocal most
        for k in range(0, 200, 10):
            some = messages[k : k + 10]
            frame = pd.DataFrame({"stream": "s", "seq": [i for i, _ in some], "ranges_complete": [i % 2 == 1 for i, _ in some], "n_rows": [1 - i % 2 for i, _ in some], "ranges": [r for _, r in some]})
            frames.append(weakref.ref(frame))
            yield frame
            del frame
            most = max(most, sum(f() is not None for f in frames))

    operator = processor.TransactionProcessor()
    operator.init(_Held())
    blocks = list(operator.handleInputRows(("s",), rows(), None))
    assert most <= 1 and max(map(len, blocks)) <= 7
    made = pd.concat(blocks)
    assert list(made["seq"]) == list(made["tx_id"]) == list(range(200))
    assert list(made["tag"]) == ["Data", "Watermark"] * 100


@pytest.mark.parametrize("runs", [2, 3, 64])
def test_rows_come_in_order_whatever_the_number_of_runs(runs):
    places = list(range(1000))
    random.Random(2).shuffle(places)
    frames = (pd.DataFrame({"text": [f"{i}" if i % 3 else None for i in places[k : k + 13]], "seq": places[k : k + 13]}) for k in range(0, 1000, 13))
    assert list(processor.in_order(frames, ["seq", "text"], 4, runs)) == [(i, f"{i}" if i % 3 else None) for i in range(1000)]
    assert list(processor.in_order(iter([]), ["seq", "text"])) == []


def test_the_memory_of_a_worker_does_not_grow_with_its_messages():
    def most(n):
        places, held, arrow = list(range(n)), 0, pa.total_allocated_bytes()
        random.Random(3).shuffle(places)
        frames = (pd.DataFrame({"seq": places[k : k + 250], "text": [f"{i:0400d}" for i in places[k : k + 250]]}) for k in range(0, n, 250))
        tracemalloc.start()
        try:
            for place, row in enumerate(processor.in_order(frames, ["seq", "text"], 100, 4)):
                assert row == (place, f"{place:0400d}")
                held = max(held, pa.total_allocated_bytes() - arrow)
            return held + tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    most(1_000)  # what is imported by the first run
    assert most(40_000) < 2 * most(5_000)
