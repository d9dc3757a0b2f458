"""The state machine on single messages, and against the closed forms on random feeds."""

import random

import pytest

from chainframe.operators import protocol
from chainframe.operators.transactions import Marks
from chainframe.queries import _feed
from chainframe.sources.feed import ZERO_HASH
from chainframe.streaming.state import ProtocolError, ReorgError, StreamState, check, invalidated, partial_network, pruning_point, recovery_point


def h(c):
    return "0x" + c * 64


def r(start, end, network="eth", hash="b", prev="a"):
    return {"network": network, "start": start, "end": end, "hash": h(hash), "prev_hash": None if prev is None else h(prev)}


@pytest.mark.parametrize(
    "previous, ranges, code",
    [
        ([], [r(0, 5, prev="a")], "InvalidPrevHashError"),
        ([], [r(1, 5, prev=None)], "MissingPrevHashError"),
        ([], [r(1, 5) | {"prev_hash": ZERO_HASH}], "MissingPrevHashError"),
        ([], [r(1, 5), r(1, 5)], "DuplicateNetworkError"),
        ([r(1, 5)], [r(1, 5), r(1, 5, "polygon")], "NetworkCountChangedError"),
        ([r(1, 5)], [r(1, 5, "polygon")], "UnexpectedNetworkError"),
        ([r(1, 5)], [r(6, 9, prev="c")], "HashMismatchOnConsecutiveBlocksError"),
        ([r(1, 5)], [r(3, 9, prev="b")], "InvalidReorgError"),
        ([r(1, 5)], [r(8, 9, prev="b")], "GapError"),
    ],
)
def test_errors(previous, ranges, code):
    with pytest.raises(ProtocolError) as e:
        check(previous, ranges)
    assert e.value.code == code


@pytest.mark.parametrize(
    "previous, ranges",
    [([], [r(0, 5, prev=None)]), ([], [r(0, 5) | {"prev_hash": ZERO_HASH}]), ([r(1, 5)], [r(1, 5)]), ([r(1, 5)], [r(6, 9, prev="b")]), ([r(1, 5)], [r(3, 9, prev="c")])],
)
def test_no_errors(previous, ranges):
    check(previous, ranges)


@pytest.mark.parametrize(
    "previous, ranges, wanted",
    [((0, 10), (5, 12), (5, 12)), ((31, 40), (15, 25), (15, 40)), ((11, 20), (15, 25), (15, 25)), ((10, 10), (10, 12), (10, 12)), ((0, 10), (11, 20), None)],
)
def test_invalidated(previous, ranges, wanted):
    found = invalidated([r(*previous)], [r(*ranges, hash="c", prev="d")])
    assert found == ([{"network": "eth", "start": wanted[0], "end": wanted[1]}] if wanted else [])


def marks(*ranges):
    return [(i + 1, [r(*x)] if isinstance(x[0], int) else [r(a, b, n) for n, a, b in x]) for i, x in enumerate(ranges)]


def test_recovery():
    assert recovery_point(marks((0, 10), (11, 20), (21, 30)), {"eth": 21})[0] == 2
    assert recovery_point(marks((100, 110), (111, 120)), {"eth": 100}) is None
    two = [(1, [r(0, 10), r(0, 100, "polygon")]), (2, [r(11, 20), r(101, 200, "polygon")]), (3, [r(21, 30), r(201, 300, "polygon")])]
    assert recovery_point(two, {"eth": 21, "polygon": 201})[0] == 2


def test_pruning():
    assert pruning_point(marks((0, 10), (11, 20), (100, 110)), 50) == 2
    assert pruning_point(marks((0, 10), (45, 55), (100, 110)), 50) == 1
    assert pruning_point([(1, [r(0, 10), r(0, 100, "polygon")]), (2, [r(200, 210)])], 50) == 1
    assert pruning_point([], 50) is None


@pytest.mark.parametrize("point, wanted", [(5, "eth"), (10, "eth"), (11, None)])
def test_partial(point, wanted):
    assert partial_network([r(0, 10)], {"eth": point}) == wanted


def test_rewind():
    assert StreamState(next=5).rewind() == {"tx_id": 5, "tag": "Undo", "cause": "Rewind", "undo_start": 0, "undo_end": 4, "prune": None}
    undo = StreamState(next=7, buffer=[(3, [r(0, 10)])]).rewind()
    assert (undo["undo_start"], undo["undo_end"]) == (4, 6)
    assert StreamState().rewind() is None
    assert StreamState(next=4, buffer=[(3, [r(0, 10)])]).rewind() is None


def test_reorgs():
    back = [r(21, 35, hash="d", prev="e")]
    state = StreamState(next=4, buffer=marks((0, 10), (11, 20), (21, 30)), previous=[r(21, 30)])
    event = state.message(back, False, 1)
    assert (event["undo_start"], event["undo_end"], [w[0] for w in state.buffer]) == (3, 3, [1, 2])
    empty = StreamState(next=5, previous=[r(1, 10)])
    assert empty.message([r(5, 15, hash="d", prev="e")], False, 1)["undo_start"] == 0
    with pytest.raises(ReorgError, match="Unrecoverable"):
        StreamState(next=3, buffer=marks((100, 110), (111, 120)), previous=[r(111, 120)]).message([r(100, 130, hash="d", prev="e")], False, 1)
    with pytest.raises(ReorgError, match="Partial"):
        StreamState(next=2, buffer=marks((0, 20)), previous=[r(0, 20)]).message([r(10, 30, hash="d", prev="e")], False, 1)


def test_commits():
    state = StreamState(buffer=marks((0, 10), (11, 20), (21, 30)), waiting=[(1, [], None), (2, [], None), (3, [], 1)])
    done = state.commit(3)
    assert ([i for i, _ in done["insert"]], done["prune"], [w[0] for w in state.buffer]) == ([2, 3], 1, [2, 3])
    assert state.commit(3) is None


def random_feed(seed, n=60, networks=("eth", "polygon")):
    """Messages of contiguous ranges with reorganisations; watermarks follow their data."""
    rng, out, tops, hashes = random.Random(seed), [], dict.fromkeys(networks, -1), {}
    ends = {k: [] for k in networks}
    for i in range(n):
        if i and rng.random() < 0.2 and len(ends["eth"]) > 1:
            depth = rng.randint(1, min(3, len(ends["eth"]) - 1))
            starts = [e - 9 for e in ends["eth"][-depth:]]
            message = []
            for k in networks:
                start = starts[0] if k == "eth" else tops[k] - 9
                message.append((k, start, tops[k], k == "eth"))
            if starts[0] == 0:
                continue
            ends["eth"] = ends["eth"][:-depth] + [tops["eth"]]
        else:
            message = []
            for k in networks:
                message.append((k, tops[k] + 1, tops[k] + 10, True))
                tops[k] += 10
                ends[k].append(tops[k])
        ranges = []
        for k, start, end, new in message:
            if new:
                hashes[k, end] = f"0x{rng.getrandbits(256):064x}"
            parent = None if start == 0 else (hashes.get((k, start - 1)) if start == tops[k] - 9 or k != "eth" else f"0x{rng.getrandbits(256):064x}")
            same = out and next((x for x in out[-1][0] if x["network"] == k and x["start"] == start and x["end"] == end), None)
            ranges.append(same if same and not new else {"network": k, "start": start, "end": end, "hash": hashes[k, end], "prev_hash": parent})
        out.append((ranges, False))
        if rng.random() < 0.8:
            out.append((ranges, True))
    return out


def test_closed_forms_follow_the_state_machine(spark):
    rows, wanted = [], {}
    for seed in range(6):
        state = StreamState(retention=20)
        for seq, (ranges, complete) in enumerate(random_feed(seed)):
            try:
                event = state.message(ranges, complete, 0 if complete else 1)
            except ProtocolError:
                break
            state.commit(event["tx_id"])
            rows += [(f"s{seed}", seq, complete, x["network"], x["start"], x["end"], x["hash"], x["prev_hash"]) for x in ranges]
            wanted[f"s{seed}", event["tx_id"]] = event
    feed = spark.createDataFrame(rows, "stream string, seq long, ranges_complete boolean, network string, start_block long, end_block long, hash string, prev_hash string").cache()
    assert protocol.first_errors(feed).count() == 0
    found = Marks(feed, 20)
    undos = {(x.stream, x.r_id): (x.undo_start, x.undo_end) for x in found.undos().collect()}
    assert undos == {k: (e["undo_start"], e["undo_end"]) for k, e in wanted.items() if e["tag"] == "Undo"} and undos
    tags = {(x.stream, x.tx_id): x.tag.replace("Reorg", "Undo") for x in found.events.collect()}
    assert tags == {k: e["tag"] for k, e in wanted.items()}
    prunes = {(x.stream, x.w_id): x.prune for x in found.prunes().collect()}
    assert prunes == {k: e["prune"] for k, e in wanted.items() if e["prune"] is not None} and prunes


def rare_feed(seed):
    """A random feed with few of its watermarks, so that a reorganisation's recovery point or what it prunes lies far behind."""
    rng = random.Random(seed)
    return [x for x in random_feed(seed, n=150) if not x[1] or rng.random() < 0.06]


def far_feed():
    """One watermark, many messages without any, a reorganisation."""
    h = lambda k: f"0x{k:064x}"
    one = lambda i: r(10 * i, 10 * i + 9, hash=h(i + 1), prev=h(i) if i else None)
    out = [([one(i)], complete) for i in range(70) for complete in ((False, True) if i == 9 else (False,))]
    return [*out, ([r(690, 699, hash=h(999), prev=h(998))], False)]


def test_closed_forms_with_rare_watermarks(spark):
    rows, wanted, far = [], {}, 0
    feeds = {f"s{seed}": (rare_feed(seed), 20) for seed in range(12)} | {"far": (far_feed(), 20)}
    for name, (messages, retention) in feeds.items():
        state = StreamState(retention=retention)
        for seq, (ranges, complete) in enumerate(messages):
            try:
                event = state.message(ranges, complete, 0 if complete else 1)
            except ProtocolError:
                break
            state.commit(event["tx_id"])
            rows += [(name, seq, complete, x["network"], x["start"], x["end"], x["hash"], x["prev_hash"]) for x in ranges]
            wanted[name, event["tx_id"]] = event
            far += event["tag"] == "Undo" and bool(state.buffer) and state.buffer[-1][1][0]["end"] < ranges[0]["start"] - 100
    assert far > 1
    feed = spark.createDataFrame(rows, "stream string, seq long, ranges_complete boolean, network string, start_block long, end_block long, hash string, prev_hash string").cache()
    assert protocol.first_errors(feed).count() == 0
    found = Marks(feed, 20)
    undos = {(x.stream, x.r_id): (x.undo_start, x.undo_end) for x in found.undos().collect()}
    assert undos == {k: (e["undo_start"], e["undo_end"]) for k, e in wanted.items() if e["tag"] == "Undo"} and undos
    assert undos["far", 71] == (11, 70)
    prunes = {(x.stream, x.w_id): x.prune for x in found.prunes().collect()}
    assert prunes == {k: e["prune"] for k, e in wanted.items() if e["prune"] is not None} and prunes


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_messages_meet_the_one_before_across_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(protocol, "RANGES", ranges)
    seqs = {"a": [i * i for i in range(50)], "b": [3, 2400, 2401], "c": [7]}
    rows = [(s, q, n, q + k) for s, qs in seqs.items() for q in qs for k, n in enumerate(("x", "y")) if n == "x" or q % 3]
    got = {(r.stream, r.seq): r for r in protocol.paired(spark.createDataFrame([*rows, (None, 1, "x", 1), ("a", None, "x", 1)], "stream string, seq long, network string, v long").repartition(7)).collect()}
    own = lambda s, q: sorted((n, v) for t, p, n, v in rows if (t, p) == (s, q))
    assert set(got) == {(s, q) for s, qs in seqs.items() for q in qs}
    for s, qs in seqs.items():
        for before, q in zip([None, *qs], qs, strict=False):
            r = got[s, q]
            assert r.before == before and sorted((x.network, x.v) for x in r.ranges) == own(s, q)
            assert (r.previous and sorted((x.network, x.v) for x in r.previous)) == (None if before is None else own(s, before))
    assert protocol.paired(spark.createDataFrame([], "stream string, seq long, network string, v long")).count() == 0


def test_first_errors_shuffle_whole_ranges_once(spark, sf_dir):
    found = protocol.first_errors(protocol.defective_feeds(_feed(spark, sf_dir), 40))
    assert found.count() == len(protocol.DEFECTS)
    found.write.mode("overwrite").format("noop").save()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [stream" in plan and "max_by" not in plan
    assert "Window [max(" not in plan
