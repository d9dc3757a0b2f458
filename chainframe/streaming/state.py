"""The state of one stream: what it saw last, its transaction ids and its watermarks.

This is the general form of chainframe.operators.transactions, for a stream processor to hold a key's
state in: it takes a message at a time and gives the events of that message.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from chainframe.sources.feed import ZERO_HASH

RETENTION = 128


class ProtocolError(ValueError):
    """A message that cannot follow what the stream saw; the stream has to be opened anew."""

    def __init__(self, code: str, **details):
        super().__init__(f"{code} {details}")
        self.code, self.details = code, details


class ReorgError(ProtocolError):
    """A reorganisation that stored watermarks cannot undo; the stream starts over with an empty state."""


def check(previous: list[dict], ranges: list[dict]) -> None:
    """Raises the first error of a message: hashes, then networks, then order."""
    for r in ranges:
        none = r["prev_hash"] is None or r["prev_hash"] == ZERO_HASH
        if r["start"] == 0 and not none:
            raise ProtocolError("InvalidPrevHashError", network=r["network"])
        if r["start"] > 0 and none:
            raise ProtocolError("MissingPrevHashError", network=r["network"], block=r["start"])
    names = [r["network"] for r in ranges]
    if len(set(names)) < len(names):
        raise ProtocolError("DuplicateNetworkError", network=next(n for i, n in enumerate(names) if n in names[:i]))
    if previous:
        known = {r["network"]: r for r in previous}
        if len(known) != len(names):
            raise ProtocolError("NetworkCountChangedError", expected=len(known), actual=len(names))
        for r in ranges:
            if r["network"] not in known:
                raise ProtocolError("UnexpectedNetworkError", network=r["network"])
        for r in ranges:
            p = known[r["network"]]
            if r == p:
                continue
            linked = r["prev_hash"] == p["hash"]
            if r["start"] == p["end"] + 1 and not linked:
                raise ProtocolError("HashMismatchOnConsecutiveBlocksError", network=r["network"])
            if r["start"] < p["end"] + 1 and linked:
                raise ProtocolError("InvalidReorgError", network=r["network"])
            if r["start"] > p["end"] + 1:
                raise ProtocolError("GapError", network=r["network"], first=p["end"] + 1, last=r["start"] - 1)


def invalidated(previous: list[dict], ranges: list[dict]) -> list[dict]:
    known = {r["network"]: r for r in previous}
    back = [(r, known[r["network"]]) for r in ranges if r["network"] in known and r != known[r["network"]]]
    return [{"network": r["network"], "start": r["start"], "end": max(r["end"], p["end"])} for r, p in back if r["start"] < p["end"] + 1]


def recovery_point(buffer: list[tuple[int, list[dict]]], points: dict[str, int]):
    """The newest watermark that no network's point reaches, or None."""
    return next((w for w in reversed(buffer) if not any(r["network"] in points and r["start"] >= points[r["network"]] for r in w[1])), None)


def pruning_point(buffer: list[tuple[int, list[dict]]], retention: int) -> int | None:
    """The last of the oldest watermarks that lie behind the retention window on every network."""
    if not buffer:
        return None
    cutoff = {r["network"]: max(0, r["start"] - retention) for r in buffer[-1][1]}
    last = None
    for tx_id, ranges in buffer[:-1]:
        if any(r["network"] in cutoff and r["end"] >= cutoff[r["network"]] for r in ranges):
            break
        last = tx_id
    return last


def partial_network(ranges: list[dict], points: dict[str, int]) -> str | None:
    return next((r["network"] for r in ranges if r["network"] in points and r["start"] < points[r["network"]] <= r["end"]), None)


@dataclass
class StreamState:
    retention: int = RETENTION
    next: int = 0
    previous: list[dict] = field(default_factory=list)
    buffer: list[tuple[int, list[dict]]] = field(default_factory=list)
    waiting: list[tuple[int, list[dict], int | None]] = field(default_factory=list)  # watermarks not yet committed

    def _id(self) -> int:
        self.next += 1
        return self.next - 1

    def rewind(self) -> dict | None:
        """The undo event of a restart, if anything after the last watermark may have been delivered."""
        last = self.buffer[-1][0] if self.buffer else -1
        if self.next <= last + 1:
            return None
        end = self.next - 1
        return {"tx_id": self._id(), "tag": "Undo", "cause": "Rewind", "undo_start": last + 1, "undo_end": end, "prune": None}

    def message(self, ranges: list[dict], complete: bool, n_rows: int) -> dict:
        """The event of a message. ranges: network, start, end, hash, prev_hash."""
        check(self.previous, ranges)
        gone = invalidated(self.previous, ranges)
        self.previous = ranges
        tx_id = self._id()
        event = {"tx_id": tx_id, "tag": "Data", "cause": None, "undo_start": None, "undo_end": None, "prune": None}
        if gone:
            return event | {"tag": "Undo", "cause": "Reorg"} | self._undo(tx_id, {g["network"]: g["start"] for g in gone})
        if complete and n_rows == 0:
            self.buffer.append((tx_id, ranges))
            prune = pruning_point(self.buffer, self.retention)
            self.waiting.append((tx_id, ranges, prune))
            return event | {"tag": "Watermark", "prune": prune}
        return event

    def _undo(self, tx_id: int, points: dict[str, int]) -> dict:
        found = recovery_point(self.buffer, points)
        if found is None and self.buffer:
            raise ReorgError("UnrecoverableReorgError")
        if found and (network := partial_network(found[1], points)):
            raise ReorgError("PartialReorgError", network=network)
        start = found[0] + 1 if found else 0
        self.buffer = [w for w in self.buffer if w[0] < start]
        self.waiting = [w for w in self.waiting if w[0] < start]
        return {"undo_start": start, "undo_end": max(start, tx_id - 1)}

    def commit(self, tx_id: int) -> dict | None:
        """Makes watermarks up to an id durable: {insert, prune}, or None if none waits."""
        done = [w for w in self.waiting if w[0] <= tx_id]
        if not done:
            return None
        prune = max((w[2] for w in done if w[2] is not None), default=None)
        self.waiting = self.waiting[len(done) :]
        if prune is not None:
            self.buffer = [w for w in self.buffer if w[0] > prune]
        return {"insert": [(w[0], w[1]) for w in done if prune is None or w[0] > prune], "prune": prune}

    def dumps(self) -> str:
        return json.dumps([self.retention, self.next, self.previous, self.buffer, self.waiting])

    @classmethod
    def loads(cls, text: str) -> StreamState:
        retention, following, previous, buffer, waiting = json.loads(text)
        return cls(retention, following, previous, [(i, r) for i, r in buffer], [(i, r, p) for i, r, p in waiting])
