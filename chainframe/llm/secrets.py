"""Secret scans over a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: what any match must contain.
Documents are indexed in blocks as Spark streams them: the trigrams that some query names get postings (the
documents of the block that hold them), queries intersect and unite postings, and only the candidates are
searched with the expression. Rules without a mandatory trigram search every document. Blocks
are bounded in bytes and independent of each other, so the scan is one pass without a shuffle.

Null texts count as empty; repeated rows, null keys and further columns are kept (a column named ``spans`` is replaced); an empty table
gives an empty result. Positions are code points; a span's end is exclusive. Very long texts are a block of their own and searched whole;
the expressions match in time that grows with the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainframe.llm.common import bound_batches, others, slices

#: Sets of alternative strings larger than this are not multiplied out any further.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. keep: whether a match counts; a match that fails is dropped, not retried.
    index: a pattern that every match that counts meets, for the trigram query (default: the pattern)."""

    kind: str
    pattern: str
    any_case: bool = False
    keep: Callable[[re.Match], bool] = bool
    index: str = ""

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, lambda m: len(m[2]) >= 6),
    Rule("access", r"AKIA[A-Z0-9]+", keep=lambda m: len(m[0]) >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # maximal runs, so the same as longer runs filtered by length
)
_LABEL = r"[A-Z ]*+(?<=PRIVATE KEY)-----"
_LOGIN = r"://[^\s:@/]++:[^\s:@/]++@"
#: Without a limit of length. Repeats are possessive and end at characters outside them; where several places of one run could
#: start a match (jwt, url), a start that leads to none takes the run with it, as the rest of the run leads to none either.
#: So matching is linear. A private key without an END line is its BEGIN line.
MORE = (
    Rule("private_key", rf"-----BEGIN {_LABEL}(?:(?:[^-]++|-(?!----))*+-----END {_LABEL})?"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}+\b"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"\b[rs]k_live_[A-Za-z0-9]{16,}+\b"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{10,}+(\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)?", keep=lambda m: m[1] is not None, index=r"eyJ.+\.eyJ"),
    Rule("url", rf"\b[a-z](?:[a-z0-9]++{_LOGIN}|[a-z0-9]*+[+.-][a-z0-9+.-]*+(?:{_LOGIN})?)", keep=lambda m: m[0][-1] == "@", index=_LOGIN),
)

#: A query: None (any document), a trigram, or ("and" | "or", a set of queries).


def _both(a, b):
    if a is None or b is None:
        return b if a is None else a
    return a if a == b else ("and", frozenset((a, b)))


def _either(queries):
    queries = frozenset(queries)
    if None in queries or not queries:
        return None
    return next(iter(queries)) if len(queries) == 1 else ("or", queries)


def _holds(strings: frozenset[str]):
    """The query for texts that hold one of the strings."""
    each = []
    for s in strings:
        query = None
        for i in range(len(s.encode()) - 2):
            query = _both(query, s.encode()[i : i + 3])
        each.append(query)
    return _either(each)


def _walk(items) -> tuple[frozenset[str] | None, object]:
    """(all strings that a sequence can match, or None if they are too many; its query)."""
    exact, whole, query = frozenset([""]), True, None
    for kind, value in items:
        one, need = None, None
        if kind is op.LITERAL:
            one = frozenset([chr(value)])
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            one = frozenset(chr(v) for _, v in value)
        elif kind is op.AT:
            one = frozenset([""])
        elif kind is op.SUBPATTERN:
            one, need = _walk(value[3])
        elif kind is op.BRANCH:
            parts = [_walk(branch) for branch in value[1]]
            one = frozenset().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            need = _either(p[1] if p[0] is None else _holds(p[0]) for p in parts)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            found, inside = _walk(inner)
            if found is not None and most == 1:
                one = found | {""} if least == 0 else found
            elif found is not None and least == most and len(found) ** least <= MOST_ALTERNATIVES:
                one = frozenset([""])
                for _ in range(least):
                    one = frozenset(a + b for a in one for b in found)
            elif least:
                need = inside if found is None else _both(inside, _holds(found))
        if one is not None:
            one = frozenset(s.lower() for s in one)
        if one is not None and len(exact) * len(one) <= MOST_ALTERNATIVES:
            exact = frozenset(a + b for a in exact for b in one)
        else:
            query = _both(_both(query, _holds(exact)), need if one is None else _holds(one))
            exact, whole = frozenset([""]), False
    return (exact, query) if whole else (None, _both(query, _holds(exact)))


def trigram_query(pattern: str):
    """The Boolean query over trigrams (bytes, ASCII letters in lower case) that every match of the pattern meets."""
    exact, query = _walk(_parser.parse(pattern, re.ASCII))
    return query if exact is None else _holds(exact)


def trigrams(query) -> set[bytes]:
    if query is None or isinstance(query, bytes):
        return set() if query is None else {query}
    return set().union(*map(trigrams, query[1]))


class Vocabulary:
    """The trigrams that some query names, and a mask of them that one worker makes once."""

    def __init__(self, trigrams: list[bytes]):
        self.named = np.array(sorted(int.from_bytes(t, "big") for t in trigrams), np.uint32)
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[self.named] = True


class Block:
    """Postings of a block of texts for a vocabulary of trigrams."""

    def __init__(self, texts: pa.Array, vocabulary: Vocabulary):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]] if len(offsets) else data
        offsets = offsets - (offsets[0] if len(offsets) else 0)
        folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
        codes = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:] if len(folded) > 2 else np.zeros(0, np.uint32)
        self.n, named = len(texts), vocabulary.named
        at = np.flatnonzero(vocabulary.wanted[codes])
        rows = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[rows + 1]
        pairs = np.unique(codes[at[inside]].astype(np.uint64) << np.uint64(32) | rows[inside].astype(np.uint64))
        keys, docs = (pairs >> np.uint64(32)).astype(np.uint32), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        bounds = np.searchsorted(keys, named, "left"), np.searchsorted(keys, named, "right")
        self.postings = {int(t).to_bytes(3, "big"): docs[a:b] for t, a, b in zip(named, *bounds, strict=True)}

    def candidates(self, query) -> np.ndarray:
        """Rows, ascending, that meet the query."""
        if query is None:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[query]
        found = sorted(map(self.candidates, query[1]), key=len)
        out = found[0]
        for more in found[1:]:
            out = np.intersect1d(out, more, True) if query[0] == "and" else np.union1d(out, more)
        return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text") -> DataFrame:
    """docs without the text, with ``spans``: array of (kind, start, end), by start and then by the order of the rules."""
    bound_batches(docs.sparkSession)
    keep = others(docs, text, "spans")
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("spans", T.ArrayType(span), False)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    queries = [trigram_query(rule.index or rule.pattern) for rule in rules]
    vocabulary = sorted(set().union(*map(trigrams, queries)))
    names = [rule.kind for rule in rules]

    def run(batches):
        searches = [(rule.compiled().finditer, rule.keep) for rule in rules]
        known = Vocabulary(vocabulary)
        for batch in slices(batches, text):
            texts = batch.column(text).fill_null("")
            block, found = Block(texts, known), [[] for _ in range(batch.num_rows)]
            for k, (query, (search, keeps)) in enumerate(zip(queries, searches, strict=True)):
                for i in block.candidates(query).tolist():
                    found[i] += [(m.start(), k, m.end()) for m in search(texts[i].as_py()) if keeps(m)]
            spans = [[{"kind": names[k], "start": a, "end": b} for a, k, b in sorted(x)] for x in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(spans, arrow)], names=[*keep, "spans"])

    return docs.select(*keep, text).mapInArrow(run, schema)
