"""Quality rules as weak supervision.

Each rule looks at counts of a document and votes good, bad, or abstains. How far a rule is to be
trusted is not fixed beforehand: expectation maximisation over the votes of all documents estimates,
for each rule, how often it is right on good and on bad documents, and each document gets the posterior
probability that it is good. That probability decides, not one failed rule.

Documents with equal votes are alike to the model, and R rules have at most 3^R vote patterns, so Spark
counts patterns over all documents and the estimation works on that bounded table.

Null texts have no words; every count is then 0 and base_failed is true. Repeated rows and null keys are kept;
further columns are carried, but for those named like a result, which are replaced; an empty table gives an empty result. Very long texts
are counted whole: a worker holds the text, its lines, some 60 bytes a word and its distinct words.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.common import ASCII_SPACE, bound_batches, cut, others, slices

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marks", "n_short")
#: What the rules add to COUNTS; _votes stands for them on the way.
RESULTS = ("p_good", "base_failed", "kept", "_votes")
ROUNDS = 50
#: Votes, (right, wrong), that a rule is credited with beforehand on good and on bad documents. A good
#: document passes nearly every rule, while a bad one may fail just one of them.
CREDIT_GOOD, CREDIT_BAD = (49.0, 1.0), (2.0, 3.0)
GOOD_SHARE = 0.8  # where the share of good documents starts


_GAP = re.compile(rb"[\x20\t-\r]")


def _words(data: bytes, part: int = 1 << 16) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + part)
        stop = gap.start() if gap else len(data)
        yield data[at:stop].split()  # bytes split at the six ASCII white spaces only
        at = stop


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words in windows of three that stand twice or more. Windows are numbered exactly, in two steps of pairs."""
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)[1]
    _, window, times = np.unique(pairs * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : len(again) + k] |= again
    return int(inside.sum())


def counts(text: str) -> tuple[int, ...]:
    """COUNTS of a text."""
    known: dict[bytes, int] = {}
    numbers = array("q")
    for words in _words(text.encode()):
        numbers.extend([known.setdefault(w, len(known)) for w in words])
    ids = np.frombuffer(numbers, np.int64) if numbers else np.zeros(0, np.int64)
    short = np.fromiter((len(w) <= 3 and w.islower() for w in known), bool, len(known))
    lines = [line for line in text.split("\n") if line.strip(ASCII_SPACE)]
    return (
        len(ids),
        len(text) - sum(map(text.count, ASCII_SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(ids, len(known)),
        len(lines),
        sum(map(str.isalpha, text)),
        sum(map(str.isupper, text)),
        text.count("!"),
        int(short[ids].sum()),
    )


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with COUNTS."""
    bound_batches(docs.sparkSession)
    keep = others(docs, text, *COUNTS, *RESULTS)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType(), False) for c in COUNTS])

    def run(batches):
        for batch in slices(batches, text):
            made = list(zip(*(counts(t or "") for t in batch.column(text).to_pylist()), strict=True)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x, pa.int64()) for x in made)], names=[*keep, *COUNTS])

    return docs.select(*keep, text).mapInArrow(run, schema)


def rules() -> dict[str, Column]:
    """Votes over COUNTS: 1 good, 0 bad, null abstains."""

    def low_is_good(part: Column, whole: str, good: float, bad: float) -> Column:
        share = part / F.greatest(F.col(whole), F.lit(1))
        return F.when(share <= good, 1).when(share >= bad, 0)

    def high_is_good(part: Column, whole: str, good: float, bad: float) -> Column:
        return low_is_good(-part, whole, -good, -bad)

    length = F.col("word_chars") / F.greatest("n_words", F.lit(1))
    return {
        "symbols": low_is_good(F.col("n_symbols"), "n_words", 0.05, 0.25),
        "dup_lines": low_is_good(F.col("n_dup_lines"), "n_lines", 0.05, 0.3),
        "repeats": low_is_good(F.col("n_repeat_words"), "n_words", 0.1, 0.3),
        "shouting": low_is_good(F.col("n_upper"), "n_letters", 0.2, 0.4),
        "marks": low_is_good(F.col("n_marks"), "n_words", 0.05, 0.2),
        "letters": high_is_good(F.col("n_letters"), "word_chars", 0.85, 0.6),
        "word_length": F.when(length.between(3, 9), 1).when(~length.between(2, 14), 0),
        "function_words": high_is_good(F.col("n_short"), "n_words", 0.15, 0.04),
    }


def estimate(votes: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Expectation maximisation over vote patterns (1, 0, -1 abstains) and their numbers.

    Returns the share of good documents, each rule's accuracy on good and on bad ones, and each
    pattern's posterior. Rules are held to be better than chance (the two accuracies exceed 1
    together), which settles which of the two classes is the good one.
    """
    share, (on_good, on_bad) = GOOD_SHARE, (np.full(votes.shape[1], c[0] / sum(c)) for c in (CREDIT_GOOD, CREDIT_BAD))
    yes, no = votes == 1, votes == 0
    posterior = np.full(len(votes), share)
    for _ in range(rounds):
        good = math.log(share) + yes @ np.log(on_good) + no @ np.log(1 - on_good)
        bad = math.log(1 - share) + yes @ np.log(1 - on_bad) + no @ np.log(on_bad)
        posterior = 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))
        g, b = weights * posterior, weights * (1 - posterior)
        share = float(np.clip(g.sum() / max(weights.sum(), 1), 0.01, 0.99))
        on_good = np.clip((g @ yes + CREDIT_GOOD[0]) / (g @ (yes | no) + sum(CREDIT_GOOD)), 0.51, 0.9999)
        on_bad = np.clip((b @ no + CREDIT_BAD[0]) / (b @ (yes | no) + sum(CREDIT_BAD)), 1.01 - on_good, 0.9999)
    return share, on_good, on_bad, posterior


def judge(counted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``p_good``, ``base_failed`` and ``kept``. counted: a table that costs little to read twice."""
    named = rules()
    pattern = sum(((F.coalesce(vote, F.lit(2)) * 3**i) for i, vote in enumerate(named.values())), start=F.lit(0)).cast("int")
    voted = counted.withColumn("_votes", pattern)
    found = voted.groupBy("_votes").count().collect()  # at most 3^rules rows
    codes = np.array([r[0] for r in found], int)
    votes = np.array([[(c // 3**i) % 3 for i in range(len(named))] for c in codes]).reshape(-1, len(named))
    posterior = estimate(np.where(votes == 2, -1, votes), np.array([r[1] for r in found], float))[3] if len(codes) else []
    table = counted.sparkSession.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)], "_votes int, p_good double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.join(F.broadcast(table), "_votes")
        .drop("_votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("p_good") >= threshold))
    )


def assess(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs without the text, with COUNTS, p_good, base_failed and kept; texts are read once."""
    return judge(cut(with_counts(docs, text), "quality"), threshold)
