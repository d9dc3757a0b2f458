"""Quality rules: counts against the contract's plain reading, and the estimate on votes of known accuracy."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from chainframe.llm import queries, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    n, repeats = len(words), len(inside)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(k - 1 for k in Counter(lines).values()), repeats, n < 50 or 100 * repeats > 50 * n


EDGES = [None, "", " \t\n", "a b c a b c", "x\nx\n\n \nx ", "é ü #|<", "a a a a a", "word " * 300, "\n".join(["one two three four"] * 30)]


def test_counts(spark):
    docs = spark.createDataFrame(list(enumerate(EDGES)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.assess(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(EDGES)}


def test_query_over_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op3_quality_rules(spark, sf_dir).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    long = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept for r in long]) > 0.6  # clean documents stay


def test_estimate_recovers_accuracies():
    draw = np.random.default_rng(3)
    good = draw.random(20_000) < 0.7
    right = np.array([0.9, 0.85, 0.8, 0.75, 0.9])
    votes = np.where(draw.random((len(good), 5)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[draw.random(votes.shape) < 0.2] = -1
    share, on_good, on_bad, posterior = quality.estimate(votes, np.ones(len(votes)))
    assert share == pytest.approx(0.7, abs=0.03)
    assert on_good == pytest.approx(right, abs=0.03)
    assert on_bad == pytest.approx(right, abs=0.05)
    assert ((posterior > 0.5) == good).mean() > 0.93


def plain_estimate(votes, rounds=quality.ROUNDS):
    """Posterior of each document by expectation maximisation over single documents, in plain loops."""
    rules = range(len(votes[0]))
    share, good, bad = quality.GOOD_SHARE, [quality.CREDIT_GOOD[0] / sum(quality.CREDIT_GOOD)] * len(rules), [quality.CREDIT_BAD[0] / sum(quality.CREDIT_BAD)] * len(rules)
    for _ in range(rounds):
        posterior = []
        for v in votes:
            a, b = share, 1 - share
            for k in rules:
                if v[k] >= 0:
                    a *= good[k] if v[k] else 1 - good[k]
                    b *= 1 - bad[k] if v[k] else bad[k]
            posterior.append(a / (a + b))
        share = min(0.99, max(0.01, sum(posterior) / len(votes)))
        for k in rules:
            mass = [(p, v[k]) for p, v in zip(posterior, votes, strict=True) if v[k] >= 0]
            good[k] = min(0.9999, max(0.51, (sum(p for p, x in mass if x) + quality.CREDIT_GOOD[0]) / (sum(p for p, _ in mass) + sum(quality.CREDIT_GOOD))))
            bad[k] = min(0.9999, max(1.01 - good[k], (sum(1 - p for p, x in mass if not x) + quality.CREDIT_BAD[0]) / (sum(1 - p for p, _ in mass) + sum(quality.CREDIT_BAD))))
    return posterior


def test_kept_is_that_of_a_plain_estimate(spark, sf_dir):
    counted = quality.with_counts(queries.table(spark, sf_dir, "documents").select("doc_id", "text")).cache()
    voted = counted.select("doc_id", *(quality.F.coalesce(v, quality.F.lit(-1)).alias(f"r{i}") for i, v in enumerate(quality.rules().values()))).collect()
    want = dict(zip([r.doc_id for r in voted], plain_estimate([tuple(r)[1:] for r in voted]), strict=True))
    for r in quality.judge(counted).collect():
        assert r.p_good == pytest.approx(want[r.doc_id], abs=1e-9)
        assert r.kept == (not r.base_failed and want[r.doc_id] >= 0.5)


def test_a_very_long_text():
    text = " ".join(f"w{i % 70_001}" for i in range(300_000)) + "\n" + "x" * 200_000
    n, chars, symbols, dup, repeats, _ = plain(text)
    assert quality.counts(text)[:5] == (n, chars, symbols, dup, repeats)
    assert math.isclose(repeats, 300_000, abs_tol=5)


def test_columns_named_like_results_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "k", 0.5, 9)], "doc_id long, text string, N_words int, kept string, p_good double, other int")
    got = quality.assess(docs)
    assert got.columns == ["doc_id", "other", *quality.COUNTS, "p_good", "base_failed", "kept"]
    assert [(r.n_words, r.kept, r.other) for r in got.collect()] == [(2, False, 9)]


def test_empty_and_clashing_columns(spark):
    assert quality.assess(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = quality.assess(spark.createDataFrame([(None, "a b", "x"), (None, "a b", "x")], "doc_id long, text string, lang string"))
    assert [(r.doc_id, r.lang, r.n_words) for r in got.collect()] == [(None, "x", 2)] * 2
