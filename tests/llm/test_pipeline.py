"""The corpus pipeline, stage by stage, against plain readings of what each stage must do."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
import pytest

from chainframe.llm.common import cut
from tests.llm import test_bpe, test_jaccard, test_pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"test-{name.replace(' ', '-')}")
        out.append(docs.collect())
    return out


def test_language_keeps_texts_with_letters(results):
    before, after = results[:2]
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before if any(map(str.isalpha, r.text or ""))}
    assert len(kept) > 0.8 * sum(any(map(str.isalpha, r.text or "")) for r in before)
    right = [r.lang == x.lang for r in after for x in before if x.doc_id == r.doc_id and x.lang]
    assert sum(right) > 0.95 * len(right)


def test_one_document_of_each_group_stays(results):
    before, after = results[1:3]
    want = test_jaccard.plain([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(i for i, (root, _) in want.items() if i == root)


def test_personal_data_is_masked(results):
    before, after = ({r.doc_id: r for r in x} for x in results[2:4])
    assert before.keys() == after.keys()
    for i, r in after.items():
        found = test_pii.plain(before[i].text)
        assert not found or r.text != before[i].text
        assert not any(re.fullmatch("email|ip", x.split(":")[0]) for x in test_pii.plain(r.text))
        assert r.n_chars == len(r.text)


def test_mixture_takes_rows_whole(results):
    before, after = ({r.doc_id: r for r in x} for x in results[3:5])
    copies = Counter(r.doc_id for r in results[4])
    assert max(copies.values()) <= 2
    assert all(after[i] == before[i] for i in after)


def test_tokens(results):
    before, after = results[4:6]
    want = Counter((r.doc_id, hashlib.sha256(" ".join(map(str, test_bpe.PLAIN.encode_ordinary(r.text))).encode()).hexdigest()) for r in before)
    assert Counter((r.doc_id, r.ids_sha256) for r in after) == want


def test_columns_and_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"empty-{name.replace(' ', '-')}")
        assert docs.count() == 0
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == COLUMNS


def test_mixed_language_documents_stay(spark, sf_dir):
    parts = {
        "en": "the quick brown fox jumps over the lazy dog and runs home", "de": "der schnelle braune fuchs springt über den faulen hund nach hause",
        "ru": "быстрая лиса прыгает через ленивую собаку домой",
    }
    rows = [(i * 3 + k, t, lang, "web", len(t)) for i in range(40) for k, (lang, t) in enumerate(parts.items())]
    mixed = {1000: " ".join(parts.values()), 1001: f"{parts['en']} {parts['de']}", 1002: f"{parts['de']} {parts['ru']}", 1003: " ".join([*parts.values()] * 2)}
    rows += [(i, t, None, "web", len(t)) for i, t in mixed.items()] + [(2000, "12 !", None, "web", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in corpus_pipeline.language_id(spark, docs, sf_dir).collect()}
    assert {i: kept.get(i) for i in mixed} == mixed
    assert kept.keys() == {r[0] for r in rows} - {2000}
