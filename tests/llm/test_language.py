"""Language identification: held-out accuracy, mixed texts, and the Viterbi pass against a plain one."""

import numpy as np
import pytest

from chainframe.llm import language, queries


def test_held_out_accuracy(spark, sf_dir):
    docs = {r.doc_id: r for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang").collect()}
    rows = queries.op10_language_id(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    asked = [r for r in rows if r.held_out and docs[r.doc_id].lang and any(map(str.isalpha, docs[r.doc_id].text or ""))]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in asked]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for i in range(40) for t, lang in ((f"the quick brown fox jumps over the lazy dog and runs home {i}", "en"), (f"der schnelle braune fuchs springt über den faulen hund nach hause {i}", "de"), (f"быстрая лиса прыгает через ленивую собаку домой {i}", "ru"))]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_mixed_text_and_edges(spark, model):
    texts = ["the brown dog runs over home der braune hund springt nach hause", "лиса домой", "", None, "123 !!", "the " * 20_000, "собаку"]
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert [s.lang for s in got[0].lang_spans] == ["en", "de"]
    assert [(s.start, s.end) for s in got[1].lang_spans] == [(0, len(texts[1]))]
    assert [(s.start, s.end) for s in got[5].lang_spans] == [(0, len(texts[5]) - 1)]
    assert got[0].lang_spans[1].start == texts[0].index("der")
    assert (got[1].lang_pred, got[6].lang_pred, got[5].lang_pred) == ("ru", "ru", "en")
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (2, 3, 4))


def test_numerals_are_no_letters_and_marks_stay_in_words(spark, model):
    assert language.WORDS.findall("हिन्दी भाषा 12 ½ ² ① Ⅷ don't e\u0301te\u0301") == ["हिन्दी", "भाषा", "don", "t", "e\u0301te\u0301"]
    got = language.predict(spark.createDataFrame([(i, t) for i, t in enumerate(("½", "² ①", "Ⅷ", "\u0301", "٣"))], "doc_id long, text string"), model).collect()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got)


def test_clashing_columns_are_replaced(spark, model):
    docs = spark.createDataFrame([(1, "the brown dog runs over", "x", 7)], "doc_id long, text string, Lang_Pred string, score long")
    got = language.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "lang_spans"]
    assert got.first().lang_pred == "en"


def test_many_labels_share_buckets(spark):
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)} " * 5, f"l{i}") for i in range(300)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.labels) == 300 and model.logs.size <= language.MODEL_NUMBERS


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(4)
    scores = [draw.normal(scale=4, size=(n, 3)).astype(np.float32) for n in (1, 4, 6, 7)]
    found = language.paths(scores, 3.0)

    def value(x, path):
        return sum(float(x[i, k]) for i, k in enumerate(path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))

    for x, path in zip(scores, found, strict=True):
        best = max(value(x, p) for p in np.ndindex(*[3] * len(x)))
        assert value(x, path) == pytest.approx(best, abs=1e-3)


def test_spans_stand_where_their_words_do():
    draw = np.random.default_rng(5)
    for _ in range(300):
        text = "".join(draw.choice(["a", "b", "ab", " ", "1", "e\u0301", "\u0301", "x" * 30, "-"], draw.integers(1, 30)))
        words = list(language.WORDS.finditer(text))
        path = draw.integers(0, 2, len(words))
        if len(words):
            turns = [i for i in range(len(words)) if i == 0 or path[i] != path[i - 1]]
            want = [(words[a].start(), words[b - 1].end()) for a, b in zip(turns, [*turns[1:], len(words)], strict=True)]
            assert [(s["start"], s["end"]) for s in language._spans(text, [w[0] for w in words], path, ["x", "y"])] == want


def test_a_text_does_not_depend_on_its_neighbours():
    draw = np.random.default_rng(8)
    scores = [draw.normal(scale=4, size=(n, 4)).astype(np.float32) for n in draw.integers(1, 90, 40).tolist() + [700, 400]]
    together = language.viterbi(scores, 6.0)
    assert all((a == language.viterbi([x], 6.0)[0]).all() for a, x in zip(together, scores, strict=True))


def test_nothing_to_learn_from(spark):
    model = language.fit(spark.createDataFrame([(1, None, "en"), (2, "a", None)], "doc_id long, text string, lang string"))
    got = language.predict(spark.createDataFrame([(1, "word", "x")], "doc_id long, text string, label string"), model).collect()
    assert [(r.lang_pred, r.score, r.label) for r in got] == [("und", 0.0, "x")]
    assert language.predict(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_rare_labels_are_learnt_from_a_bounded_sample(spark):
    rows = [(i, f"the quick brown fox jumps over the lazy dog {i}", "en") for i in range(2000)]
    rows += [(9000 + i, "быстрая лиса прыгает через ленивую собаку", "ru") for i in range(3)] + [(9100, "der schnelle braune fuchs springt über den faulen hund", "de")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=40)
    assert model.labels == ["de", "en", "ru"]
    got = language.predict(spark.createDataFrame([(1, "лиса прыгает через собаку"), (2, "braune fuchs springt über hund"), (3, "the lazy dog")], "doc_id long, text string"), model).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == [(1, "ru"), (2, "de"), (3, "en")]
    learnt = {name: model.logs[:, i] for i, name in enumerate(model.labels)}
    assert all((x > x.min()).any() for x in learnt.values())


def test_quota():
    draw = np.random.default_rng(7)
    for _ in range(200):
        sizes, total = draw.integers(1, 50, draw.integers(1, 8)).tolist(), int(draw.integers(10, 200))
        most = language._quota(sizes, total)
        taken = sum(min(n, most) for n in sizes)
        assert taken <= total and (most >= max(sizes) or sum(min(n, most + 1) for n in sizes) > total)
