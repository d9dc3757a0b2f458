"""The n-gram Jaccard join against all pairs, on small tables."""

import random

import pytest

from chainframe.llm import jaccard


def plain(rows, n=5, threshold=0.8):
    """(class_id, n_links) by key, by comparing all pairs."""

    def grams(text):
        words = (text or "").encode().split()
        k = min(n, len(words))
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()

    sets = {i: grams(t) for i, t in rows}
    root, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(sets)
    for x, a in enumerate(keys):
        for b in keys[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (find(i), links[i]) for i in keys}


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    rows = []
    for group in range(12):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([3, 30, 120]))]
        for copy in range(draw.choice([1, 2, 6])):
            changed = list(words)
            for _ in range(copy % 4):
                changed[draw.randrange(len(changed))] = f"x{draw.randrange(99)}"
            rows.append((len(rows), " ".join(changed)))
    rows += [(len(rows) + k, rows[3][1]) for k in range(5)]  # exact copies
    rows += [(len(rows) + k, t) for k, t in enumerate((None, "", " \n ", "one", "one", "é " * 40, " one"))]
    return rows


@pytest.mark.parametrize("block", [3, 1024])
def test_equals_all_pairs(spark, texts, block):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(docs, block=block).collect()}
    assert got == plain(texts)


def test_blocks_bounded_by_ngrams(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.classes(docs, block_grams=150).collect()}
    assert got == plain(texts)


def test_a_key_with_several_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, one), (1, two), (2, one + " z"), (3, two), (3, two), (1, None), (4, None)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    root = {r.digest: r.root for r in got}
    by_key = {}
    for r in got:
        by_key.setdefault(r.doc_id, set()).add(root[r.digest])
    assert len(got) == len(rows)
    assert len(by_key[1]) == 3 and by_key[2] < by_key[1] and by_key[3] < by_key[1] and by_key[2] != by_key[3]  # tied to its own text only
    assert sorted(r.n_links for r in got) == [0, 0, 1, 1, 2, 2, 2]


def test_long_near_copies_in_bounded_memory():
    """One block of long near copies: the index stays near 16 bytes an n-gram and pairs come in parts."""
    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(50_000)]
    texts = []
    for copy in range(30):
        words = list(base)
        for _ in range(copy * 60):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        texts.append(jaccard.ngrams(" ".join(words), {}))
    block = jaccard.Block(texts, (1 << jaccard.BANDS) - 1)
    want = [len(set(texts[29].tolist()) & set(g.tolist())) for g in texts]
    assert block.common(texts[29], jaccard.np.arange(30)).tolist() == want
    assert sum(x.nbytes for x in block.index) <= 20 * sum(map(len, texts))


def test_clashing_columns_null_keys_and_repeats(spark):
    rows = [(1, "a b c d e f", 9), (1, "a b c d e f", 9), (2, "a b c d e f", 9), (None, "a b c d e f", 9)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string, id long").withColumnsRenamed({"id": "digest"}))
    assert got.columns == ["doc_id", "class_id", "text_id", "n_copies", "n_links"]
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in got.collect()) == [(0, 0), (1, 1), (1, 1), (2, 1)]


def test_empty(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_prune_table_keeps_what_may_link():
    table = jaccard.prune_table(128, 0.8, 1e-6)
    assert all(0 <= least < n for n, least in table.items())
    assert table[128] > 60  # far below the threshold a pair goes


def test_buckets_are_dealt_out_once(spark, monkeypatch):
    plans, cut = [], jaccard.cut

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)

    monkeypatch.setattr(jaccard, "cut", noted)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 59 - i % 3])) for i in range(9)] + [(9, "alone " * 7)]
    with_joins_by_sort = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_joins_by_sort)
    assert got == plain(rows)
    dealt = [p for p in plans if "posexplode" in p]
    assert len(dealt) == 1 and dealt[0].count("posexplode") == dealt[0].count("Exchange hashpartitioning") == 1
