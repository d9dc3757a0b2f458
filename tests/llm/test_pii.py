"""Personal data: base spans against plain expressions, and what the pattern graph adds."""

import hashlib
import math
import random
import re
import time

from chainframe.llm import pii, queries


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def only_digits(m):
    return re.sub("[^0-9]", "", m[0])


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m)) <= 15),
}


def plain(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, (p, keep)) in enumerate(KINDS.items()) for m in re.finditer(p, text or "") if keep(m)]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]


def made(n=400):
    draw = random.Random(8)
    bits = ["a", "b.c", "@", "@", ".", "..", "-", "+", "+1", " ", "%", "x.com", "é", "\U0001f600", "1", "255", "256", "010", "192.168.0.1", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "(555)", "123-4567", "+44 20 7946 0958", "\n"]
    return ["".join(draw.choices(bits, k=draw.randrange(30))) for _ in range(n)]


def test_base_spans(spark):
    texts = [None, "", *made(), "z" * 100_000 + " me@x.org " + "1." * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in docs.select("doc_id", pii.base_spans(docs["text"]).alias("spans")).collect():
        got = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans or []]
        assert got == plain(texts[r.doc_id]), texts[r.doc_id]


def test_query_over_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op5_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in KINDS]
        assert not want or set(want) <= set(r.spans.split(","))


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"please write to user{i}@mail.example.org for more") for i in range(30)]
    rows += [(100, "please write to gandalf99321 for more"), (101, "the room 4711000 is free"), (102, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(docs).collect()}
    assert found[100] == ["id"]
    assert found[101] == found[102] == []
    assert all(found[i] == ["email"] for i in range(30))


def test_redact_and_edges(spark):
    docs = spark.createDataFrame([(1, "to a@b.co, or +44 20 7946 0958.", "x"), (None, None, "x"), (2, "clean", "x"), (2, "clean", "x")], "doc_id long, text string, base string").withColumnRenamed("base", "kind")
    got = sorted((r.doc_id or 0, r.text, r.kind) for r in pii.redact(docs).collect() if r.text)
    assert got == [(1, "to <EMAIL>, or <PHONE>.", "x"), (2, "clean", "x"), (2, "clean", "x")]
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def plain_masked(text, spans):
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_many_matches_in_one_text(spark):
    """Positions, contexts and masks over several chunks of matches and segments; 20,000 addresses in one row end soon."""
    draw = random.Random(4)
    log = " ".join(f"{draw.choice(['é', 'x', '😀' * 3])} user{i}@mail{i % 7}.example.org 10.0.{i % 256}.{i % 251}" for i in range(1_500))
    long = "\n".join(f"from user{i}@example.org" for i in range(20_000))
    rows = [(1, log), (2, long), (3, "z" * 5_000 + " a@b.co " + "y" * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.monotonic()
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert time.monotonic() - began < 90
    for i, text in rows:
        base = [f"{x.kind}:{x.start}:{x.end}" for x in spans[i] if x.kind != "id"]
        assert base == plain(text)
        assert masked[i] == plain_masked(text, [(x.start, x.end, x.kind) for x in spans[i]])


def test_mask_of_overlapping_spans(spark):
    draw = random.Random(6)
    rows = []
    for i in range(150):
        text = "".join(draw.choices("ab é😀\n", k=draw.choice([0, 5, 60, 2_047, 2_048, 2_049, 7_000])))
        ends = sorted(draw.sample(range(len(text) + 1), min(len(text) + 1, 2 * draw.randrange(1, 8))))
        spans = sorted((a, 0, min(len(text), b + draw.choice([0, 0, 3])), draw.choice(["ip", "card"])) for a, b in zip(ends[::2], ends[1::2], strict=False))
        rows.append((i, text, spans))
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    got = {r.doc_id: r.masked for r in docs.select("doc_id", pii.mask(docs["text"], docs["spans"]).alias("masked")).collect()}
    assert got == {i: plain_masked(t, [(a, b, k) for a, _, b, k in spans]) for i, t, spans in rows}


def plain_graph(mentions, rounds=pii.ROUNDS):
    """Confidence by pattern, round by round, without Spark."""
    edges = {}
    for pattern, value, known in mentions:
        edges[pattern, value] = edges.get((pattern, value), False) or known
    known = {}
    for (_, value), k in edges.items():
        known[value] = known.get(value, False) or k
    score, confidence = {v: float(k) for v, k in known.items()}, {}
    for _ in range(rounds):
        confidence = {}
        for pattern in {p for p, _ in edges}:
            mine = [v for p, v in edges if p == pattern]
            if len(mine) >= pii.LEAST_INSTANCES:
                confidence[pattern] = sum(score[v] for v in mine) / (len(mine) + pii.DOUBT)
        for v in known:
            if not known[v]:
                score[v] = 1 - math.prod(1 - min(confidence[p], 0.99) for p, x in edges if x == v and p in confidence)
    return confidence


def test_the_graph_is_the_plain_one(spark):
    draw = random.Random(9)
    mentions = [(f"p{draw.randrange(15)}", f"v{draw.randrange(60)}", draw.random() < 0.4) for _ in range(300)]
    got = {r.pattern: r.confidence for r in pii.score(spark.createDataFrame(mentions, "pattern string, value string, known boolean")).collect()}
    want = plain_graph(mentions)
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.co", 7, "b", "r")], "doc_id long, text string, SPANS int, base string, row string")
    got = pii.find(docs)
    assert got.columns == ["doc_id", "base", "row", "spans"] and got.first().base == "b"
    assert pii.redact(docs).collect() == [(1, "<EMAIL>", 7, "b", "r")]


def test_short_identifiers_and_numbers_beside_them(spark):
    rows = [(i, f"please write to user{i}@mail.example.org for more") for i in range(30)]
    rows += [(100 + i, f"customer {i} number c{i}@mail.example.org") for i in range(30)]
    rows += [(200, "please write to gandalf99 for more"), (201, "please write to AB1 for more"), (202, "customer 5 number A12345"), (203, "room 5 is number 12 of 99")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(docs).collect()}
    assert found[200] == [("id", 16, 25)]
    assert found[201] == [("id", 16, 19)]
    assert found[202] == [("id", 18, 24)]
    assert found[203] == []


def test_context_is_the_whole_text_around(spark):
    draw = random.Random(3)
    bits = ["a1", "7", "word", " ", " ", ",", "@x", "é", "\U0001f600", "\n", "z" * 90, "1-2"]
    texts = ["".join(draw.choices(bits, k=draw.randrange(40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.matches(docs["text"], pii.IDENTIFIER, lambda m: m != "7", context=True)
    for r in docs.select("doc_id", found.alias("found")).collect():
        t = texts[r.doc_id]
        assert all((m.value, m.before, m.after) == (t[m.start : m.end], t[max(0, m.start - 80) : m.start], t[m.end : m.end + 80]) for m in r.found)
