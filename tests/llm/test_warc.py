"""WARC: exact round trips, revisits, ranges and odd rows."""

import gzip
import hashlib

import duckdb

from chainframe.llm import queries, warc

BIG = "é<html>" + "x" * 200
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3", "small"), (4, None, "small"), (5, "http://b/\r\n5", None), (6, "http://b", ""), (None, "http://c", BIG), (2, "http://a/2", BIG), (7, "u", "y" * 99), (8, "u", "y" * 99), (9, "u", "z" * 2_000_000)]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path, index = warc.write(pages.repartition(3))
    got = warc.read(path, index, payload=True).collect()
    assert len(got) == len(ROWS)
    by_key = {}
    for r in got:
        by_key.setdefault(r.key, []).append(r)
    bodies = {str(k) if k is not None else "null": (b or "").encode() for k, _, b in ROWS}
    for key, body in bodies.items():
        for r in by_key[key]:
            assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
            if r.record_type == "response":
                assert bytes(r.payload) == body and r.refers_to is None
    kinds = {k: sorted((r.record_type, r.refers_to) for r in v) for k, v in by_key.items()}
    assert kinds["1"] == [("response", None)]
    assert kinds["2"] == [("revisit", "1")] * 2
    assert kinds["null"] == [("revisit", "1")]
    assert all(kinds[k] == [("response", None)] for k in "3456789")


def test_a_selection_is_read_by_few_ranges(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"body {i} " * 30) for i in range(500)], "page_id long, url string, html string")
    path, index = warc.write(pages)
    chosen = index.where("cast(key as long) % 7 = 0")
    assert sorted(int(r.key) for r in warc.read(path, chosen).collect()) == list(range(0, 500, 7))
    assert warc.ranges(chosen).count() < chosen.count() / 5
    one = index.where("key = '8'").first()
    with open(f"{path.removeprefix('file://')}/{one.file}", "rb") as f:
        f.seek(one.offset)
        assert gzip.decompress(f.read(one.length)).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_query_over_pages(spark, sf_dir):
    pages = queries.table(spark, sf_dir, "pages").select("page_id", "html").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    got = {r.page_id: r for r in queries.op9_warc(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for r in pages:
        body = (r.html or "").encode()
        again = len(body) >= 100 and first[r.html] != r.page_id
        assert tuple(got[r.page_id]) == (r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[r.html] if again else None)


def test_empty(spark):
    path, index = warc.write(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read(path, index).collect() == []


def test_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf_dir}/pages.parquet')")
    rel = con.execute(queries.oracle_sql()["op9_warc"])
    want = sorted(rel.fetchall())
    assert [d[0] for d in rel.description] == queries.op9_warc(spark, sf_dir).columns
    assert want == sorted(map(tuple, queries.op9_warc(spark, sf_dir).collect()))
