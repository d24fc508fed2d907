"""Source divergence, archives and ranked search: odd rows against SQL, small tiles and blocks, damage, brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sparrowmill.llm import divergence, terms, warc, wavelet
from tests.oracle import assert_same

DOCS = "text string, lang string, source string, doc_id long, term string, p long, n long"


def invented(rnd, n, letters="abcé9"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def docs(rnd, many=140):
    rows = [(None, "x", "y"), ("", None, "y"), (" \n\x00", "only", "empty"), ("Ab aB ab AB", None, None), ("word " * 4000 + "Éclair", "x", "y")]
    rows += [("same text here", "x", "y")] * 4 + [("one of its kind", "lone", "s")]
    for _ in range(many):
        rows.append((invented(rnd, rnd.randint(0, 60)), rnd.choice("xxz"), f"s{rnd.randint(0, 39) if rnd.random() < 0.6 else 0}"))
    return [(*r, k // 2 if k else None, "clash", 7, 8) for k, r in enumerate(rows)]


def folder(spark, tmp_path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_terms_of_a_batch():
    texts = ["Ab-ab", None, "", "x", "yÉ z", "-"]
    t = terms.split(pa.array(texts), divergence.STOP)
    known = [x.decode() for x in t.known.to_pylist()]
    assert [[known[c] for c in t.codes[a:b]] for a, b in zip(t.bounds, t.bounds[1:])] == [["ab", "ab"], [], [], ["x"], ["yÉ", "z"], []]
    assert terms.count(pa.array(texts), divergence.STOP).tolist() == [2, 0, 0, 1, 2, 0]


@pytest.mark.parametrize("block, chunk, span", [(16, 2048, 16), (3, 8, 2)])
def test_divergence_of_odd_rows(spark, tmp_path, monkeypatch, block, chunk, span):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "SPAN", span)
    d = folder(spark, tmp_path, documents=(docs(random.Random(3)), DOCS))
    assert_same(divergence.query(spark, d), divergence.SQL, d)


def test_divergence_of_nothing(spark, tmp_path):
    d = folder(spark, tmp_path, documents=([], DOCS))
    assert divergence.query(spark, d).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    rows = [(c, n) for n in (3, 10**12 + 7, 9 * 10**15) for c in (0, 1, n // 3, n - 1)]
    want = [1 + 10**9 * (c + 1) // n for c, n in rows]
    df = spark.createDataFrame(rows, "c long, n long")
    assert [r[0] for r in df.select(divergence.share(df["c"], df["n"])).collect()] == want
    assert divergence._shares(np.array([c for c, _ in rows]), np.array([n for _, n in rows])).tolist() == want


PAGES = "html string, page_id long, url string, key string, digest string"
LONG = "<p>" + "long and equal " * 20


def pages():
    rows = [(LONG, 5), (LONG, 3), (LONG, 3), (LONG, None), ("short", 1), ("short", 2), (None, 8), ("", 9), ("é" * 50, 11), ("é" * 50, 12), ("é" * 49, 13)]
    rows += [("null ids " * 20, None)] * 2 + [("\r\n\r\nWARC/1.1\r\n" * 30000, 20), (None, None)]
    urls = [None, "", "http://a.b/c d\r\n\te", "HTTPS://U@X.Example.org:8443/p?q=%20#f", "http://x.example.org:80", "no scheme", "é.fr/ü", "http://" + "h." * 400]
    return [(h, i, urls[k % len(urls)], "clash", "clash") for k, (h, i) in enumerate(rows)]


@pytest.mark.parametrize("records", [3000, 2])
def test_archives_of_odd_rows(spark, tmp_path, monkeypatch, records):
    monkeypatch.setattr(warc, "RECORDS", records)
    d = folder(spark, tmp_path, pages=(pages(), PAGES))
    assert_same(warc.query(spark, d), warc.SQL, d)


def test_archives_of_nothing(spark, tmp_path):
    d = folder(spark, tmp_path, pages=([], PAGES))
    assert warc.query(spark, d).count() == 0


def test_keys(spark):
    urls = ["http://Blog.Example.com/a?b#c", "https://u:p@x.org:443/", "x.org:8080", None, "http://a.b/c d", "h/" + "é" * 300]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(warc.surt(df["u"])).collect()]
    assert got[:5] == ["com,example,blog)/a?b", "org,x)/", "org,x:8080)", ")", "b,a)/c%20d"]
    assert len(got[5].encode()) <= warc.KEY


def test_lookup_of_an_address_and_damage(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 3)
    rows = [(k, f"http://{'hot' if k % 2 else f'h{k}'}.org/p", f"page {k}") for k in range(40)]
    stored = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.store(stored)
    assert len(index.directory) >= 13
    wanted = spark.createDataFrame([("org,hot)/p",), ("org,h4)/p",), ("org,none)/",)], "key string")
    captures = warc.lookup(index, wanted)
    got = warc.read(index, captures).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == sorted((k, f"page {k}") for k in range(40) if k % 2 or k == 4)
    member = warc.record(1, "http://a/\r\nX: y", b"payload", warc.hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="payload"):
        warc.parse(member)
    store, root = warc._store(index.archives)
    for info in store.get_file_info(warc.pafs.FileSelector(root)):
        with store.open_output_stream(info.path, compression=None) as f:
            f.write(b"lost")
    with pytest.raises(Exception, match="ends within a record"):
        warc.read(index, captures).collect()
    warc.remove(spark, index)


ITEMS = "text string, item_id long, score long"


@pytest.mark.parametrize("items, shard_bytes", [(4096, 8 << 20), (3, 500)])
def test_search_of_odd_rows(spark, tmp_path, monkeypatch, items, shard_bytes):
    rnd = random.Random(5)
    monkeypatch.setattr(wavelet, "ITEMS", items)
    asked = [(None, 1, 0), ("", 2, 0), ("unknown Words", 3, 0), ("word", None, 0), ("same", 4, 0), ("text", 4, 0)]
    asked += [(invented(rnd, rnd.randint(1, 12)), 10 + k, 0) for k in range(12)]
    d = folder(spark, tmp_path, documents=(docs(rnd, 300), DOCS), benchmark=(asked, ITEMS))
    assert_same(wavelet.query(spark, d), wavelet.SQL, d)
    index = wavelet.build(spark.read.parquet(f"{d}/documents.parquet").repartition(4 if shard_bytes > 500 else 25), shard_bytes=shard_bytes)
    assert (index.shards.count() > 20) == (shard_bytes == 500)
    assert_same(wavelet.top(index, spark.read.parquet(f"{d}/benchmark.parquet")), wavelet.SQL, d)


def test_search_of_nothing(spark, tmp_path):
    d = folder(spark, tmp_path, documents=([], DOCS), benchmark=([("a", 1, 0)], ITEMS))
    assert wavelet.query(spark, d).count() == 0
    some = spark.createDataFrame(docs(random.Random(1), 5), DOCS)
    assert wavelet.top(wavelet.build(some), spark.createDataFrame([], ITEMS)).count() == 0


@pytest.mark.parametrize("beam", [1, 3, 128])
def test_a_tree_bounds_every_subtree(monkeypatch, beam):
    monkeypatch.setattr(wavelet, "BEAM", beam)
    rng = np.random.default_rng(2)
    code, doc = np.divmod(rng.choice(30 * 50, 400, replace=False), 50)
    value = rng.integers(1, 9, 400)
    order = np.lexsort((doc, -value, code))
    lists = np.append(0, np.cumsum(np.bincount(code, minlength=30))).astype(np.int32)
    bits = wavelet.planes(doc[order], wavelet.depth(50))
    tree = wavelet.Tree(lists.tobytes(), value[order].astype(np.int32).tobytes(), bits, pa.array([f"t{k}" for k in range(30)]))
    for _ in range(20):
        asked = rng.choice(30, 5, replace=False)
        w = rng.integers(1, 100, 5)
        best = wavelet.Best(7)
        wavelet.search(tree, asked, w, list(range(50)), best)
        score = [sum(int(w[asked == c].sum()) * int(v) for c, d, v in zip(code, doc, value, strict=True) if d == k) for k in range(50)]
        want = sorted(((s, k) for k, s in enumerate(score) if s), key=lambda x: (-x[0], x[1]))[:7]
        assert best.rows == want
