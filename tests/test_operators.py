import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import clustering, relations, similarity
from sparrowmill.sources import documents, feeds, sinks
from sparrowmill.streaming import incremental


def test_components_of_a_long_chain(spark):
    n = 200
    nodes = spark.range(n + 2)
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = {r.id: r.component for r in similarity.components(nodes, edges, "id").collect()}
    assert all(found[i] == 0 for i in range(n + 1)) and found[n + 1] == n + 1


def test_components_without_edges(spark):
    edges = spark.createDataFrame([], "a long, b long")
    assert similarity.components(spark.range(3), edges, "id").count() == 3


def test_join_that_must_match(spark):
    a = spark.createDataFrame([(1,), (2,)], "id int")
    b = spark.createDataFrame([(1, "x")], "id int, v string")
    assert relations.join_that_must_match(a.where("id = 1"), b, "id").count() == 1
    with pytest.raises(Exception, match="no partner"):
        relations.join_that_must_match(a, b, "id").collect()


def test_jaccard_pairs_by_brute_force(spark):
    rng = np.random.default_rng(5)
    sets = [(i, sorted({int(x) for x in rng.integers(0, 12, 9)})) for i in range(60)]
    df = spark.createDataFrame(sets, "id int, items array<int>")
    want = {(a, b) for a, x in sets for b, y in sets if a < b and len(set(x) & set(y)) >= 0.7 * len(set(x) | set(y)) - 1e-9}
    assert {(r.a, r.b) for r in similarity.jaccard_pairs(df, "id", "items", 0.7).collect()} == want


def test_jaccard_candidates_are_few_and_tiles_lose_no_pair(spark, monkeypatch):
    """Unlike sets that share a rare word never leave the join, and groups split over tiles keep all their pairs."""
    rng = np.random.default_rng(6)
    base = [[f"w{x}" for x in rng.choice(400, 60, replace=False)] for _ in range(150)]
    near = [[*b[: 60 - k], *[f"n{k}" for k in range(k)]] for b in base[:4] for k in range(1, 8)]
    sets = [(i, list(dict.fromkeys(x))) for i, x in enumerate([*base, *near, [], ["w1", "w2"], ["w2", "w1", "w3"]])]
    want = {(a, b) for a, x in sets for b, y in sets if a < b and x and y and len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y)) - 1e-9}
    seen, keep = {}, similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, label: seen.setdefault(label, keep(df, label)))
    monkeypatch.setattr(similarity, "TILE", 3)
    df = spark.createDataFrame(sets, "id int, items array<string>")
    got = [(r.a, r.b) for r in similarity.jaccard_pairs(df, "id", "items", 0.8).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert seen["pairs"].count() <= 2 * len(want)


def test_clusterings():
    x = np.array([[0.0], [0.1], [0.2], [5.0], [5.1], [9.0]])
    d = np.abs(x - x.T)
    labels, medoids = clustering.pam(d, 3)
    assert len(set(labels[:3])) == 1 and len(set(labels)) == 3
    assert list(clustering.average_linkage(d, 3)) == [0, 0, 0, 1, 1, 2]
    assert clustering.silhouette(d, labels) > 0.6
    assert np.allclose(np.abs(clustering.classical_mds(d, 1)[:, 0] - clustering.classical_mds(d, 1)[0, 0]), d[0], atol=1e-6)
    assert clustering.rand_index(labels, labels) == 1.0
    assert clustering.prediction_strength(labels, labels) == 1.0


def test_latent_classes():
    rng = np.random.default_rng(0)
    z = rng.integers(0, 2, 400)
    x = np.stack([np.where(rng.random(400) < 0.9, z, 1 - z) for _ in range(5)], axis=1)
    m = clustering.LatentClasses(2).fit(x)
    assert clustering.rand_index(m.predict(x), z) > 0.8
    assert m.bic < clustering.LatentClasses(3).fit(x).bic


def package(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def test_readers(spark):
    page = (
        '<meta name="title" content=" T "><div class="view_cont"><ul><li><span class="s_title">개요</span>'
        '<div class="txt">a<br>b</div></li></ul><div style="text-align: center">end</div></div>'
    )
    files = [
        ("a.html", page.encode()),
        ("b.html", b"<p>x</p>"),
        ("c.hwpx", package({"Contents/section0.xml": '<s xmlns:h="u"><h:t>one</h:t><h:t> </h:t><h:t>two</h:t></s>'})),
        ("d.docx", package({"word/document.xml": '<w:d xmlns:w="u"><w:p><w:t>p1</w:t></w:p><w:p/></w:d>'})),
        ("e.docx", package({"x": ""})),
        ("f.hwpx", b"no zip"),
        ("g.JPG", b""),
        ("h.pdf", b""),
        ("i", b""),
    ]
    got = {r.path: (r.text, r.error) for r in documents.convert_files(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert got["a.html"][0] == "# T\n\n## 개요\n\na\nb\n\n\n---\nend\n"
    assert [got[k][1] for k in ("b.html", "e.docx", "f.hwpx", "g.JPG", "h.pdf", "i")] == [
        "NO_VIEW_CONT", "NO_DOCUMENT_XML", "BAD_ZIP", "OCR_NEEDED", "UNSUPPORTED_FORMAT", "UNKNOWN_FORMAT",
    ]
    assert (got["c.hwpx"][0], got["d.docx"][0]) == ("one\ntwo", "p1")


def test_feed(spark, tmp_path):
    for category, pages in {"a": [[1, 2], [3]], "b": [[]]}.items():
        (tmp_path / category).mkdir()
        for i, items in enumerate(pages, 1):
            (tmp_path / category / f"{i}.json").write_text(json.dumps({"jsonArray": [{"id": x} for x in items]}))
    spark.dataSource.register(feeds.PagedFeed)
    df = spark.read.format("paged_feed").option("root", str(tmp_path)).option("categories", "a,b").option("pageUnit", "2").load()
    assert sorted(json.loads(r.item)["id"] for r in df.collect()) == [1, 2, 3]
    assert feeds.items_of({"jsonArray": {}, "items": [1]}) == []
    assert feeds.settings("# c\n a = b=c \n\n") == {"a": "b=c"}
    with pytest.raises(KeyError):
        feeds.settings("", ("key",))
    runs = spark.createDataFrame([("20260601-131729",), ("20260602-000000x",), ("20260601-224706",)], "run_id string")
    assert feeds.newest_run(runs).first()[0] == "20260601-224706"
    pairs = spark.createDataFrame([("a@ ", "u1@u2")], "n string, u string").select(feeds.attachment_pairs("n", "u")).first()[0]
    assert [tuple(p) for p in pairs] == [("a", "u1"), ("attachment-02", "u2")]


def test_versions_and_gate(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.write_version(spark.range(3), root, "1")
    sinks.write_version(spark.range(5), root, "2")
    assert sinks.read_current(spark, root).count() == 5
    a, b = sinks.digest(spark.range(9)).first(), sinks.digest(spark.range(9).repartition(3)).first()
    assert a == b
    issues = spark.createDataFrame([("x: y", "x", "1")], "rule string, area string, id string")
    with pytest.raises(ValueError, match="x: y 1"):
        sinks.gate(issues)
    sinks.gate(issues.where("false"))


def test_merge_survives_replay(spark, tmp_path):
    run = incremental.merge_unseen(str(tmp_path / "m"), "id")
    a, b = spark.range(4), spark.range(2, 6)
    run(a, 0)
    run(b, 1)
    run(b, 1)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "m")).collect()) == list(range(6))


def test_newest_version_by_writing(spark, tmp_path):
    for n, version in enumerate(("v9", "v10", "v2")):
        sinks.write_version(spark.range(n + 1), str(tmp_path), version)
    assert sinks.read_current(spark, str(tmp_path)).count() == 3


def test_hints(spark):
    from sparrowmill.operators import selection

    rows = spark.createDataFrame([(["길이 부족", "단어반복: x"],), ([],)], "i array<string>")
    assert [r[0] for r in rows.select(selection.hints(F.col("i"))).collect()] == [
        "같은 단어가 반복됨; 길이가 부적절(50~100자 권장)", "토스 스타일 규칙 미충족",
    ]


def test_numbered_groups(spark):
    ids = [5, -3, 1 << 40, 7, 8, 9, 1000]
    out = relations.numbered_groups(spark.createDataFrame([(i,) for i in ids], "least long"), "least", "G", parts=4)
    assert {r.least: r.group_name for r in out.collect()} == {i: f"G-{k:04d}" for k, i in enumerate(sorted(ids), 1)}
    assert relations.numbered_groups(spark.createDataFrame([], "least long"), "least", "G").count() == 0


def test_detail_pages():
    page = """<meta name=title content=" 공고 "><div class=view_cont style="text-align:center"><ul>
      <li><span class="s_title"> 대상 </span><div class="txt a">소상공인 <b>모두</b><script>x</script></div><div class=txt>둘</div></li>
      <li><span class=s_title>빈</span><li><div class=txt>안</div></li></li><li>딴</li></ul>
      <div style="text-align: center">서울 <br>시장</div><div style="text-align:center">또</div></div>
      <div class=view_cont><li><span class=s_title>밖</span><div class=txt>밖</div></li></div>"""
    want = "# 공고\n\n## 대상\n\n소상공인\n모두\n\n## 빈\n\n안\n\n\n---\n서울시장\n"
    assert documents.detail_page(page) == (want, None)
    assert documents.detail_page("<p>x") == (None, "NO_VIEW_CONT")
    assert documents.detail_page("<div class=view_cont>x</div>") == (None, "EMPTY_CONTENT")
    assert documents.detail_page("<div class=view_cont><li><span class=s_title>끝<div class=txt>열린 글") == ("## 끝열린 글\n\n열린 글\n", None)
