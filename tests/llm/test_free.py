"""The operators in free style: edge cases, brute force, round trips and held-out accuracy."""

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import bpe, jpeg, kneser_ney, minhash, pairwise, sharding, textbatch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def words(text):
    return WORD.findall((text or "").translate(LOW))


ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "one two three four five six seven"), (4, "one two three four five six seven"),
    (5, "ONE two three four five six seven"), (None, "one two three four five six seven"), (7, "long " * 9000), (8, "tiny"), (9, "é🎉\x0bß x"),
]


def invented(rnd, n):
    return " ".join("".join(rnd.choice("aeinrstlo") for _ in range(rnd.randint(2, 8))) for _ in range(n))


# Words in numpy


def test_words_of_a_batch():
    import pyarrow as pa

    texts = [None, "", "a  B\tc", " x ", "é Ü\x1cz", "same SAME", "w" * 300 + " " + "w" * 300]
    seen: dict = {}
    for i, j, t in textbatch.slices(pa.array(texts, pa.string()), most=6):
        h = t.hashes()
        for k in range(i, j):
            own = h[t.bounds[k - i] : t.bounds[k - i + 1]]
            w = words(texts[k])
            assert len(own) == len(w)
            for x, y in zip(w, own.tolist(), strict=True):
                assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)


# Near duplicates


def brute_components(rows, width, share):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    out = {}
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        for k in members:
            out[k] = (len(sets[k]), min(ids) if ids else None)
    return out


@pytest.mark.parametrize("share", [256, 2])
def test_near_duplicates_by_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(minhash, "SHARE", share)
    rnd = random.Random(7)
    rows = list(ODD)
    n = 100
    for _ in range(12):
        base = invented(rnd, rnd.randint(60, 200)).split()
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 6])):
                copy[rnd.randrange(len(copy))] = "changed%d" % rnd.randrange(99)
            rows.append((n, " ".join(copy)))
            n += 1
    got = minhash.report(minhash.cluster(docs(spark, rows), width=3, similarity=0.85)).collect()
    want = brute_components(rows, 3, 85)
    assert collections.Counter((r.id, r.n_shingles, r.component_id) for r in got) == collections.Counter(
        (rows[k][0], *v) for k, v in want.items()
    )
    assert all(r.kept == (r.id is not None and r.id == r.component_id) for r in got)


def near_threshold(family, planted):
    """Documents pairwise at 0.835 by single words (91 of 109), of which ``planted`` pairs share two more (93 of 107)."""
    base = [f"base{k}" for k in range(91)]
    rows = [(i, " ".join([*base, *[f"own{i}x{k}" for k in range(9)]])) for i in range(family)]
    for j in range(planted):
        for i in (0, 1):
            own = [f"pair{j}x{k}" for k in range(2)] + [f"pair{j}y{i}x{k}" for k in range(7)]
            rows.append((1000 + 2 * j + i, " ".join([*base, *own])))
    return rows


@pytest.mark.parametrize("share", [256, 7])
def test_links_of_a_family_just_under_the_threshold(spark, monkeypatch, share):
    monkeypatch.setattr(minhash, "SHARE", share)
    rows = near_threshold(150, 40)
    got = minhash.report(minhash.cluster(docs(spark, rows), width=1, similarity=0.85)).collect()
    want = {k: v[1] for k, v in brute_components(rows, 1, 85).items()}
    assert sum(i != c for (i, _), c in zip(rows, want.values(), strict=True)) == 40
    assert {r.id: r.component_id for r in got} == {rows[k][0]: c for k, c in want.items()}


def test_large_buckets_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SHARE", 8)
    members = spark.createDataFrame([(1, b"%d" % k, 10, k) for k in range(100)] + [(2, b"a", 10, 5), (2, b"b", 10, 6)], "key long, node binary, n long, fame long")
    members = members.withColumn("root", F.col("node")).withColumn("parts", F.expr("if(key = 1, 13, 1)"))
    centre = minhash.centres(members)
    assert {(r.ck, bytes(r.cx), r.ps, r.spread) for r in centre.collect()} == {(1, b"99", 13, 13), (2, b"b", 1, 1)}
    pairs = minhash.stars(members, centre, 0.8).collect()
    assert {(bytes(r.x), bytes(r.y)) for r in pairs} == {(b"%d" % k, b"99") for k in range(99)} | {(b"a", b"b")}
    parts = collections.Counter(r.yp for r in pairs if bytes(r.y) == b"99")
    assert len(parts) == 13 and max(parts.values()) < 25 and all(r.xp == 0 for r in pairs)
    assert minhash.open_buckets(members.drop("root"), None).count() == 102


def test_prefixes_of_alike_sets_meet():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.choice(200, rng.integers(10, 60), replace=False).astype(np.uint64)
        b = np.union1d(rng.permutation(a)[rng.integers(0, 9) :], rng.integers(200, 230, rng.integers(0, 9)).astype(np.uint64))
        a, b = sorted((np.sort(a), b), key=len)
        both = len(np.intersect1d(a, b))
        often = np.zeros(minhash.SLOTS, np.int64)
        for s in (a, b, np.arange(0, 230, 3).astype(np.uint64)):
            np.add.at(often, minhash._slot(s), 1)
        if 100 * both >= 80 * (len(a) + len(b) - both):
            (p, m, _), (q, _, _) = minhash.prefix(a, often, 80), minhash.prefix(b, often, 80)
            assert len(np.intersect1d(p[:m], q))


@pytest.mark.parametrize("similarity, bands", [(0.8, 76), (0.81, 68), (0.85, 44)])
def test_bands_follow_the_similarity(similarity, bands):
    assert minhash.bands_for(similarity) == bands
    assert (1 - similarity**minhash.ROWS) ** bands < 1e-6
    run = minhash._nodes(5, similarity, ["id", "th"])
    import pyarrow as pa

    text = " ".join(f"w{k}" for k in range(40))
    (out,) = run([pa.record_batch([[text], [1], [1]], names=["text", "id", "th"])])
    assert len(out.column("bands")[0]) == bands


def test_keep_one(spark):
    df = docs(spark, ODD).withColumn("node", F.lit("mine"))
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(1, None), (2, ""), (3, " \n"), (4, ODD[3][1]), (7, ODD[7][1]), (8, "tiny"), (9, ODD[9][1])], key=lambda x: x[0]
    )
    assert minhash.keep_one(docs(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 1200, dtype=np.uint64))
    a, b = pool[:1000], pool[100:1100]
    sig = minhash.signatures([a, b, a[::150]])
    assert abs((sig[0] == sig[1]).mean() - 900 / 1100) < 0.08
    assert set(sig[2].tolist()) == set(a[::150].tolist())


# Language model


@pytest.mark.parametrize("order", [2, 3])
def test_model_by_brute_force(spark, order):
    rnd = random.Random(3)
    vocabulary = [invented(rnd, 1) for _ in range(40)]
    rows = list(ODD) + [(50 + k, " ".join(rnd.choices(vocabulary, weights=range(40, 0, -1), k=rnd.randint(1, 60)))) for k in range(80)]
    settings = kneser_ney.train(docs(spark, rows[:60]), order=order)
    out = kneser_ney.score(docs(spark, rows), settings).collect()
    start, end = "\0start", "\0end"
    single, double, triple = collections.Counter(), collections.Counter(), collections.Counter()
    for _, t in rows[:60]:
        w = [start, *words(t), end]
        single.update(w[1:])
        double.update(zip(w, w[1:]))
        triple.update(zip(w, w[1:], w[2:]))
    n, v = sum(single.values()), len(single)
    preceding = collections.Counter(w for _, w in double)
    if order == 3:
        left = collections.Counter((x, y) for _, x, y in triple)
        double = {k: c if k[0] == start else left[k] for k, c in double.items()}

    def contexts(grams):
        out = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, c in grams.items():
            out[g[:-1]][0] += c
            out[g[:-1]][min(c, 3)] += 1
        return out

    times = lambda x: [sum(1 for c in x.values() if c == k) for k in (1, 2, 3, 4)]
    low = kneser_ney.discounts(times(preceding))
    all_before = sum(preceding.values())
    spare = sum(low[min(c, 3)] for c in preceding.values()) / all_before
    p1 = lambda w: max(preceding[w] - low[min(preceding[w], 3)], 0) / all_before + spare / (v + 1)

    def higher(grams, below):
        cut, of = kneser_ney.discounts(times(grams)), contexts(grams)

        def p(*gram):
            if gram[:-1] not in of:
                return below(*gram[1:])
            a, c = of[gram[:-1]], grams.get(gram, 0)
            return max(c - cut[min(c, 3)], 0) / a[0] + sum(cut[k] * a[k] for k in (1, 2, 3)) / a[0] * below(*gram[1:])

        return p

    p2 = higher(double, p1)
    p3 = higher(triple, p2) if order == 3 else lambda u, v, w: p2(v, w)
    for u in (start, vocabulary[0], vocabulary[-1], "never seen"):
        for x in (vocabulary[1], vocabulary[-2], "never seen"):
            assert math.isclose(sum(p3(u, x, w) for w in single) + p3(u, x, "never seen"), 1, rel_tol=1e-9)
    want = []
    for i, t in rows:
        w = [start, *words(t), end]
        s = math.log10(p2(*w[:2])) + sum(math.log10(p3(*g)) for g in zip(w, w[1:], w[2:]))
        b = sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w[1:])
        want.append((str(i), len(w) - 1, sum(single[x] > 0 for x in w[1:]), n, round(b, 5), round(s, 5)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in out]
    assert sorted(got) == sorted(want)


def test_sorted_arrays():
    rng = np.random.default_rng(8)
    for n in (0, 1, 5, 40_000):
        key = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        facts = [rng.integers(0, 30, len(key)), rng.integers(1, 40, len(key)) ** 3]
        found = kneser_ney.Sorted(kneser_ney.seal(key, *facts))
        assert found.find(key).tolist() == np.stack(facts, axis=1).tolist()
        assert not found.find(np.setdiff1d(rng.integers(0, 1 << 64, 1000, dtype=np.uint64), key)).any()


def test_packed_columns_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 300):
        columns = [np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)), rng.integers(0, 70_000, n), np.arange(n), np.ones(n, np.int64)]
        back = kneser_ney.unpack(kneser_ney.pack(*columns))
        assert [(c.dtype, c.tolist()) for c in back] == [(c.dtype, c.tolist()) for c in columns]


def test_pairs_beyond_63_bits():
    first, second = np.array([1 << 61, 3, 1 << 61, 0]), np.array([2, 9, 2, 0])
    assert [c.tolist() for c in kneser_ney._distinct(first, second, 10)] == [[0, 3, 1 << 61], [0, 9, 2], [1, 1, 2]]


@pytest.mark.parametrize("kind", ["bigram", "trigram"])
def test_a_lost_array_raises(spark, kind):
    import glob
    import os

    settings = kneser_ney.train(docs(spark, [(k, f"w{k} and w{k + 1} or w{k + 2}") for k in range(50)]))
    files = glob.glob(kneser_ney._local(settings.folder) + f"/{kind}-[0-9]*.npy")
    assert len(files) == settings.present[kind].sum() > 1
    for f in files:
        os.remove(f)
    with pytest.raises(Exception, match="FileNotFoundError|No such file"):
        kneser_ney.score(docs(spark, [(1, "w1 and w2 or w3")]), settings).collect()


def test_present_by_bits():
    rows = [{"part": 1, "bits": bytes([0b101]) + bytes(4095)}, {"part": 2, "bits": bytes([2]) + bytes(4095)}]
    assert np.flatnonzero(kneser_ney.present(rows, 40_000)).tolist() == [0, 2, 32769]


def test_scores_beside_clashing_names(spark):
    df = docs(spark, ODD).withColumn("score", F.lit("mine")).withColumn("n_tokens", F.lit(None).cast("int"))
    settings = kneser_ney.train(df)
    out = kneser_ney.score(df, settings)
    assert out.columns == [*df.columns, "_n_tokens", "n_known", "train_tokens", "base_score", "_score", "perplexity"]
    assert {r.score for r in out.collect()} == {"mine"} and out.count() == len(ODD)
    assert kneser_ney.score(df.where("false"), settings).count() == 0


def test_model_without_texts(spark):
    settings = kneser_ney.train(docs(spark, []))
    row = kneser_ney.score(docs(spark, [(1, "a b")]), settings).first()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)


def test_large_counts(spark):
    settings = kneser_ney.train(docs(spark, [(1, "a b " * 700)]))
    model = kneser_ney.Model(settings)
    import pyarrow as pa

    (_, _, t), = textbatch.slices(pa.array(["a b"]))
    a, b = t.hashes()
    u, v, w = np.array([a, b]), np.array([b, a]), np.array([a, b])
    # After b stands a 699 times and the end once; before a stand the start and b.
    assert model.grams("bigram", textbatch.join(u, v), u, v).tolist() == [[2, 700, 1, 0, 1], [1, 699, 0, 0, 1]]
    assert model.grams("trigram", textbatch.join(u, v, w), v, u).tolist() == [[699], [699]]


# Tokens


def encoders():
    import public_tokenizers

    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert bpe.PATTERN == public_tokenizers.PATTERN
    return bpe.Merges(ranks), tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("few", [0, 60, 1 << 30])
def test_tokens_as_the_library(monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    own, library = encoders()
    rnd = random.Random(5)
    texts = [t or "" for _, t in ODD] + [
        "a" * 3000, "".join(rnd.choice("abcdeth \n") for _ in range(4000)), "".join(rnd.choice("inthe") for _ in range(3000)),
        "日本語 🎉🎉  x", "it's we'll <|endoftext|>", " 　 mixed\r\n", "".join(chr(rnd.randint(33, 0x2FFF)) for _ in range(2000)),
        *["".join(rnd.choice("inthegaos ") for _ in range(rnd.randint(0, 60))) for _ in range(300)],
    ]
    for block in (texts, texts[::-1], [texts[-1]]):
        for t, ids in zip(block, own.encode(block), strict=True):
            assert ids.tolist() == library.encode_ordinary(t)
            assert own.decode(ids).tobytes().decode() == t


def test_vocabulary_replays_to_itself():
    own, library = encoders()
    ranks = library._mergeable_ranks
    ids, n = own.replay(np.frombuffer(b"".join(ranks), np.uint8), np.cumsum([0, *map(len, ranks)]))
    assert (n == 1).all() and ids.tolist() == list(ranks.values())


def test_pieces_as_the_pattern():
    import regex

    rnd = random.Random(1)
    pool = "  \n\t\r'''stmdrevl ll re abc 12 ½ 日本 é ß — ! .\x1c\x85\u2028\u200b\u3000 🎉 ٣ ʼ"
    for _ in range(1500):
        texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 4))]
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        want = [regex.findall(bpe.PATTERN, t) for t in texts]
        for pattern in (bpe.PATTERN, f"(?:{bpe.PATTERN})"):
            buf, edges, bounds = bpe.cut_pieces(np.frombuffer(b"".join(raw), np.uint8), offsets, pattern)
            got = [buf[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            assert [got[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want


@pytest.mark.parametrize("block", [1, 60, 1 << 22])
def test_tokenize(spark, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK", block)
    _, library = encoders()
    df = docs(spark, ODD).withColumn("tokens", F.lit(1)).withColumn("block", F.lit("mine")).withColumn("at", F.lit(None).cast("string"))
    out = bpe.tokenize(df, bpe.public_merges())
    assert out.columns == [*df.columns, "n_tokens", "_tokens", "decoded"]
    rows = out.collect()
    assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter(ODD)
    for r in rows:
        ids = np.frombuffer(bytes(r["_tokens"]), "<u4").tolist()
        assert ids == library.encode_ordinary(r.text or "") and r.n_tokens == len(ids)
        assert bytes(r.decoded).decode() == (r.text or "") and (r.tokens, r.block, r.at, r.lang) == (1, "mine", None, "en")
    assert bpe.tokenize(docs(spark, []), bpe.public_merges()).count() == 0
    assert bpe._rereads(df) and not bpe._rereads(df.distinct())
    assert bpe.tokenize(df.repartition(3, "lang"), bpe.public_merges()).select("n_tokens").agg(F.sum("n_tokens")).first()[0] == sum(r.n_tokens for r in rows)
    few = bpe.tokenize(df, bpe.public_merges(), keep=["doc_id"], decoded=False)
    assert few.columns == ["doc_id", "n_tokens", "_tokens"] and few.count() == len(ODD)


def test_query_as_the_library(spark):
    import hashlib

    _, library = encoders()
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in bpe.query(spark, d).collect()}
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, t in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want = len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


# Media


def test_payloads_come_back():
    rng = np.random.default_rng(2)
    payloads = [
        jpeg.padded(b""), jpeg.padded(b"hello"), jpeg.padded(bytes(rng.integers(0, 256, 6400, dtype=np.uint8))),
        jpeg.padded(bytes(rng.integers(126, 131, 6400, dtype=np.uint8))), jpeg.padded(b"\x80" * 700 + b"\x81" + b"\x80" * 500 + b"\x7f\x90"),
        jpeg.padded(bytes(np.where(rng.random(12800) < 0.02, rng.integers(120, 136, 12800), 128).astype(np.uint8))), jpeg.padded(b"x" * 64),
    ]
    assert len(payloads[0]) == 64 and len(payloads[-1]) == 64
    files = jpeg.write(payloads)
    for image, c, p in zip(*jpeg.read(files), payloads, strict=True):
        assert jpeg.payload_of(image, c) == p.tobytes()
    assert [jpeg.write([p])[0] for p in payloads] == files
    with pytest.raises(ValueError, match="JPEG"):
        jpeg.read([b"no image"])
    assert jpeg.decode_all([files[1], None], False)[1][0] == "no file"


def test_stacks_and_passes():
    """Files of many shapes read at once give what each gives by itself, and cost few steps each."""
    rng = np.random.default_rng(6)
    payloads = [jpeg.padded(bytes(rng.integers(*((97, 123), (0, 256))[i % 8 == 0], 64 * (i % 40) + 9, dtype=np.uint8))) for i in range(1024)]
    parts = [payloads[i : i + 256] for i in range(0, 1024, 256)]
    began = time.process_time()
    files = [jpeg.write(p) for p in parts]
    rows = [jpeg.decode_all(f, False) for f in files]
    assert time.process_time() - began < 1100e-9 * sum(map(len, payloads)), "CPU seconds a byte"
    assert [r[1] for r in rows[0]] == [p.tobytes() for p in parts[0]] and not any(r[0] for part in rows for r in part)
    assert [jpeg.decode_all([f], True)[0][:3] for f in files[0][:90]] == rows[0][:90]
    image, _ = (x[0] for x in jpeg.read(files[0][:1]))
    assert [len(p) for p in image.passes()] == [1, 3, 3, 3, 1]


def test_pixels_by_definition():
    (image,), (c,) = jpeg.read(jpeg.write([jpeg.padded(bytes(range(100, 160)) * 9)]))
    rgb = image.rgb(c)
    assert rgb.shape == (image.tall, image.wide, 3)
    block = np.zeros((8, 8))
    block.ravel()[jpeg.zigzag()] = c[0]
    scale = lambda k: math.sqrt(1 / 8) if k == 0 else 0.5
    for y, x in ((0, 0), (3, 5), (7, 7)):
        want = 128 + sum(
            scale(u) * scale(v) * block[v, u] * math.cos((2 * x + 1) * u * math.pi / 16) * math.cos((2 * y + 1) * v * math.pi / 16)
            for u in range(8)
            for v in range(8)
        )
        assert abs(image.planes(c)[0][y, x] - min(max(want, 0), 255)) <= 1


def test_media_columns(spark):
    df = docs(spark, ODD).withColumn("media", F.lit("mine"))
    out = jpeg.load(jpeg.store(df), media_col="_media")
    by = {}
    for r in out.collect():
        raw = (r.text or "").encode()
        assert (r.n_bytes, bytes(r.payload)) == (len(raw), jpeg.padded(raw).tobytes())
        assert len(r.rgb) == 3 * r.width * r.height
        assert by.setdefault(r.text or "", (r["_media"], r.feature)) == (r["_media"], r.feature)
    assert jpeg.load(jpeg.store(docs(spark, []))).count() == 0


def test_lost_and_damaged_media(spark):
    good = jpeg.write([jpeg.padded(b"hello"), jpeg.padded(b"there")])
    files = [(1, good[0]), (2, None), (3, b"no image"), (4, good[1][: len(good[1]) // 2]), (5, b""), (6, good[1])]
    df = spark.createDataFrame(files, "k int, media binary").coalesce(1).withColumn("error", F.lit("mine"))
    out = {r.k: r for r in jpeg.load(df).collect()}
    assert {k for k, r in out.items() if r["_error"] is None} >= {1, 6} and not {2, 3, 5} & {k for k, r in out.items() if r["_error"] is None}
    assert bytes(out[1].payload) == jpeg.padded(b"hello").tobytes() and bytes(out[6].payload) == jpeg.padded(b"there").tobytes()
    assert all(out[k].payload is None and out[k].rgb is None and out[k].error == "mine" for k in (2, 3, 5))
    assert jpeg.load(df.where("false")).count() == 0


# Shards


def brute_capacity(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, used, at = (lo + hi) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                used, at = used + 1, 0
            at += s
        lo, hi = (lo, mid) if used <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_least(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([1, 5, 50, 3000 if seed % 2 else 7]) for _ in range(rnd.choice([3, 16, 400]))]
    keys = sorted({rnd.randrange(-(1 << 63), 1 << 63) for _ in sizes})
    if seed == 3:
        keys = list(range(len(sizes)))
    groups = spark.createDataFrame(list(zip(keys, sizes, strict=True)), "k long, mass long")
    capacity, cuts = sharding.partition(groups, 16, first=8, fanout=4)
    assert capacity == brute_capacity(sizes, 16)
    load = collections.Counter()
    for k, s in zip(keys, sizes, strict=True):
        load[sum(k > c for c in cuts)] += s
    assert max(load.values()) <= capacity and len(load) <= 16


def test_shard_odd_rows(spark):
    df = docs(spark, [*ODD, *[(100 + i, f"text {i} " * (i % 9)) for i in range(200)]]).withColumn("slot", F.lit("mine"))
    out = sharding.shard(df)
    rows = out.collect()
    assert len(rows) == df.count() and {r.shard for r in rows} <= set(range(16))
    by, text = collections.defaultdict(list), {}
    for r in rows:
        by[r.shard].append(r["_slot"])
        assert text.setdefault(r.text or "", r.shard) == r.shard and r["size"] == len((r.text or "").encode()) + 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.shard(docs(spark, [])).count() == 0


# Classifier


def labelled(spark, rnd, n):
    rows, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.8
        text = invented(rnd, rnd.randint(40, 200))
        if not good:
            text = rnd.choice([text.upper().replace(" ", "!! "), text.replace(" ", "*** "), " ".join(text.split()[:4] * 30)])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return docs(spark, [*rows, (9001, None), (9002, ""), (9001, "again " * 90)]), spark.createDataFrame([*labels, (None, 1, 0), (9001, None, 0)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = labelled(spark, random.Random(8), 400)
    out = pairwise.classify(rows.withColumn("score", F.lit("mine")), labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in out.collect() if r.doc_id < 9000 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r["_score"] <= 1 and r.predicted == (r["_score"] >= 0.5) for r in out.collect())


def test_weights_by_brute_force():
    """Newton's weights are where the loss over all pairs, written out, is least; the threshold has as many below as are bad."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(60, pairwise.FACTS + 3)), (rng.random(60) < 0.6).astype(int)
    x[y == 1] += 0.4
    model = pairwise.fit(x, y, ridge=0.05)
    z = pairwise.scaled(pairwise.bent(x, model.bends), model.mean, model.scale)
    pairs = list(zip(*pairwise.pairs_of(np.flatnonzero(y == 1), np.flatnonzero(y == 0), pairwise.PARTNERS), strict=True))
    assert all(y[i] == 1 and y[j] == 0 for i, j in pairs) and {j for _, j in pairs} == set(np.flatnonzero(y == 0))

    def loss(w):
        return sum(math.log1p(math.exp(-float(w @ (z[i] - z[j])))) for i, j in pairs) / len(pairs) + 0.05 / 2 * float(w @ w)

    w = np.zeros(z.shape[1])
    for _ in range(4000):
        g = 0.05 * w
        for i, j in pairs:
            d = z[i] - z[j]
            g = g - d / (1 + math.exp(float(w @ d))) / len(pairs)
        w = w - 0.05 * g
        if np.abs(g).max() < 1e-5:
            break
    assert abs(loss(w) - loss(model.weights)) < 1e-6 and np.abs(w - model.weights).max() < 0.01
    assert (model.score(x) < 0.5).sum() == (y == 0).sum()
    s = model.score(x)
    assert (np.argsort(s, kind="stable") == np.argsort(z @ model.weights, kind="stable")).all()


def test_query_scores_by_the_model(spark):
    """The query's rows are those of one fit over the labels that may be learnt from."""
    import pyarrow as pa

    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in pairwise.query(spark, d).collect()}
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    x = pairwise.all_features(pa.array([t for _, t in rows], pa.string()))
    held = np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows])
    use = np.array([i in label for i, _ in rows]) & ~held
    y = np.array([label.get(i, 0) for i, _ in rows])
    learnt = np.unique(np.column_stack([x[use], y[use]]), axis=0)  # copies count once
    order = np.lexsort((learnt[:, -1], *learnt[:, :-1].T))
    want = pairwise.fit(learnt[order, :-1], learnt[order, -1]).score(x)
    for (i, _), h, s in zip(rows, held, want, strict=True):
        assert (got[i].held_out, got[i].predicted) == (h, int(s >= 0.5)) and abs(got[i].score - s) < 1e-6


def test_classifier_without_labels(spark):
    rows, labels = labelled(spark, random.Random(8), 5)
    assert {r.score for r in pairwise.classify(rows, labels.where("false")).collect()} == {0.5}
    assert pairwise.classify(rows.where("false"), labels).count() == 0


# Pipeline


def test_pipeline_by_its_stages(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    left = spark.read.parquet(f"{d}/documents.parquet")
    names = left.columns
    counts = [left.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, d)
        assert left.columns == names
        counts.append(left.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] > 0
    rows = corpus_pipeline.run(spark, d).collect()
    texts = collections.Counter((r.doc_id, r.text) for r in left.collect())
    assert collections.Counter((r.doc_id, r.text) for r in rows) == texts
    _, library = encoders()
    for r in rows[:200]:
        assert np.frombuffer(bytes(r.tokens), "<u4").tolist() == library.encode_ordinary(r.text)


def test_pipeline_decodes(spark):
    import hashlib

    import corpus_pipeline

    rows = corpus_pipeline.tokenize(spark, docs(spark, ODD).withColumn("decoded", F.lit("mine")), "").collect()
    assert len(rows) == len(ODD)
    assert all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and r.decoded == "mine" for r in rows)


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    clash = docs(spark, ODD).withColumn("kept", F.lit(1)).withColumn("predicted", F.lit("x"))
    for rows in (clash, clash.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, d)
            assert out.columns[: len(rows.columns)] == rows.columns, name
            assert out.count() <= 2 * rows.count()
