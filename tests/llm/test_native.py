"""Mixing, license scans, chat formatting and quality rules: edge cases and brute force."""

import collections
import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import chat, licenses, mixing, queries, weak_rules

from ..oracle import SMALL, assert_same

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, SMALL), queries.ORACLE[name])


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two three", "b"), (4, "one two three", "b"), (None, "x y z w", None),
    (5, "word " * 5000, "a"), (6, "one two three", "b"),
]


def test_mix_targets(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(400)] + [(900 + i, "w " * 3000, "hot") for i in range(3)]
    out = mixing.mix(docs(spark, rows)).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.source].append(r)
    total = sum(r["size"] for r in out)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(by))}
    size = {s: sum(r["size"] for r in v) for s, v in by.items()}
    # Rounds of resharing, as the rule says it.
    target, full = dict.fromkeys(by, 0.0), set()
    while True:
        rest = 1.5 * total - sum(2.0 * size[s] for s in full)
        share = {s: rest * weights[s] / sum(weights[x] for x in by if x not in full) for s in by if s not in full}
        over = {s for s in share if share[s] > 2 * size[s]}
        if not over:
            target = {s: 2.0 * size[s] if s in full else share[s] for s in by}
            break
        full |= over
    for s, v in by.items():
        assert all(math.isclose(r.target, target[s], rel_tol=1e-9) for r in v)
        assert all(0 <= r.copies <= 2 for r in v)
        taken = sum(r["size"] * r.copies for r in v)
        assert abs(taken - target[s]) <= max(r["size"] for r in v) + 0.05 * target[s]


def test_mix_odd_rows(spark):
    df = docs(spark, ODD).withColumn("size", F.lit("mine"))
    out = mixing.mix(df)
    assert out.columns[:6] == df.columns and out.count() == len(ODD)
    assert mixing.mix(docs(spark, ODD[:0])).count() == 0
    again = mixing.mix(df.repartition(3))
    key = lambda x: sorted(str(tuple(r)) for r in x.collect())
    assert key(out) == key(again)
    copies = out.columns[-1]
    assert mixing.emit(out, copies, df.columns).count() == out.agg(F.sum(copies)).first()[0]


def license_brute(text, templates=licenses.TEMPLATES):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    base = [(a, i) for p, a in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    labels = {a for a, _ in base}
    for a, t in templates:
        size, own = licenses.window(t), set(t.split())
        blocks = [set(w[s : s + size]) for s in range(0, len(w), size // 2)]
        labels |= {a for x in blocks if len(x & own) >= licenses.THRESHOLD * len(own) - 1e-9}
    return len(w), len(base), ",".join(sorted(labels))


def test_licenses(spark):
    mit, whole = licenses.TEMPLATES[1][1], [t for _, t in licenses.TEMPLATES if len(t.split()) > 64]
    assert len(whole) >= 5
    texts = [
        None, "", "Released UNDER the MIT License.", "cc by nc cc by nc", "a " * 300 + mit + " b" * 300, mit.replace("merge", "join"),
        "under the MIT. license", "Licensed under the Apache License, Version 2.0; also CC BY-NC 4.0", "x " * 63 + "this program is free software",
        "mit mit mit", "Ünder the mit license", "Ünder the mit license", *whole, *["so " * k + t.upper() + " thus" * 50 for k, t in zip((97, 300, 777), whole, strict=False)],
    ]
    df = docs(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(2, texts[2], "s")]).withColumn("n_words", F.lit("mine"))
    out = licenses.scan(df)
    assert out.columns == [*df.columns, "_n_words", "phrase_places", "template_matches"]
    rows = out.collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        labels = {p.label for p in r.phrase_places} | {m.label for m in r.template_matches}
        assert (r["_n_words"], len(r.phrase_places), ",".join(sorted(labels))) == license_brute(texts[r.doc_id])
        assert all(0.9 - 1e-9 <= m.containment <= 1 for m in r.template_matches)
    found = {m.template for r in rows for m in r.template_matches}
    assert {k for k, (_, t) in enumerate(licenses.TEMPLATES) if t in whole} <= found
    assert licenses.scan(docs(spark, [])).count() == 0


def test_templates_of_any_length(spark):
    long = " ".join(f"term{k}" for k in range(200))
    text = "before " * 90 + long + " after" * 300
    out = licenses.scan(docs(spark, [(1, text, "s"), (2, " ".join(text.split()[:200]), "s")]), templates=[("own", long), ("short", "term1 term2")])
    got = {r.doc_id: {(m.label, m.template) for m in r.template_matches} for r in out.collect()}
    assert got == {1: {("own", 0), ("short", 1)}, 2: {("short", 1)}}


def facts_brute(text):
    w = WORD.findall(text or "")
    n = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(spark):
    texts = [None, "", "a b c a b c a b c", "x\nx\n\n \nx", "é à b # $ <>|", "a a a a a", "p q r s p q r t", "ab " * 2000, "\t\x0bone\x0c two"]
    texts += ["The quick brown fox number %d jumps over the lazy dog while %d birds sing. " % (i, i * 7) * 3 + " ".join(f"word{i}x{j}" for j in range(60)) for i in range(20)]
    out = weak_rules.judge(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]).withColumn("kept", F.lit(1)))
    for r in out.collect():
        got = tuple(r.facts[x] for x in weak_rules.FACTS[:5])
        assert got == facts_brute(texts[r.doc_id])
        assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["_kept"] and r.base_failed) and 0 <= r.quality_posterior <= 1
    assert weak_rules.judge(docs(spark, [])).count() == 0


def test_rules_keep_clean_and_drop_marked(spark):
    import random

    rnd = random.Random(4)
    clean = lambda: " ".join("".join(rnd.choice("aeinrst") for _ in range(rnd.randint(2, 9))) for _ in range(120))
    rows = [(i, clean(), "s") for i in range(100)] + [(100 + i, clean().replace(" ", "*** "), "s") for i in range(12)]
    df = docs(spark, [*rows, *rows[:3], rows[-1]]).withColumn("n_words", F.lit("mine"))
    judged = weak_rules.judge(df)
    assert judged.columns[:6] == df.columns and judged.count() == df.count()
    kept = judged.where("kept").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in kept} == {i: 1 + (i < 3) for i in range(100)}
    assert weak_rules.judge(df, keep=["doc_id"]).columns == ["doc_id", "facts", "base_failed", "quality_posterior", "kept"]


def planted_votes(rnd, n, rates, share, votes=0.9):
    """Patterns of votes with their counts: rules of planted accuracy on good and on bad documents."""
    seen = collections.Counter()
    for _ in range(n):
        good = rnd.random() < share
        seen[tuple(0 if rnd.random() > votes else (1 if good else -1) * (1 if rnd.random() < (a if good else b) else -1) for a, b in rates)] += 1
    return seen


def test_accuracies_come_from_the_votes(spark):
    import random

    rates = [(0.97, 0.8), (0.95, 0.7), (0.98, 0.6), (0.9, 0.75), (0.85, 0.9), (0.6, 0.42)]
    seen = planted_votes(random.Random(2), 30_000, rates, 0.8)
    names = [f"r{k}" for k in range(len(rates))]
    patterns = spark.createDataFrame([(*k, n) for k, n in seen.items()], ", ".join(f"{c} int" for c in names) + ", n long")
    start, found = (weak_rules.fit(patterns, names, rounds=r) for r in (0, 60))
    for got, want in zip(found.rates, rates, strict=True):
        assert abs(got[0] - want[0]) < 0.02 and abs(got[1] - want[1]) < 0.05
    assert abs(1 / (1 + math.exp(-found.odds)) - 0.8) < 0.02
    odds = lambda v, f: f.odds + sum(lift[x > 0] for x, lift in zip(v, f.lift, strict=True) if x)
    changed = sum(n for v, n in seen.items() if (odds(v, start) >= 0) != (odds(v, found) >= 0))
    assert changed > 300
    # One alarm is outvoted, and that of the rule that is little better than chance weighs next to nothing.
    alarm = lambda k: tuple(-1 if j == k else 1 for j in range(len(rates)))
    assert all(odds(alarm(k), found) > 0 for k in range(len(rates)))
    assert min(range(len(rates)), key=lambda k: -found.lift[k][0]) == 5 and odds(alarm(5), found) > odds(alarm(2), found) + 1


def test_rules_no_better_than_chance_have_no_say(spark):
    import random

    seen = planted_votes(random.Random(3), 8000, [(0.95, 0.8), (0.95, 0.8), (0.95, 0.8), (0.3, 0.3)], 0.8, votes=1)
    patterns = spark.createDataFrame([(*k, n) for k, n in seen.items()], "a int, b int, c int, d int, n long")
    found = weak_rules.fit(patterns, list("abcd"))
    assert found.lift[3] == (0.0, 0.0) and all(bad < -1 and good > 0.5 for bad, good in found.lift[:3])


def test_verdicts_on_the_driver_tables(spark):
    """The verdict is neither the start's nor that all rules must pass."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    after, before = (weak_rules.judge(d, keep=["doc_id"], rounds=r) for r in (weak_rules.ROUNDS, 0))
    both = after.select("doc_id", "kept").join(before.select("doc_id", F.col("kept").alias("first")), "doc_id")
    assert both.where("kept <> first").count() > 20
    votes = [F.expr(re.sub(r"\b(n_\w+|word_chars)\b", r"facts.\1", weak_rules.vote(r))) for r in weak_rules.RULES.values()]
    passes = F.least(*votes) >= 0
    assert after.where("kept").where(~passes).count() > 0
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 0")
    assert after.where("kept").join(labels, "doc_id").count() == 0


MSG = "conv long, msg long, parent long, role string, text string, score double"


def test_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9),
        (1, 4, 3, "user", "more", 0.9), (2, 7, None, "user", None, None), (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0),
        (3, 5, 2, "user", "into the cycle", 1.0), (3, 8, 8, "user", "itself", 1.0), (3, 9, None, "user", "free", 1.0),
        (4, 5, 99, None, "lost parent", 1.0), (None, 1, None, "user", "no id", 0.0), (None, 2, 1, "assistant", "yes", 0.0),
        (1, 4, 3, "user", "more", 0.9), (1, 4, 3, "user", "other", 0.9), (5, None, None, "user", "no message", 1.0),
    ]
    df = spark.createDataFrame(rows, MSG)
    placed, _ = chat.jumps(chat.distinct_messages(df))
    assert {(r.conv, r.msg, r.depth) for r in placed.collect()} == {
        (1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 2), (2, 7, 0), (3, 9, 0), (4, 5, 0), (None, 1, 0), (None, 2, 1),
    }
    every = {(r.conv, r.leaf): r for r in chat.format_trees(df, branches=None).collect()}
    assert set(every) == {(1, 2), (1, 4), (2, 7), (3, 9), (4, 5), (None, 2)}
    best = {r.conv: r.leaf for r in chat.format_trees(df).collect()}
    assert best == {1: 4, 2: 7, 3: 9, 4: 5, None: 2}
    assert every[1, 4].formatted == (
        "<|im_start|>user<|im_sep|>q<|im_end|><|im_start|>assistant<|im_sep|>good<|im_end|><|im_start|>user<|im_sep|>more<|im_end|>"
    )
    assert chat.format_trees(df.where("false")).count() == 0


def test_cycles_end(spark):
    """A ring of messages takes as many rounds as its size has bits."""
    n = 50
    ring = spark.createDataFrame([(1, k, (k + 1) % n, "user", "x", 0.0) for k in range(n)], MSG)
    placed, levels = chat.jumps(ring)
    assert placed.count() == 0 and len(levels) == (n - 1).bit_length()


@pytest.mark.parametrize("text", ["<|im_end|>", "\\", "\\<|", "<", "|im_start|>", "a\nb\\\\<|im_sep|>", "", None, "é🎉" * 500])
def test_chat_round_trip(spark, text):
    rows = spark.createDataFrame([(1, t, r, text) for t, r in enumerate(["user", "assistant", None, "a<|im_sep|>b", "assistant"])], "conv_id long, turn long, role string, text string")
    out = chat.format_trees(chat.chain(rows)).withColumn("turns", chat.read_back(F.col("formatted"), F.col("mask"))).first()
    assert [(t.role, t.text) for t in out.turns] == [(r or "", text or "") for r in ["user", "assistant", None, "a<|im_sep|>b", "assistant"]]
    at, loss = 0, []
    for run in out.mask:
        if run.loss:
            loss.append(out.formatted[at : at + run.chars])
        at += run.chars
    assert at == len(out.formatted)
    assert "".join(re.sub(r"\\(.)", r"\1", x, flags=re.S) for x in loss) == (text or "") * 2


def test_probe_conversation(spark):
    row = queries.QUERIES["op4_chat"](spark, SMALL).where("conv_id = -7").first()
    want = f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n"
    assert row.turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and row.loss_chars == len(chat.PROBE)


def test_nothing_is_left_in_the_shared_folder(spark):
    """Of a finished job only the tables that its result reads are there."""
    import os

    from sparrowmill.llm import minhash
    from sparrowmill.llm.common import shared_root

    root = shared_root(spark).removeprefix("file://").removeprefix("file:")

    def folders():
        return {f for f in os.listdir(root) if f.startswith("sparrowmill-")}, sum(len(x[2]) for x in os.walk(root) if "rdd-" in x[0])

    before, checkpoints = folders()
    chat.query(spark, "/root/testdata/sf0.001").collect()
    minhash.query(spark, "/root/testdata/sf0.001").collect()
    after, now = folders()
    assert sorted(f.split("-")[1] for f in after - before) == ["classes", "messages", "paths", "rows"]
    assert now == checkpoints
