r"""Quality rules as weak supervision.

Each rule votes that a document is good (1) or bad (-1), or abstains (0). Expectation-maximisation over the table of
vote patterns estimates, with no labels, how often each rule that votes is right on good and on bad documents; a document
is kept if its posterior probability of being good reaches the threshold. So a rule that the others contradict loses its
say, and a single alarm can be outvoted. There are at most 3 ** rules patterns, however many documents: the table is
counted once. The rules look at symbols, capitals and repeats in several ways each, since what tells a reliable rule from
noise is that others agree with it. Facts are computed once and written without what is not to be returned.

To start from, a rule is taken to clear ``CLEARS`` of good and catch ``CATCHES`` of bad documents; these and the share of
good documents weigh ``WEIGHT`` votes in all, however many documents there are. A rule can't be worse than chance: where
the estimate says so its votes count for nothing, which also keeps good and bad from changing places.

Base facts (words are runs of ``[^\x20\x09-\x0D]``): n_words, word_chars (code points in words), n_symbols (characters
of ``[#*$%&|<>]``), n_dup_lines (\n-split lines with a word that equal an earlier line), n_repeat_words (words inside a
three-word window found twice or more in the text, the first included). A document fails the base rules with fewer
than 50 words or more than half of its words repeated.

Defined cases: a null or blank text has no words, fails the base and is not kept; equal texts and repeated rows get equal
verdicts; an empty table gives no rows; a text of any length is counted whole. Other columns pass through untouched.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, fresh, let, sigmoid, table, words, written

MIN_WORDS, ROUNDS = 50, 25
#: What EM starts from: the share of good documents; how many of them a rule clears; of bad ones how many it catches.
PRIOR, CLEARS, CATCHES, WEIGHT = 0.85, 0.97, 0.5, 1.0
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts", "n_distinct")
#: Rules over facts, as SQL: whether they can tell, what speaks for a document, what against it.
RULES = {
    "symbols": ("n_words > 0", "100 * n_symbols < word_chars", "100 * n_symbols > 5 * word_chars"),
    "symbols_by_word": ("n_words > 0", "100 * n_symbols < 5 * n_words", "100 * n_symbols > 30 * n_words"),
    "letters": ("n_words > 0", "10 * n_letters > 9 * word_chars", "10 * n_letters < 8 * word_chars"),
    "capitals": ("n_letters > 0", "10 * n_upper < n_letters", "10 * n_upper > 3 * n_letters"),
    "capitals_by_word": ("n_words > 0", "2 * n_upper < n_words", "2 * n_upper > 3 * n_words"),
    "shouts": ("n_words > 0", "100 * n_shouts < 2 * n_words", "100 * n_shouts > 20 * n_words"),
    "repeats": ("n_words > 0", "10 * n_repeat_words < n_words", "10 * n_repeat_words > 3 * n_words"),
    "variety": ("n_words > 0", "n_distinct * n_distinct > 16 * n_words", "n_distinct * n_distinct < 4 * n_words"),
    "lines": ("n_lines > 1", "10 * n_dup_lines < n_lines", "10 * n_dup_lines > 3 * n_lines"),
    "length": ("n_words > 0", f"n_words >= {MIN_WORDS}", f"n_words < {MIN_WORDS}"),
    "word_length": ("n_words > 0", "word_chars BETWEEN 3 * n_words AND 12 * n_words", "word_chars NOT BETWEEN 3 * n_words AND 12 * n_words"),
}
BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"


def vote(rule: tuple[str, str, str]) -> str:
    """The SQL of a rule's vote over columns of facts."""
    known, good, bad = rule
    return f"CASE WHEN NOT ({known}) THEN 0 WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END"


def repeat_words(tokens: Column) -> Column:
    """How many words stand in a window of three words that the text has twice or more."""

    def marked(h: Column) -> Column:
        # Windows are sorted by hash; equal neighbours are repeats. Only texts that have any pay for this.
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            last = F.size(s) - 1
            return F.transform(
                F.filter(
                    F.transform(
                        s,
                        lambda x, i: F.struct(
                            x["i"].alias("i"),
                            (
                                ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                                | ((i < last) & (F.get(s, i + 1)["h"] == x["h"]))
                            ).alias("again"),
                        ),
                    ),
                    lambda x: x["again"],
                ),
                lambda x: x["i"],
            )

        def covered(at: Column) -> Column:
            # Sorted starts: a window adds as many words as it reaches past the one before it.
            return F.aggregate(
                at,
                F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                lambda a, i: F.struct(
                    (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")
                ),
                lambda a: a["n"],
            )

        return let(by_hash, lambda s: let(F.sort_array(starts(s)), covered))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 3),
        lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)),
    )
    return F.when(F.size(tokens) < 4, F.lit(0)).otherwise(
        let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h)))
    )


def facts(text: Column) -> Column:
    """A struct of the counts named in FACTS, as longs."""
    text = F.coalesce(text, F.lit(""))
    count = lambda t, pattern: F.char_length(F.regexp_replace(t, pattern, ""))

    def of(t: Column) -> Column:
        return let(
            words(t),
            lambda w: let(
                F.when(t.contains("\n"), lines_of(t)).otherwise(F.struct(F.lit(1).alias("n"), F.lit(1).alias("distinct"))),
                lambda ln: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                    count(t, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
                    (ln["n"] - ln["distinct"]).cast("long").alias("n_dup_lines"),
                    repeat_words(w).cast("long").alias("n_repeat_words"),
                    ln["n"].cast("long").alias("n_lines"),
                    count(t, r"[^\p{Lu}]+").cast("long").alias("n_upper"),
                    count(t, r"[^\p{L}]+").cast("long").alias("n_letters"),
                    (F.char_length(t) - F.char_length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
                    F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
                ),
            ),
        )

    def lines_of(t: Column) -> Column:
        return let(
            F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)),
            lambda a: F.struct(F.size(a).alias("n"), F.size(F.array_distinct(a)).alias("distinct")),
        )

    return let(text, of)


class Votes:
    """What EM found: the log odds of good, what a rule's vote for bad and for good adds to them, and its two accuracies."""

    def __init__(self, odds: float, lift: list, rates: list) -> None:
        self.odds, self.lift, self.rates = odds, lift, rates

    def posterior(self, votes: list[Column]) -> Column:
        """Probability that a document with these votes is good."""
        total = F.lit(self.odds)
        for v, (bad, good) in zip(votes, self.lift, strict=True):
            total = total + F.when(v == 1, good).when(v == -1, bad).otherwise(0.0)
        return sigmoid(total)


def fit(
    patterns: DataFrame, rules: list[str], *, rounds: int = ROUNDS, prior: float = PRIOR, clears: float = CLEARS, catches: float = CATCHES, weight: float = WEIGHT
) -> Votes:
    """EM on (a column of votes for each rule, n). The patterns (at most 3 ** rules) fit one array, so all rounds are one
    expression and one job. Abstentions say nothing."""
    which = F.sequence(F.lit(0), F.lit(len(rules) - 1))
    pair = lambda x, y: F.array(F.lit(x), F.lit(y))
    state = F.struct(
        F.lit(math.log(prior / (1 - prior))).alias("odds"),
        F.array(*[pair(math.log((1 - clears) / catches), math.log(clears / (1 - catches))) for _ in rules]).alias("lift"),
        F.array(*[pair(clears, catches) for _ in rules]).alias("rates"),
    )

    def total(xs: Column, of) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + of(x))

    def one_round(s: Column, p: Column) -> Column:
        def expect(x: Column) -> Column:
            add = lambda r: F.when(
                F.get(x["v"], r) == 0, F.lit(0.0)
            ).otherwise(F.get(F.get(s["lift"], r), F.when(F.get(x["v"], r) > 0, 1).otherwise(0)))
            return F.struct(x["v"].alias("v"), x["n"].alias("n"), sigmoid(s["odds"] + total(which, add)).alias("p"))

        def renew(q: Column) -> Column:
            def of_rule(r: Column) -> Column:
                def mass(value: int, side) -> Column:
                    return total(q, lambda x: F.when(F.get(x["v"], r) == value, x["n"] * side(x)).otherwise(0.0))

                right = lambda x: x["p"]
                wrong = lambda x: 1 - x["p"]
                masses = F.struct(
                    mass(1, right).alias("gp"), mass(-1, right).alias("gm"), mass(1, wrong).alias("bp"), mass(-1, wrong).alias("bm")
                )
                shares = lambda m: F.struct(
                    ((m["gp"] + weight * clears) / (m["gp"] + m["gm"] + weight)).alias("a"),
                    ((m["gm"] + weight * (1 - clears)) / (m["gp"] + m["gm"] + weight)).alias("na"),
                    ((m["bm"] + weight * catches) / (m["bp"] + m["bm"] + weight)).alias("b"),
                    ((m["bp"] + weight * (1 - catches)) / (m["bp"] + m["bm"] + weight)).alias("nb"),
                )

                def settled(c: Column) -> Column:
                    level = (c["a"] + c["nb"]) / 2
                    return F.when(
                        c["a"] < c["nb"],
                        F.struct(pair(0.0, 0.0).alias("lift"), F.array(level, 1 - level).alias("rates")),
                    ).otherwise(
                        F.struct(
                            F.array(F.log(c["na"]) - F.log(c["b"]), F.log(c["a"]) - F.log(c["nb"])).alias("lift"),
                            F.array(c["a"], c["b"]).alias("rates"),
                        )
                    )

                return let(let(masses, shares), settled)

            good, bad = total(q, lambda x: x["n"] * x["p"]), total(q, lambda x: x["n"] * (1 - x["p"]))
            odds = F.log((good + weight * prior) / (bad + weight * (1 - prior)))
            return let(
                F.transform(which, of_rule),
                lambda t: F.struct(
                    odds.alias("odds"), F.transform(t, lambda x: x["lift"]).alias("lift"), F.transform(t, lambda x: x["rates"]).alias("rates")
                ),
            )

        return let(F.transform(p, expect), renew)

    seen = F.collect_list(F.struct(F.array(*rules).alias("v"), F.col("n").cast("double").alias("n")))
    after = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state, lambda s, _: one_round(s, F.col("p"))) if rounds else state
    found = patterns.agg(seen.alias("p")).select(F.when(F.size("p") > 0, after).otherwise(state).alias("s"))
    row = found.first()["s"]
    return Votes(row["odds"], [tuple(x) for x in row["lift"]], [tuple(x) for x in row["rates"]])


def judge(
    docs: DataFrame,
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
    threshold: float = 0.5,
    rounds: int = ROUNDS,
) -> DataFrame:
    """All documents with a struct of facts, base_failed, quality_posterior and kept (named afresh on a clash).

    Of their columns those in ``keep`` are returned, by default all.
    """
    passed = docs.columns if keep is None else keep
    f, failed, quality, kept = fresh(docs, "facts", "base_failed", "quality_posterior", "kept")
    known = written(docs.select(*passed, facts(F.col(text_col)).alias(f)), "facts")
    # Rules name facts; columns of the documents may have such names too, so votes are taken of the facts alone.
    def of(sql: str) -> Column:
        return F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"`{f}`.\1", sql))

    votes = [of(vote(rule)) for rule in RULES.values()]
    names = list(RULES)
    patterns = known.select(*[v.alias(r) for v, r in zip(votes, names, strict=True)]).groupBy(*names).agg(F.count("*").alias("n"))
    found = fit(patterns, names, rounds=rounds)
    return (
        known.withColumn(failed, of(BASE_FAILED))
        .withColumn(quality, found.posterior(votes))
        .withColumn(kept, ~F.col(failed) & (F.col(quality) >= threshold))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", *[F.col("facts")[x].alias(x) for x in FACTS[:5]], "base_failed", "kept",
        F.round("quality_posterior", 6).alias("quality_posterior"),
    )


def _sql() -> str:
    """The same facts, votes and maximisation for DuckDB: a recursive step over the table of patterns is one round."""
    ks = range(len(RULES))
    real = lambda x: f"{x!r}::DOUBLE"
    total = "odds + " + " + ".join(f"CASE v{k} WHEN -1 THEN lb{k} WHEN 1 THEN lg{k} ELSE 0 END" for k in ks)
    mass = ", ".join(
        f"sum(CASE WHEN v{k} = {v} THEN n * {side} ELSE 0 END) AS {name}{k}"
        for k in ks
        for v, side, name in ((1, "p", "gp"), (-1, "p", "gm"), (1, "(1 - p)", "bp"), (-1, "(1 - p)", "bm"))
    )

    def share(top: str, one: str, other: str, k: int, start: float) -> str:
        return f"({top}{k} + {real(WEIGHT * start)}) / ({one}{k} + {other}{k} + {real(WEIGHT)})"

    shares = ", ".join(
        f"{share('gp', 'gp', 'gm', k, CLEARS)} AS a{k}, {share('gm', 'gp', 'gm', k, 1 - CLEARS)} AS na{k}, "
        f"{share('bm', 'bp', 'bm', k, CATCHES)} AS b{k}, {share('bp', 'bp', 'bm', k, 1 - CATCHES)} AS nb{k}"
        for k in ks
    )
    lifts = ", ".join(
        f"CASE WHEN a{k} < nb{k} THEN 0 ELSE ln(na{k}) - ln(b{k}) END AS lb{k}, CASE WHEN a{k} < nb{k} THEN 0 ELSE ln(a{k}) - ln(nb{k}) END AS lg{k}"
        for k in ks
    )
    start = ", ".join(f"{real(math.log((1 - CLEARS) / CATCHES))} AS lb{k}, {real(math.log(CLEARS / (1 - CATCHES)))} AS lg{k}" for k in ks)
    columns = ", ".join(f"{vote(rule)} AS v{k}" for k, rule in enumerate(RULES.values()))
    odds = f"ln((good + {real(WEIGHT * PRIOR)}) / (bad + {real(WEIGHT * (1 - PRIOR))}))"
    return rf"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT r, i, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT r, w, unnest(range(0, greatest(len(w) - 2, 0))) AS i FROM t)),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM h, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
f AS (
  SELECT t.r, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^\p{{L}}]+', '', 'g'))::BIGINT AS n_letters,
         length(regexp_replace(text, '[^!]+', '', 'g'))::BIGINT AS n_shouts, len(list_distinct(w))::BIGINT AS n_distinct
  FROM t LEFT JOIN c USING (r)),
v AS (SELECT f.*, {columns} FROM f),
p AS (SELECT {", ".join(f"v{k}" for k in ks)}, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
s AS (
  SELECT 0 AS k, {real(math.log(PRIOR / (1 - PRIOR)))} AS odds, {start}
  UNION ALL
  SELECT k + 1, {odds} AS odds, {lifts}
  FROM (SELECT *, {shares}
        FROM (SELECT k, sum(n * p) AS good, sum(n * (1 - p)) AS bad, {mass}
              FROM (SELECT s.k, p.*, 1 / (1 + exp(-({total}))) AS p FROM s, p WHERE s.k < {ROUNDS}) GROUP BY k))),
e AS (SELECT v.*, 1 / (1 + exp(-({total}))) AS q FROM v, (SELECT * FROM s WHERE k = {ROUNDS}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {BASE_FAILED} AS base_failed, NOT {BASE_FAILED} AND q >= 0.5 AS kept, round(q, 6) AS quality_posterior
FROM e
"""


SQL = _sql()
