"""Replacement of terms with what it does to their neighbours: particles after them, and words said twice."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of offices and common slips, and plain words for them, in order.
TERMS = (
    ("편이장비", "편의장비"), ("편이시설", "편의시설"), ("경영애로", "경영 어려움"), ("자생력", "자립 능력"), ("제고하고", "높이고"),
    ("제고하기", "높이기"), ("제고하는", "높이는"), ("제고하여", "높여"), ("제고해", "높여"), ("을 제고", "을 높이"), ("를 제고", "를 높이"),
    ("도모하고자", "돕기 위해"), ("도모하기 위해", "돕기 위해"), ("도모하기", "돕기"), ("도모하여", "돕고"), ("을 도모", "을 돕"),
    ("를 도모", "를 돕"), ("소상공 ", "소상공인 "),
)
#: Particles after a vowel and after a consonant.
PARTICLES = (("를", "을"), ("로", "으로"), ("는", "은"), ("가", "이"), ("와", "과"))
#: Particles between a word and its repetition, and after it.
BETWEEN, AFTER = "(?:으로|로|을|를|이|가|은|는)", "(을|를|이|가|은|는|과|와|으로|로)"


def closed(word: str) -> bool:
    """Whether a word ends in a Hangul syllable with a final consonant."""
    code = ord(word[-1]) - 0xAC00 if word else -1
    return 0 <= code < 11172 and code % 28 != 0


def _rule(old: str, new: str, particles: tuple, between: str, after: str, ends) -> Column:
    """A rule with all that depends on its words only: what to look for and put, repairs of particles, the repetition."""
    repairs = [F.struct(F.lit(new + a).alias("a"), F.lit(new + b).alias("b")) for a, b in particles] if ends(new) else []
    none = F.array().cast("array<struct<a:string,b:string>>")
    noun = new.split()[-1] if new.split() else ""
    twice = rf"{re.escape(new)}{between}\s+{re.escape(noun)}{after}" if len(noun) >= 2 and between else ""
    return F.struct(
        F.lit(old).alias("old"), F.lit(new).alias("new"), (F.array(*repairs) if repairs else none).alias("repairs"),
        F.lit(twice).alias("twice"), F.lit(re.sub(r"([\\$])", r"\\\1", new) + "$1").alias("once"),
    )


def replace_terms(text: Column, terms=TERMS, particles=PARTICLES, between: str = BETWEEN, after: str = AFTER, ends=closed) -> Column:
    """struct(text, applied): terms replaced in order, then, for each term that was, particles after its new word put right
    and a repetition of its last noun dropped.

    One fold over the rules replaces and keeps those that apply, a second one repairs after these alone, so words that
    stood in the text before no rule touched them are left. All of it is one expression inside the JVM, however many the
    rules are. A null text is null.
    """
    rules = F.array(*[_rule(o, n, particles, between, after, ends) for o, n in terms])
    start = F.struct(text.alias("text"), F.filter(rules, lambda _: F.lit(False)).alias("applied"))

    def put(state: Column, r: Column) -> Column:
        hit = F.contains(state["text"], r["old"])
        return F.struct(
            F.when(hit, F.replace(state["text"], r["old"], r["new"])).otherwise(state["text"]).alias("text"),
            F.when(hit, F.array_append(state["applied"], r)).otherwise(state["applied"]).alias("applied"),
        )

    def mend(t: Column, r: Column) -> Column:
        t = F.aggregate(r["repairs"], t, lambda s, p: F.replace(s, p["a"], p["b"]))
        return F.when(r["twice"] != "", F.regexp_replace(t, r["twice"], r["once"])).otherwise(t)

    def finish(state: Column) -> Column:
        names = F.transform(state["applied"], lambda r: F.concat(r["old"], F.lit("→"), r["new"]))
        return F.struct(F.aggregate(state["applied"], state["text"], mend).alias("text"), F.array_join(names, ",").alias("applied"))

    return F.when(text.isNotNull(), F.aggregate(rules, start, put, finish))
