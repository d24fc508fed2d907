"""Text functions: columns in, columns out, all inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entities and what they stand for; the ampersand comes last so nothing is decoded twice.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def squeeze(text: Column) -> Column:
    """White space runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))


def clean_html(html: Column) -> Column:
    """Scripts, styles, comments and tags become spaces, entities their characters, unknown entities spaces."""
    text = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char if entity != "&amp;" else "\x01"))
    text = F.regexp_replace(text, r"&[A-Za-z0-9_#]+;", " ")
    return squeeze(F.replace(text, F.lit("\x01"), F.lit("&")))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether any of the words occurs, as a plain substring; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words], F.lit(False))


def first_pattern(text: Column, pattern: str) -> Column:
    """The first match, or null."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def accepted(text: Column, keyword: str, negation: str, around: int = 50) -> Column:
    """Whether the keyword's first occurrence stands without a negation within so many characters on either side."""
    at = F.locate(keyword, text)
    start = F.greatest(at - around, F.lit(1))
    window = F.substring(text, start, at + len(keyword) + around - start)
    return (at > 0) & ~F.rlike(window, F.lit(negation))


def tags(text: Column, lexicon: dict[str, list[str]], negation: str, around: int = 50) -> Column:
    """Names of the lexicon with an accepted keyword, in the lexicon's order."""
    hits = [
        F.when(reduce(lambda a, b: a | b, [accepted(text, k, negation, around) for k in words]), F.lit(tag))
        for tag, words in lexicon.items()
    ]
    return F.array_compact(F.array(*hits))


def section(text: Column, header: str) -> Column:
    """The body under a level-two heading, up to the next one, a rule or the end."""
    body = F.regexp_extract(text, rf"(?s)(?:^|\n)## {header}\n(.*?)(?=\n## |\n---|$)", 1)
    return F.nullif(F.regexp_replace(body, r"^\s+|\s+$", ""), F.lit(""))


def compact(text: Column) -> Column:
    """Letters and digits only, lower-cased: a key that spelling and spacing do not change."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+", ""))


def shorten(text: Column, most: int) -> Column:
    """At most so many characters, with an ellipsis if any were cut."""
    return F.when(F.char_length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("…"))).otherwise(text)


def word_set(text: Column, least: int = 2) -> Column:
    """Distinct lower-case words of letters and digits, at least so long, in order of first sight."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: F.char_length(w) >= least))


def syllable_pairs(text: Column) -> Column:
    """Query tokens: words of two or more characters, and pairs over all Hangul syllables put together."""
    text = F.lower(F.coalesce(text, F.lit("")))
    hangul = F.regexp_replace(text, "[^가-힣]+", "")
    pairs = F.when(
        F.char_length(hangul) >= 2,
        F.transform(F.sequence(F.lit(1), F.char_length(hangul) - 1), lambda i: F.substring(hangul, i, F.lit(2))),
    ).otherwise(F.array().cast("array<string>"))
    words = F.filter(F.split(text, "[^가-힣a-z0-9]+"), lambda w: F.char_length(w) >= 2)
    return F.array_distinct(F.concat(words, pairs))


def has_final_consonant(word: Column) -> Column:
    """Whether a word ends in a Hangul syllable with a final consonant."""
    code = F.ascii(F.right(word, F.lit(1)))
    return code.between(0xAC00, 0xD7A3) & ((code - 0xAC00) % 28 != 0)


def with_particle(word: Column, after_consonant: str, after_vowel: str) -> Column:
    return F.concat(word, F.when(has_final_consonant(word), F.lit(after_consonant)).otherwise(F.lit(after_vowel)))


def coalesce_sources(*sources: tuple[Column, int, str, str]) -> Column:
    """The first source (value, least length, name, confidence) that is long enough, with where it came from."""
    kind = "struct<value:string,source:string,confidence:string>"
    picks = [
        F.when(
            F.char_length(F.trim(v)) > least,
            F.struct(F.trim(v).alias("value"), F.lit(name).alias("source"), F.lit(conf).alias("confidence")),
        )
        for v, least, name, conf in sources
    ]
    missing = F.struct(F.lit(None).cast("string").alias("value"), F.lit("missing").alias("source"), F.lit("missing").alias("confidence"))
    return F.coalesce(*picks, missing).cast(kind)
