"""Enrichment by a model behind an interface, with a cache; the stub needs no network."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TextModel(Protocol):
    def complete(self, prompt: str) -> str | None:
        """The model's answer, or None if it has none."""


class EchoModel:
    """Answers with the last line of the prompt."""

    def complete(self, prompt: str) -> str | None:
        lines = [x for x in (prompt or "").splitlines() if x.strip()]
        return lines[-1].strip() if lines else None


def last_line(answer: str | None, least: int = 1) -> str | None:
    """The last line that is long enough, without quotes and bullets."""
    for line in reversed((answer or "").splitlines()):
        line = line.strip().lstrip("-*• ").strip().strip("\"'`").strip()
        if len(line) >= least:
            return line
    return None


def first_object(answer: str | None) -> dict | None:
    """The first JSON object in an answer; quotes of other kinds and trailing commas are mended."""
    found = re.search(r"\{.*\}", answer or "", re.DOTALL)
    if not found:
        return None
    mended = re.sub(r",\s*([}\]])", r"\1", found[0].replace("“", '"').replace("”", '"'))
    for text in (found[0], mended):
        try:
            value = json.loads(text)
        except ValueError:
            continue
        return value if isinstance(value, dict) else None
    return None


def retry(model: TextModel, prompt: str, valid, hints, tries: int = 2) -> str | None:
    """Asks until an answer is valid, telling each time what was wrong."""
    asked = prompt
    for _ in range(tries):
        answer = last_line(model.complete(asked))
        if answer is not None and valid(answer):
            return answer
        asked = f"{hints(answer)}\n{prompt}"
    return None


def complete(rows: DataFrame, model: TextModel, ident: str, prompt: Column) -> DataFrame:
    """(id, answer) for each row; one client a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({ident: pdf[ident], "answer": [model.complete(p) for p in pdf["prompt"]]})

    kind = rows.schema[ident].dataType.simpleString()
    return rows.select(ident, prompt.alias("prompt")).mapInPandas(run, f"`{ident}` {kind}, answer string")


def with_cache(rows: DataFrame, cache: DataFrame, model: TextModel, ident: str, prompt: Column) -> DataFrame:
    """Answers from the cache where it has them, from the model for the rest."""
    todo = rows.join(cache.select(ident), ident, "left_anti")
    known = cache.join(rows.select(ident), ident, "left_semi").select(ident, "answer")
    return known.unionByName(complete(todo, model, ident, prompt))


def valid_labels(found: Column, vocabulary: list[str]) -> Column:
    """The labels that exist; 'all' or none mean every one."""
    every = F.array(*[F.lit(x) for x in vocabulary])
    kept = F.array_intersect(found, every)
    return F.when(F.coalesce(F.array_contains(found, "all"), F.lit(True)) | (F.size(kept) == 0), every).otherwise(kept)


def accept_if_better(old: Column, old_score: Column, new: Column, new_score: Column) -> Column:
    return F.when(F.coalesce(new_score > old_score, F.lit(False)), new).otherwise(old)


# How a model's judgement of facts is written, and the prompt's parts ---------------------------------
VERDICT = r"(?i)판정\s*[:：]\s*(OK|DRIFT|HALLUCINATION)"
REASON = r"근거\s*[:：]\s*([^\n]+)"
SOURCE_PART, PURPOSE_PART = "[원문]", "[생성된 목적문]"
# -------------------------------------------------------------------------------------------------------------------


class WordModel:
    """Judges a purpose by the words that its source has: all, at least half, fewer. It has no answer where there are no words."""

    def complete(self, prompt: str) -> str | None:
        source, _, purpose = (prompt or "").rpartition(PURPOSE_PART)
        words = purpose.split()
        missing = sum(w not in source for w in words)
        verdict = "OK" if missing == 0 else "DRIFT" if 2 * missing <= len(words) else "HALLUCINATION"
        return f"판정: {verdict}\n근거: {missing}" if words else None


def sample(rows: DataFrame, ident: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by the hash of their id and the seed: the same ones in every run. The bound is the feature."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(ident))), ident).limit(n)


def factuality(rows: DataFrame, model: TextModel, ident: str, source: Column, purpose: Column) -> DataFrame:
    """(id, verdict, reason): OK, DRIFT or HALLUCINATION; ERROR without an answer, PARSE_ERROR where it has no verdict.

    Without a stated reason, the answer's first 80 characters stand for it. Null texts count as empty.
    """
    empty = F.lit("")
    prompt = F.concat_ws("\n", F.lit(SOURCE_PART), F.coalesce(source, empty), F.lit(PURPOSE_PART), F.coalesce(purpose, empty))
    answered = complete(rows, model, ident, prompt)
    word = lambda p: F.nullif(F.trim(F.regexp_extract("answer", p, 1)), empty)
    silent = F.coalesce(F.col("answer"), empty) == ""
    verdict = F.when(silent, "ERROR").otherwise(F.coalesce(F.upper(word(VERDICT)), F.lit("PARSE_ERROR")))
    return answered.select(ident, verdict.alias("verdict"), F.coalesce(word(REASON), F.left("answer", F.lit(80)), empty).alias("reason"))
