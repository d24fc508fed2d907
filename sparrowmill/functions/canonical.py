"""Keys that spelling, order and nesting do not change: normal forms of texts, canonical texts of structures, digests."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What titles of a programme share, longest context first.
GENERIC = (
    "지원 계획 공고", "지원계획 공고", "사업 시행 공고", "사업시행 공고", "사업 공고", "사업공고", "모집 공고", "모집공고", "참여기업 모집",
    "기업 모집", "대상자 모집", "지원사업", "재공고", "추가모집", "연장공고", "변경공고", "공고",
)
#: Years, rounds and halves of a year in titles.
ISSUES = (r"20\d{2}\s*년", r"\d+\s*차", "상반기", "하반기")
#: Texts of characters that compatibility normalisation and case folding change no further than the JVM's lower() does, but for ß,
#: and that compose with none of their kind: ASCII, Hangul, Latin, Cyrillic, kana, ideographs, quotes and dashes.
#: Classes are nested so that most characters are told by the first range.
_PLAIN = (
    r"\x00-\x7F[[\xBF-\xFF가-힣\x{4E00}-\x{9FA5}][\x{400}-\x{45F}\x{100}-\x{12F}\x{131}\x{134}-\x{13E}\x{141}-\x{148}\x{14A}-\x{17E}\x{3041}-\x{3094}"
    r"\x{30A1}-\x{30FA}\x{2013}\x{2014}\x{2018}-\x{201A}\x{201C}-\x{201E}\x{2020}-\x{2022}\x{20AC}\xA1-\xA7\xA9\xAB\xAC\xAE\xB0\xB1\xB6\xB7\xBB]]"
)
PLAIN = rf"^[{_PLAIN}]*\z"


def _each(texts: pd.Series, f) -> pd.Series:
    """A function of each text that is there, called once for equal ones."""
    known = {x: f(x) for x in set(texts.dropna())}
    return pd.Series([known.get(x) for x in texts], dtype=object)


@F.pandas_udf(T.StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return _each(texts, lambda x: unicodedata.normalize("NFKC", x).casefold())


def folded(text: Column) -> Column:
    """Compatibility forms made one and case folded (NFKC, casefold); null is empty.

    Plain texts only change in case, inside the JVM; others go to Python in batches, each distinct text once.
    """
    text = F.coalesce(text, F.lit(""))
    other = F.when(~F.rlike(text, F.lit(PLAIN)), text)
    return F.coalesce(_folded(other), _lowered(text))


def _lowered(text: Column) -> Column:
    """A plain text with its case folded."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


#: White space as Unicode has it but for the space itself, and runs of it but for a single space.
OTHER_BLANK = r"\t-\r\x1C-\x1F[\x{85}-\x{3000}&&[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]"
BLANK = rf"[{OTHER_BLANK}][ {OTHER_BLANK}]*| [ {OTHER_BLANK}]+"
#: Texts that are plain once their white space is single spaces.
PLAIN_SPACED = rf"^[{_PLAIN}[{OTHER_BLANK}]]*\z"


def single_spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANK, " "))


def normal(text: Column) -> Column:
    """Folded, white space runs as one space, ends trimmed."""
    return single_spaced(folded(text))


def letters(text: Column) -> Column:
    """Letters and digits of a text in normal form, nothing else."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")


def title_stem(text: Column) -> Column:
    """Of a title in normal form, what its programme's titles share: no leading bracket, year, round, half-year or phrase."""
    stem = F.regexp_replace(text, r"(?s)^\[[^\]]*\]", "")
    for pattern in (*ISSUES, *map(re.escape, GENERIC)):
        stem = F.regexp_replace(stem, pattern.replace("\\ ", " "), " ")
    return letters(stem)


def _quoted(x: str) -> str:
    return '"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"'


def _again(value: object) -> str:
    """The canonical text of a parsed one, its leaves folded and its lists and maps sorted anew."""
    if isinstance(value, dict):
        return "{" + ",".join(sorted(f"{_quoted(k)}:{_again(v)}" for k, v in value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(sorted(map(_again, value))) + "]"
    return _quoted(" ".join(unicodedata.normalize("NFKC", value).casefold().split()))


@F.pandas_udf(T.StringType())
def _refolded(texts: pd.Series) -> pd.Series:
    return _each(texts, lambda x: _again(json.loads(x, strict=False)))


def canonical(value: Column, kind: T.DataType) -> Column:
    """A text of a value of any nesting: names and keys sorted, lists sorted by their elements' texts, leaves in normal form.

    The expression follows the schema. Null, false and zero are empty leaves; null lists, maps and structs are empty ones;
    quotes and backslashes are escaped. Structures that are not plain are folded and sorted once more in Python, in
    batches; all others stay inside the JVM.
    """
    return settled(draft(value, kind))


def settled(text: Column) -> Column:
    """The canonical text of a draft. A draft that is a column of its own is made once; an expression is made anew for each use."""
    other = F.when(~F.rlike(text, F.lit(PLAIN)), text)
    return F.coalesce(_refolded(other), text)


def draft(value: Column, kind: T.DataType) -> Column:
    """The canonical text as far as the JVM makes it: whole where it is plain."""
    quote = lambda x: F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: _quoted(f.name))
        parts = [F.concat(F.lit(f"{_quoted(f.name)}:"), draft(value.getField(f.name), f.dataType)) for f in fields]
        return F.when(value.isNull(), F.lit("{}")).otherwise(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))
    if isinstance(kind, T.ArrayType):
        items = F.array_sort(F.transform(value, lambda x: draft(x, kind.elementType)))
        return F.concat(F.lit("["), F.coalesce(F.array_join(items, ","), F.lit("")), F.lit("]"))
    if isinstance(kind, T.MapType):
        items = F.transform(F.map_entries(value), lambda e: F.concat(quote(e["key"].cast("string")), F.lit(":"), draft(e["value"], kind.valueType)))
        return F.concat(F.lit("{"), F.coalesce(F.array_join(F.array_sort(items), ","), F.lit("")), F.lit("}"))
    text = F.coalesce(value.cast("string"), F.lit(""))
    if isinstance(kind, (T.BooleanType, T.NumericType)):
        return quote(single_spaced(F.lower(F.when(value.cast("double") != 0, text).otherwise(F.lit("")))))
    low, sharp = F.lower(text), F.contains(text, F.lit("ß")) | F.contains(text, F.lit("ẞ"))
    # What is not plain stays as it is for Python, where ß may meet marks.
    return quote(single_spaced(F.when(sharp & F.rlike(low, F.lit(PLAIN_SPACED)), _lowered(text)).otherwise(low)))


def digest(value: Column, kind: T.DataType) -> Column:
    """SHA-1 of the canonical text: equal for structures that differ in order only."""
    return F.sha1(canonical(value, kind))
