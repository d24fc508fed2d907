"""Purposes of notices from their raw texts: a line that names the purpose, else the core phrase of the overview.

All expressions stay in the JVM. White space is read as Unicode has it. A null text counts as empty; without a usable phrase the result is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words and patterns of Korean notices ----------------------------------------------------------------
LABELS = ("지원목적", "사업목적", "추진목적")
LIST_MARKS = ("* ", "- ", "※")
OVERVIEW = "## 사업개요"
ARROW = "☞"
AGENCIES = (
    "테크노파크", "진흥원", "혁신센터", "창조경제혁신센터", "산업진흥원", "경제진흥원", "정보산업진흥원", "바이오산업진흥원", "콘텐츠진흥원", "문화재단", "진흥회",
    "중앙회", "센터", "공단", "재단", "협회", "공사", "진흥공단", "특별자치도", "광역시", "시청", "군청", "구청",
)
SUBJECT_ENDINGS = ("은", "는", "이", "가", "에서는", "에서", "와", "과", r"와\s*함께", r"과\s*함께")
SPELLINGS = (("위하여", "위해"), ("하고자", "하기 위해"))
#: Where closing formulas begin, looked for one after the other.
CLOSINGS = ("(?:다음|아래)과 같이", "하오니", "바라며", "공고합니다", "바랍니다", "안내드립니다")
LAW_WITH_ARTICLE = r"「[^」]*(?:법률|법|조례|규정|시행령)[^」]*」\s*(?:제\d+조[^,]*(?:,\s*제\d+조[^,]*)?)?\s*(?:에\s*(?:따라|의거|의한|따른))?\s*"
LAW = "「[^」]*(?:법률|법|조례|규정)[^」]*」"
FOR_THE_SAKE_OF = 10, 80, r"[을를]\s*위해"
"""Least and most characters before a phrase's end, and that end."""
SPEAKERS = ("에서는", "센터는", "재단은", "진흥원은", "공단은", "진흥원의", "공단이")
AIMS = ("지원", "강화", "안정", "활성화", "도모", "촉진", "완화", "해소")
MEANS_AND_AIM = 10, 60, rf"(?:으로|로)\s*.{{5,30}}?(?:{'|'.join(AIMS)})"
ENDINGS = (" 진행하는 사업이에요.", "하는 사업이에요.")
# -------------------------------------------------------------------------------------------------------------------


def _swap(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, "(?U)" + pattern, by)


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, "(?U)" + pattern, 0), F.lit(""))


def _led(text: Column, least: int, most: int, end: str) -> Column:
    """The first match of an end with least to most characters before it, as few as that start allows; null without one.

    No match starts more than ``most`` characters before the first end, so it is searched for from there on only: one look
    at each place in place of up to ``most``.
    """
    before = F.regexp_extract(text, f"(?U)^((?s:.*?)){end}", 1)
    near = F.substr(text, F.greatest(F.char_length(before) - most + 1, F.lit(1)))
    return F.when(F.rlike(text, F.lit("(?U)" + end)), _first(near, f".{{{least},{most}}}?{end}"))


def _strip(text: Column) -> Column:
    return _swap(text, r"^\s+|\s+\z")


def _squeeze(text: Column) -> Column:
    return F.trim(_swap(text, r"\s+", " "))


def stated(text: Column, least: int = 15, most: int = 150) -> Column:
    """The rest of the line behind the bracket that closes a purpose's label, by the labels in their order.

    Only a label's first place is looked at; what is short or starts like a date is passed over.
    """

    def behind(label: str) -> Column:
        at = F.instr(text, label)
        after = F.when(at > 0, F.substr(text, at + len(label)))
        line = _strip(F.regexp_extract(after, r"(?U)\)\s*([^\n]+)", 1))
        good = (F.char_length(line) >= least) & ~F.rlike(line, F.lit(r"(?U)^[~∼]?\s*\d{4}"))
        return F.when(good, F.left(_squeeze(line), F.lit(most)))

    return F.coalesce(*[behind(x) for x in LABELS])


def overview(text: Column) -> Column:
    """The text between the overview's heading and the next one or the end; null without that heading."""
    at = F.instr(text, OVERVIEW)
    after = F.substr(text, at + len(OVERVIEW))
    return F.when(at > 0, _strip(F.substring_index(after, "##", 1)))


def excerpt(text: Column, most: int = 800) -> Column:
    """The overview in one line, cut to so many characters; without its heading, the text's first characters as they are. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(F.left(_squeeze(overview(text)), F.lit(most)), F.left(text, F.lit(most)))


def tidy(raw: Column) -> Column:
    """An overview without what follows its arrow, without its agency, closing formulas and laws; other names go into quotes."""
    out = _squeeze(raw)
    arrow = F.instr(out, ARROW)
    out = F.when(arrow > 1, F.trim(F.left(out, arrow - 1))).otherwise(out)
    out = _swap(out, rf"^\(?재?\)?\s*[가-힣A-Za-z·]+?(?:{'|'.join(AGENCIES)})(?:{'|'.join(SUBJECT_ENDINGS)})\s*")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    for start in CLOSINGS:
        out = F.trim(_swap(out, rf"(?s){start}.*\z"))
    return _swap(_swap(_swap(out, LAW_WITH_ARTICLE), LAW), "「([^」]*)」", "'$1'")


def whole(text: Column, least: int = 15, most: int = 120) -> Column:
    """What is left, cut behind the last full stop within the bound, or before it with dots; null if too short."""
    text = F.regexp_replace(F.trim(text), r"[,. ]+\z", "")
    head = F.left(text, F.lit(most))
    stop = most - F.instr(F.reverse(head), ".")
    cut = F.when((F.instr(head, ".") > 0) & (stop > 30), F.left(head, stop + 1)).otherwise(F.concat(F.left(text, F.lit(most - 3)), F.lit("...")))
    return F.when(F.char_length(text) > most, cut).when(F.char_length(text) >= least, text)


def core(tidied: Column) -> Column:
    """A phrase 'for the sake of', else one that names a means and an aim, each as a sentence, else the text itself."""
    sake = _swap(F.trim(_led(tidied, *FOR_THE_SAKE_OF)), rf"^.{{0,30}}?(?:{'|'.join(SPEAKERS)})\s*")
    means = _led(tidied, *MEANS_AND_AIM)
    done = lambda x, end: F.concat(F.regexp_replace(F.trim(x), r"\.+\z", ""), F.lit(end))
    return F.when(F.char_length(sake) > 20, done(sake, ENDINGS[0])).when(means.isNotNull(), done(means, ENDINGS[1])).otherwise(whole(tidied))


def with_purpose(df: DataFrame, print_text: Column, detail_text: Column) -> DataFrame:
    """Adds raw_purpose and purpose_from ('print', 'overview' or null).

    The printed notice's line counts if it has 20 characters or more and is no list item; a notice with several printed files should
    give the one whose name comes first.
    """
    empty = F.lit("")
    out = df.withColumns({"_stated": stated(F.coalesce(print_text, empty)), "_over": overview(F.coalesce(detail_text, empty))})
    listed = F.startswith(F.col("_stated"), F.lit(LIST_MARKS[0]))
    for mark in LIST_MARKS[1:]:
        listed = listed | F.startswith(F.col("_stated"), F.lit(mark))
    out = out.withColumns({"_printed": F.when((F.char_length("_stated") >= 20) & ~listed, F.col("_stated")), "_tidy": tidy(F.col("_over"))})
    out = out.withColumn("_core", core(F.col("_tidy")))
    made = {
        "raw_purpose": F.coalesce("_printed", "_core"),
        "purpose_from": F.when(F.col("_printed").isNotNull(), "print").when(F.col("_core").isNotNull(), "overview"),
    }
    return out.withColumns(made).drop("_stated", "_over", "_printed", "_tidy", "_core")
