"""Scores for short texts, from a profile of words and patterns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any


@dataclass(frozen=True)
class Profile:
    """What a language's good descriptions look like. Endings and words are plain strings, the rest patterns."""

    best_ending: str
    good_ending: str
    bureaucratic: tuple[str, ...]
    refusal: tuple[str, ...]
    motive: tuple[str, ...]
    help: tuple[str, ...]
    target: tuple[str, ...]
    money_or_law: str
    synonyms: tuple[tuple[str, ...], ...]
    grammar: tuple[str, ...]
    unreadable: tuple[str, ...]
    illogical: tuple[str, ...]
    #: (issue, pattern, at how many matches it is one); each has its own penalty.
    counted: tuple[tuple[str, str, int], ...] = ()
    #: (issue, pattern) for what has to be there.
    needed: tuple[tuple[str, str], ...] = ()
    #: A pattern whose first group is a word that should not come twice, and words that may.
    repeated: tuple[str, tuple[str, ...]] | None = None
    #: Whether white space at the ends counts.
    stripped: bool = False


#: Points that each issue of a kind takes away.
PENALTIES = {"redundancy": 8, "grammar": 10, "readability": 5, "logic": 10}

# Words and patterns of good and bad descriptions in Korean -------------------------------------------
KOREAN = Profile(
    best_ending=r"사업이[에예]요\.\z",
    good_ending=r"(이에요|해요|드려요|어요)\.\z",
    bureaucratic=("공고합니다", "공고해요", "다음과 같이", "아래와 같이", "하오니", "바랍니다", "도모", "제고", "～", "신청하여", "참여 바", "모집합니다"),
    refusal=(
        "붙여주시면", "다듬어드리", "바꿔드리", "포함되지 않", "보이지 않", "빠져 있", "원문을", "작성해 드리", "말씀해 주", "제공해 주시", "알려주시면",
        "제공할 수 없", "죄송", "정보가 부족",
    ),
    motive=(
        "어려움", "어려운", "부담", "버거운", "빠듯한", "막막한", "막막해", "힘든", "힘들", "줄어", "위축", "침체", "피해", "여파", "부족", "걱정", "고민",
        "지친", "끊기", "끊긴", "흔들", "쉽지 않", "벅찬", "벅차", "더디", "막혀", "막막", "활력", "활성화", "키우", "키울", "넓히", "늘려", "늘리", "살리",
        "살려", "높이", "더하", "다지", "다질", "발판", "기회", "도약", "성장 기반", "경쟁력", "안착", "튼튼", "북적", "이어가", "발돋움",
    ),
    help=(
        "돕는", "도와", "마련하도록", "이어가도록", "이어갈", "시작하도록", "넘어", "넘도록", "일어서", "회복", "성장하도록", "키우", "키울", "찾도록", "만나", "지키",
        "덜어", "덜고", "낮춰", "풀고", "풀어", "북적", "안정", "넓히", "늘려", "살리", "높이", "다지", "더하", "이어", "만들", "갖추",
    ),
    target=(
        "소상공인", "소공인", "자영업", "기업", "창업자", "예비창업", "창업기업", "농가", "축산농가", "상인", "사장님", "스타트업", "벤처", "중소기업", "유통업",
        "제조업", "식품", "업소", "점포", "가게", "여행사", "관광객", "사업장", "사업자", "지역", "마을", "상권", "공방", "여행업", "농어업", "축산", "어가",
        "단체", "방문객", "근로자", "고용",
    ),
    money_or_law=r"「[^」]+」|\d+\s*(?:만원|억원|백만원)|제\d+조",
    synonyms=(("성장", "발전", "도약"), ("활성화", "활력"), ("넓히", "늘려", "확대")),
    grammar=(),
    unreadable=(),
    illogical=(),
    counted=(
        ("grammar", "을 을|를 를|이 가|은 는|에 에", 1), ("grammar", "하는는|이에요요|도록록|에요에요|사업사업", 1), ("grammar", "(?s)위해.*위해|위한.*위한", 1),
        ("grammar", r"[을를의에과와로고][. ]*\z", 1), ("grammar", r"  |··|\A[·,.]", 1), ("readability", "·", 3),
        ("readability", r"[가-힣](?:하는|되는|있는|없는|드는)\s", 3), ("readability", ",", 3),
    ),
    needed=(
        ("logic", r"위해|위한|도록|수\s*있|하려|하고자|돕|지원|마련|연결|찾|키우|덜어|낮춰|높이|지키|넓히|늘려|살리|만들|이어|다지|누리|하는"),
    ),
    repeated=("([가-힣]{2,})(?:을|를|이|가|은|는|에|의|로)", ("사업", "기업")),
    stripped=True,
)
# -------------------------------------------------------------------------------------------------------------------
ENGLISH = Profile(
    best_ending=r"(ing|ed|ly)\.\z",
    good_ending=r"[a-z]\.\z",
    bureaucratic=("whereby", "pursuant", "therein"),
    refusal=("cannot provide", "as an AI"),
    motive=("need", "hope", "chance", "thin"),
    help=("help", "support", "with", "for"),
    target=("people", "business", "the ", "user"),
    money_or_law=r"[$€]\s?\d|\d+\s?%",
    synonyms=(("of", "from"), ("be", "is", "are")),
    grammar=(r"  ", r"\.\.", r",,"),
    unreadable=(r"[^ ]{25}",),
    illogical=(r"[A-Z]{12}",),
)


def any_pattern(text: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.rlike(text, F.lit(p))
    return out


def redundant(text: Column, groups: tuple[tuple[str, ...], ...]) -> Column:
    """Whether two words of one synonym group occur."""
    out = F.lit(False)
    for g in groups:
        out = out | (sum((F.contains(text, F.lit(w)).cast("int") for w in g), F.lit(0)) >= 2)
    return out


def broken(text: Column, p: Profile) -> list[tuple[str, Column]]:
    """(kind, condition) of each issue: redundancy, grammar, readability, logic."""
    found = [("redundancy", redundant(text, p.synonyms))]
    if p.repeated:
        pattern, free = p.repeated
        words = F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda w: ~w.isin(*free))
        found.append(("redundancy", F.size(F.array_distinct(words)) < F.size(words)))
    for kind, patterns in (("grammar", p.grammar), ("readability", p.unreadable), ("logic", p.illogical)):
        if patterns:
            found.append((kind, any_pattern(text, patterns)))
        for k, pattern, least in p.counted:
            if k == kind:
                found.append((kind, F.rlike(text, F.lit(pattern)) if least == 1 else F.regexp_count(text, F.lit(pattern)) >= least))
        found += [(kind, ~F.rlike(text, F.lit(pattern))) for k, pattern in p.needed if k == kind]
    return found


def plain(text: Column, p: Profile) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "") if p.stripped else text


def issues(text: Column, p: Profile) -> Column:
    """Kinds of what is wrong, in a fixed order, a kind once for each of its issues."""
    return F.array_compact(F.array(*[F.when(c, kind) for kind, c in broken(plain(text, p), p)]))


def score(text: Column, p: Profile) -> Column:
    """0 to 100: form 40, content 40, tone 20, less penalties; a refusal, a null and an empty text score 0."""
    nothing, text = F.coalesce(text, F.lit("")) == "", plain(text, p)
    n = F.char_length(text)
    points = lambda c, k: F.when(c, k).otherwise(0)
    motive, helps = contains_any(text, list(p.motive)), contains_any(text, list(p.help))
    one = (F.char_length(F.regexp_replace(text, r"[^.]+", "")) == 1) & ~F.contains(text, F.lit("\n"))
    total = (
        F.when(F.rlike(text, F.lit(p.best_ending)), 15).when(F.rlike(text, F.lit(p.good_ending)), 10).otherwise(0)
        + F.when(n.between(45, 100), 10).when(n.between(35, 110), 6).otherwise(0)
        + points(one, 5)
        + points(~contains_any(text, list(p.bureaucratic)), 10)
        + points(motive, 15)
        + points(helps, 15)
        + points(contains_any(text, list(p.target)), 10)
        + points(motive & helps, 10)
        + points(~F.rlike(text, F.lit(p.money_or_law)), 10)
    )
    for kind, wrong in broken(text, p):
        total = total - points(wrong, PENALTIES[kind])
    return F.when(nothing | contains_any(text, list(p.refusal)), 0).otherwise(F.greatest(total, F.lit(0))).cast("int")


def grade(value: Column) -> Column:
    return F.when(value >= 85, "A").when(value >= 70, "B").when(value >= 50, "C").otherwise("D")
