"""Requests in plain words: what they ask for, where, and how to answer them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import cascade, hits, plain
from ..functions.text import contains_any


@dataclass(frozen=True)
class Aliases:
    """Names that stand for a standard one in a group: (alias, standard, group)."""

    rows: tuple[tuple[str, str, str], ...]

    def longest_first(self) -> list[tuple[str, str, str]]:
        return sorted(self.rows, key=lambda r: (-len(r[0]), r[0]))


def bare_aliases(names: list[tuple[str, str]], endings: str = "구시군", taken: frozenset[str] = frozenset()) -> Aliases:
    """Regions by name, and by the name without its last syllable where that is long enough and means one region only."""
    short: dict[str, list[tuple[str, str]]] = {}
    for name, group in names:
        if name and name[-1] in endings and len(name) > 2:
            short.setdefault(name[:-1], []).append((name, group))
    full = {n for n, _ in names}
    extra = [(b, *rs[0]) for b, rs in short.items() if len(rs) == 1 and b not in full and b not in taken]
    return Aliases(tuple([(n, n, g) for n, g in names] + extra))


def resolve(text: Column, aliases: Aliases) -> Column:
    """(alias, standard, group) of the longest alias in the text, or null."""
    out = None
    for a, s, g in aliases.longest_first():
        pick = F.struct(F.lit(a).alias("alias"), F.lit(s).alias("standard"), F.lit(g).alias("group"))
        hit = F.contains(plain(text), F.lit(a))
        out = F.when(hit, pick) if out is None else out.when(hit, pick)
    return out


def first_group(text: Column, groups: dict[str, list[str]]) -> Column:
    """The first group with a keyword in the text, or null."""
    return cascade([(contains_any(text, words), name) for name, words in groups.items()], None)


def region_mode(region: Column, nation_wide: Column, only_there: Column) -> Column:
    """How regions count: only nation-wide offers, none asked for, strictly there, or there first."""
    return cascade(
        [(nation_wide & region.isNull(), "national_only"), (region.isNull(), "none"), (only_there, "strict")], "region_first"
    )


@dataclass(frozen=True)
class Profile:
    goals: dict[str, list[str]]
    stages: dict[str, list[str]]
    regions: Aliases
    nation_wide: tuple[str, ...]
    only_there: tuple[str, ...]
    routes: tuple[tuple[str, str], ...]


def parse(requests: DataFrame, text: str, p: Profile) -> DataFrame:
    """Requests with goal, goals, stage, region, region_group, mode and route."""
    t = F.col(text)
    place = resolve(t, p.regions)
    out = requests.withColumn("_place", place)
    wide, there = contains_any(t, list(p.nation_wide)), contains_any(t, list(p.only_there))
    return (
        out.withColumn("goal", first_group(t, p.goals))
        .withColumn("goals", hits(plain(t), p.goals))
        .withColumn("stage", first_group(t, p.stages))
        .withColumn("region", F.col("_place.standard"))
        .withColumn("region_group", F.col("_place.group"))
        .withColumn("mode", region_mode(F.col("_place.standard"), wide, there))
        .withColumn("route", route(t, p.routes))
        .drop("_place")
    )


def route(text: Column, routes: tuple[tuple[str, str], ...]) -> Column:
    """Which follow-up a text asks for: the first pattern that fits, else a summary."""
    return cascade([(F.rlike(plain(text), F.lit(pattern)), name) for pattern, name in routes], "summary")


#: Fixed value: how people ask to see policies at once.
LOOKUP = (
    r"관련\s*(정책|공고|지원|사업)|지원\s*(정책|공고|사업)|(정책|공고)\s*(알려|추천|찾아|뭐|전체)|뭐\s*(있|있어|있나)|알려줘|추천해줘|찾아줘|전체\s*알려"
)


def goes_to_results(text: Column, *slots: Column) -> Column:
    """Whether a request asks for a list and has at least one usable condition (not null, not empty): it needs no dialogue."""
    usable = F.coalesce(*[F.nullif(s, F.lit("")) for s in slots]).isNotNull()
    return F.rlike(F.coalesce(text, F.lit("")), F.lit(LOOKUP)) & usable


def excluded(limited_to: Column, named: Column) -> Column:
    """Whether an offer limited to groups of people meets a request that names none of them."""
    return (F.size(limited_to) > 0) & ~F.arrays_overlap(limited_to, named)


def lifecycle_excluded(operating: Column, stages: Column, goals: Column, wants_start: Column) -> Column:
    """Whether an offer for starting up meets a running business that asks for nothing of the kind."""
    only_before = (F.size(stages) == 1) & F.array_contains(stages, "pre")
    return operating & ~wants_start & (only_before | F.array_contains(goals, "startup"))


# Regions by name, and a town that bears a city's name -----------------------------------------------
PLACES = {
    "seoul": ("서울",), "incheon": ("인천",), "gyeonggi": ("경기",), "busan": ("부산",), "daegu": ("대구",), "daejeon": ("대전",), "gwangju": ("광주",),
    "ulsan": ("울산",), "sejong": ("세종",), "gangwon": ("강원",), "chungbuk": ("충북", "충청북도"), "chungnam": ("충남", "충청남도"), "jeonbuk": ("전북",),
    "jeonnam": ("전남", "전라남도"), "gyeongbuk": ("경북", "경상북도"), "gyeongnam": ("경남", "경상남도"), "jeju": ("제주",),
}
#: region: (the town of that name in another region, the region itself beyond doubt).
HOMONYMS = {"gwangju": (r"경기도?\s*광주|경기도?.{0,12}광주시|\[경기\].{0,20}광주", r"광주광역시|\[광주\]")}
# -------------------------------------------------------------------------------------------------------------------


def places(text: Column) -> Column:
    """The regions that a text names, in their order; a town that only bears a region's name is none. Null names nothing."""
    text, found = F.coalesce(text, F.lit("")), []
    for region, names in PLACES.items():
        hit = contains_any(text, list(names))
        if region in HOMONYMS:
            town, itself = HOMONYMS[region]
            hit = hit & (~F.rlike(text, F.lit(town)) | F.rlike(text, F.lit(itself)))
        found.append(F.when(hit, region))
    return F.array_compact(F.array(*found))


def region_compatible(places: Column, asked: Column) -> Column:
    return (F.size(places) == 0) | F.arrays_overlap(places, asked)


def explain(goal: Column, stage: Column, region: Column, mode: Column) -> Column:
    """What was understood, in one sentence."""
    return F.concat_ws(
        ", ",
        F.when(goal.isNotNull(), F.concat(F.lit("for "), goal)),
        F.when(stage.isNotNull(), F.concat(F.lit("at stage "), stage)),
        F.when(region.isNotNull(), F.concat(F.lit("in "), region)),
        F.concat(F.lit("mode "), mode),
    )
