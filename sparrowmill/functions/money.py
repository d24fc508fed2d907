"""Amounts of money in labels, for a table of units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Korean units of money, longest names first.
WON = {"천만": 10_000_000, "백만": 1_000_000, "천억": 100_000_000_000, "조": 1_000_000_000_000, "억": 100_000_000, "만": 10_000, "천": 1_000}
#: Order in which a compound label is read.
COMPOUND = ("조", "천억", "억", "천만", "백만", "만", "천")


def first_value(label: Column, units: dict[str, int] = WON) -> Column:
    """Value of the first number with a unit, or null."""
    names = "|".join(sorted(units, key=lambda u: -len(u)))
    plain = F.replace(label, F.lit(","), F.lit(""))
    pattern = rf"(\d+(?:\.\d+)?)\s*({names})"
    number = F.nullif(F.regexp_extract(plain, pattern, 1), F.lit(""))
    unit = F.regexp_extract(plain, pattern, 2)
    factor = F.element_at(F.create_map(*[F.lit(x) for kv in units.items() for x in kv]), unit)
    return F.round(number.cast("double") * factor).cast("long")


def compound_value(label: Column, units: dict[str, int] = WON, order: tuple[str, ...] = COMPOUND) -> Column:
    """Sum of the label's parts, each unit read once and taken out before the next; null without any."""
    rest = F.replace(label, F.lit(","), F.lit(""))
    total, any_part = F.lit(0).cast("long"), F.lit(False)
    for unit in order:
        pattern = rf"(\d+(?:\.\d+)?)\s*{unit}"
        number = F.nullif(F.regexp_extract(rest, pattern, 1), F.lit(""))
        total = total + F.coalesce(F.round(number.cast("double") * units[unit]).cast("long"), F.lit(0))
        any_part = any_part | number.isNotNull()
        rest = F.regexp_replace(rest, pattern, " ")
    return F.when(any_part, total)


def largest_value(label: Column, units: dict[str, int] = WON, bare: int = 7) -> Column:
    """The greatest value among all numbers with a unit, and among bare numbers of so many digits; null without any."""
    names = "|".join(sorted(units, key=lambda u: -len(u)))
    plain = F.replace(label, F.lit(","), F.lit(""))
    tokens = F.regexp_extract_all(plain, F.lit(rf"(\d+(?:\.\d+)?\s*(?:{names}))"), F.lit(1))
    amounts = F.transform(tokens, lambda t: first_value(t, units))
    long = F.transform(F.regexp_extract_all(plain, F.lit(rf"(\d{{{bare},15}})"), F.lit(1)), lambda t: t.cast("long"))
    return F.array_max(F.concat(amounts, long))


def won_label(value: Column) -> Column:
    """A value in hundreds of millions and ten-thousands, as people write it."""
    high, low = F.floor(value / 100_000_000), F.floor((value % 100_000_000) / 10_000)
    text = F.concat_ws(
        " ",
        F.when(high > 0, F.concat(F.format_number(high, 0), F.lit("억"))),
        F.when(low > 0, F.concat(F.format_number(low, 0), F.lit("만"))),
    )
    return F.when(value >= 10_000, F.concat(text, F.lit("원"))).when(value.isNotNull(), F.concat(value.cast("string"), F.lit("원")))


def provenance(explicit: Column, total: Column, count: Column, most: int = 5_000_000_000) -> Column:
    """Per-applicant value and how it is known: stated, calculated from total and count, total only, or none."""
    each = F.floor(total / count)
    calculated = total.isNotNull() & (count > 0) & (each < most)
    return F.struct(
        F.when(explicit.isNotNull(), explicit).when(calculated, each).cast("long").alias("value"),
        F.when(explicit.isNotNull(), "explicit").when(calculated, "calculated").when(total.isNotNull(), "total_only").otherwise("none").alias("source"),
    )
