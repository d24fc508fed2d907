"""Rules as SQL expressions, written once for the engine and for the database that checks it."""

from __future__ import annotations


class Spark:
    """How Spark spells what the two say differently."""

    def text(self, x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def rx(self, x: str, pattern: str) -> str:
        return f"regexp_like({x}, {self.text(pattern)})"

    def swap(self, x: str, pattern: str, to: str = "") -> str:
        return f"regexp_replace({x}, {self.text(pattern)}, {self.text(to)})"

    def group(self, x: str, pattern: str, n: int = 1) -> str:
        return f"regexp_extract({x}, {self.text(pattern)}, {n})"

    def every(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, {self.text(f'({pattern})')}, 1)"

    def between(self, x: str, pattern: str) -> str:
        return f"split({x}, {self.text(pattern)})"

    def split(self, x: str, sep: str) -> str:
        return f"split({x}, {self.text(sep)})"

    def div(self, a: str, b: object) -> str:
        return f"({a} div {b})"

    def commas(self, x: str) -> str:
        return f"format_number({x}, 0)"

    def code(self, x: str) -> str:
        return f"ascii({x})"

    def keep(self, xs: str, v: str, condition: str) -> str:
        return f"filter({xs}, {v} -> {condition})"

    def each(self, xs: str, v: str, to: str, i: str = "i") -> str:
        """``i`` counts from 1."""
        return f"transform({xs}, ({v}, {i}0) -> {to.replace(f'#{i}', f'({i}0 + 1)')})"

    def item(self, xs: str, i: str) -> str:
        return f"get({xs}, cast({i} as int) - 1)"

    def first(self, xs: str, n: int) -> str:
        return f"slice({xs}, 1, {n})"

    def part(self, xs: str, start: str, n: int) -> str:
        return f"slice({xs}, {start}, {n})"

    def unique(self, xs: str) -> str:
        return f"array_distinct({xs})"

    def size(self, xs: str) -> str:
        return f"size({xs})"

    def join(self, xs: str, sep: str) -> str:
        return f"array_join({xs}, {self.text(sep)})"

    def longest(self, xs: str) -> str:
        return f"array_max({xs})"


class Duck(Spark):
    """The same for DuckDB."""

    def text(self, x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def rx(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.text(pattern)})"

    def swap(self, x: str, pattern: str, to: str = "") -> str:
        return f"regexp_replace({x}, {self.text(pattern)}, {self.text(to.replace('$1', chr(92) + '1'))}, 'g')"

    def every(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, {self.text(pattern)})"

    def between(self, x: str, pattern: str) -> str:
        return f"regexp_split_to_array({x}, {self.text(pattern)})"

    def split(self, x: str, sep: str) -> str:
        return f"string_split({x}, {self.text(sep)})"

    def div(self, a: str, b: object) -> str:
        return f"({a} // {b})"

    def commas(self, x: str) -> str:
        return f"format('{{:,}}', {x})"

    def code(self, x: str) -> str:
        return f"unicode({x})"

    def keep(self, xs: str, v: str, condition: str) -> str:
        return f"list_filter({xs}, lambda {v}: {condition})"

    def each(self, xs: str, v: str, to: str, i: str = "i") -> str:
        return f"list_transform({xs}, lambda {v}, {i}: {to.replace(f'#{i}', i)})"

    def item(self, xs: str, i: str) -> str:
        return f"({xs})[{i}]"

    def first(self, xs: str, n: int) -> str:
        return f"({xs})[1:{n}]"

    def part(self, xs: str, start: str, n: int) -> str:
        return f"({xs})[{start}:{start} + {n - 1}]"

    def unique(self, xs: str) -> str:
        return f"list_filter({xs}, lambda u, ui: list_position({xs}, u) = ui)"

    def size(self, xs: str) -> str:
        return f"len({xs})"

    def join(self, xs: str, sep: str) -> str:
        return f"array_to_string({xs}, {self.text(sep)})"

    def longest(self, xs: str) -> str:
        return f"list_max({xs})"


def any_of(q: Spark, x: str, words) -> str:
    """Whether any of the words occurs, as a plain substring."""
    return "(" + " OR ".join(f"contains({x}, {q.text(w)})" for w in words) + ")"


def cascade(q: Spark, rules, rest: str | None) -> str:
    """The name of the first rule (condition, name) that holds."""
    out = " ".join(f"WHEN {c} THEN {q.text(n)}" for c, n in rules)
    return f"(CASE {out} ELSE {'NULL' if rest is None else q.text(rest)} END)"


def labels(q: Spark, rules) -> str:
    """The names of all rules (condition, name) that hold, joined by commas."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN {q.text(n)} END" for c, n in rules) + ")"
