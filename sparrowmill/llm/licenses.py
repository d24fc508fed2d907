r"""License scans by an exact set-similarity join of text blocks with license templates.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. A text's blocks are windows of words that start
every half a window, so each passage of up to half a window lies whole in one. Windows are BLOCK words, and for longer
templates the power of two that is at least twice their length: whole license texts are found like single lines. A block
matches a template if it holds at least ``threshold`` of the template's distinct words. All template words are put in one order, by how many
documents have them; only the first ``size - need + 1`` words of a template are indexed, where ``need`` is the overlap
to reach, and only the first ``size - least need + 1`` words of a block probe the index. A block with fewer words than
``need`` is dropped (length filter), and so is a pair whose words left after the shared one cannot reach ``need``
(positional filter). What is left is counted in full. Words of no template can match nothing, so blocks are reduced to
template words first; this changes no overlap.

The templates are a fixed, small list, so their index is a literal and documents are never shuffled. Base phrases are
found word by word, wherever they stand.

Defined cases: a null or empty text has no words, no labels, score 0 and null places; a text with fewer words than a
block is one block; a template of any length is found; an empty table gives no rows; repeated rows are separate rows. Other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, let, table

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The least window of words, and the share of a template's distinct words that a block must hold.
BLOCK, THRESHOLD = 128, 0.9
#: Phrases and the labels they give.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices of public licenses, in words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
    ),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl-3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license",
    ),
    (
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
        "shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
        "of contract tort or otherwise arising from out of or in connection with the software or the use or other "
        "dealings in the software",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
    ),
    (
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission this "
        "software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental "
        "special exemplary or consequential damages including but not limited to procurement of substitute goods or "
        "services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use "
        "of this software even if advised of the possibility of such damage",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
        "provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect "
        "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
        "action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this software "
        "for any purpose including commercial applications and to alter it and redistribute it freely subject to the "
        "following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote "
        "the original software if you use this software in a product an acknowledgment in the product documentation would "
        "be appreciated but is not required 2 altered source versions must be plainly marked as such and must not be "
        "misrepresented as being the original software 3 this notice may not be removed or altered from any source "
        "distribution",
    ),
]


def window(template: str, least: int = BLOCK) -> int:
    """Words of a block for a template: twice as many at least."""
    return max(least, 2 << (len(template.split()) - 1).bit_length())


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPLIT), "")


def places(w: Column, phrase: str) -> Column:
    """Where the phrase's words start, from 0."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        hit = F.lit(True)
        for k, part in enumerate(parts):
            hit = hit & (F.get(w, i + k) == part)
        return hit

    every = F.sequence(F.lit(0), F.size(w) - len(parts))
    rare = F.array_contains(w, max(parts, key=len)) & (F.size(w) >= len(parts))
    return F.when(rare, F.filter(every, here)).otherwise(F.array().cast("array<int>"))


class TemplateIndex:
    """Numbered templates of one window with their words as ranks in the global order, and the inverted index over their prefixes."""

    def __init__(self, templates: list[tuple[int, str, str]], rank: dict[str, int], threshold: float) -> None:
        self.rank, self.items = rank, []
        for number, label, t in templates:
            ranks = sorted({rank[x] for x in t.split()})
            self.items.append((number, label, ranks, math.ceil(threshold * len(ranks) - 1e-9)))
        self.least = min(need for *_, need in self.items)
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for k, (_, _, ranks, need) in enumerate(self.items):
            for j, r in enumerate(ranks[: len(ranks) - need + 1]):
                self.postings.setdefault(r, []).append((k, j))

    def vocabulary(self) -> Column:
        return F.array(*[F.lit(x) for x, r in self.rank.items() if any(r in ranks for _, _, ranks, _ in self.items)])

    def prefix(self) -> Column:
        return F.array(*[F.lit(x) for x, r in self.rank.items() if r in self.postings])

    def posting_map(self) -> Column:
        entry = lambda k, j: F.struct(F.lit(k).alias("k"), F.lit(j).alias("j"))
        pairs = [(F.lit(r), F.array(*[entry(k, j) for k, j in kj])) for r, kj in self.postings.items()]
        return F.create_map(*[x for kv in pairs for x in kv])

    def item_array(self) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(k).alias("number"), F.lit(a).alias("label"), F.array(*[F.lit(r) for r in rs]).alias("ranks"), F.lit(n).alias("need")
                )
                for k, a, rs, n in self.items
            ]
        )


def block_matches(b: Column, index: TemplateIndex, postings: Column, items: Column) -> Column:
    """Templates that a block (start, ranks ascending) holds: array of (label, template, start, overlap, containment)."""
    size = F.size(b["ranks"])
    probes = F.slice(b["ranks"], 1, F.greatest(size - index.least + 1, F.lit(0)))

    def candidates(r: Column, i: Column) -> Column:
        def may_reach(p: Column) -> Column:
            item = F.get(items, p["k"])
            left = F.least(size - i, F.size(item["ranks"]) - p["j"])
            return (size >= item["need"]) & (left >= item["need"])

        nothing = F.array().cast("array<struct<k:int,j:int>>")
        return F.transform(F.filter(F.coalesce(F.element_at(postings, r), nothing), may_reach), lambda p: p["k"])

    pairs = F.array_distinct(F.flatten(F.transform(probes, candidates)))

    def verified(k: Column) -> Column:
        item = F.get(items, k)
        overlap = F.size(F.array_intersect(b["ranks"], item["ranks"]))
        return F.struct(
            item["label"].alias("label"),
            item["number"].alias("template"),
            b["start"].alias("start"),
            overlap.alias("overlap"),
            (overlap / F.size(item["ranks"])).alias("containment"),
            item["need"].alias("need"),
        )

    return F.filter(F.transform(pairs, verified), lambda m: m["overlap"] >= m["need"])


MATCH = "array<struct<label:string,template:int,start:int,overlap:int,containment:double,need:int>>"


def scan(
    docs: DataFrame,
    *,
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """All documents with n_words, phrase_places (label, start) and template_matches (named afresh on a clash).

    block: the least window; longer templates have longer ones.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    terms = sorted({x for _, t in templates for x in t.split()})
    vocabulary = F.array(*[F.lit(x) for x in terms])
    seen = docs.select(F.explode(F.array_intersect(split_words(F.col(text_col)), vocabulary)).alias("token"))
    # One row for each template word at most.
    frequency = {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}
    rank = {x: i for i, x in enumerate(sorted(terms, key=lambda x: (frequency.get(x, 0), x)))}
    ranks = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    by_window: dict[int, list] = {}
    for k, (label, t) in enumerate(templates):
        by_window.setdefault(window(t, block), []).append((k, label, t))
    n_words, found, matches = fresh(docs, "n_words", "phrase_places", "template_matches")

    def joined(w: Column, size: int, index: TemplateIndex) -> Column:
        """Matches of the templates of one window; texts without a word of any prefix are not cut into blocks."""
        postings, items, own = index.posting_map(), index.item_array(), index.vocabulary()

        def cut_out(s: Column) -> Column:
            held = F.array_intersect(F.slice(w, s + 1, size), own)
            return F.struct(
                s.alias("start"), F.sort_array(F.transform(held, lambda x: F.element_at(ranks, x))).alias("ranks")
            )

        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(size // 2)), cut_out)
        out = F.flatten(F.transform(blocks, lambda b: block_matches(b, index, postings, items)))
        return F.when(F.arrays_overlap(w, index.prefix()), out).otherwise(F.array().cast(MATCH))

    def of(w: Column) -> Column:
        named = lambda a: lambda i: F.struct(F.lit(a).alias("label"), i.alias("start"))
        at = [F.transform(places(w, p), named(a)) for p, a in phrases.items()]
        each = [joined(w, size, TemplateIndex(own, rank, threshold)) for size, own in sorted(by_window.items())]
        return F.struct(F.size(w).cast("long").alias(n_words), F.concat(*at).alias(found), F.concat(*each).alias(matches))

    (hit,) = fresh(docs, "_scan")
    out = docs.withColumn(hit, let(split_words(F.col(text_col)), of))
    return out.select(*docs.columns, *[F.col(hit)[c].alias(c) for c in (n_words, found, matches)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    at = F.transform("phrase_places", lambda p: p["start"])
    base = F.transform("phrase_places", lambda p: p["label"])
    more = F.transform("template_matches", lambda m: m["label"])
    best = F.array_max(F.transform("template_matches", lambda m: m["containment"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrase_places").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        F.when(F.size("phrase_places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    phrases = ", ".join(f"('{p}', '{a}')" for p, a in PHRASES.items())
    templates = ", ".join(f"({window(t)}, '{a}', '{t}')" for a, t in TEMPLATES)
    windows = ", ".join(str(n) for n in sorted({window(t) for _, t in TEMPLATES}))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (SELECT string_split(col0, ' ') AS p, col1 AS label FROM (VALUES {phrases})),
pos AS (SELECT r, i, w[i + 1:i + 8] AS here FROM (SELECT r, w, unnest(range(0, len(w))) AS i FROM d)),
b AS (
  SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list(label) AS labels
  FROM pos JOIN p ON here[1:len(p)] = p GROUP BY r),
t AS (
  SELECT col0 AS size, col1 AS label, list_distinct(string_split(col2, ' ')) AS words FROM (VALUES {templates})),
blocks AS (SELECT r, size, list_distinct(w[s + 1:s + size]) AS words FROM (
  SELECT r, w, size, unnest(range(0, len(w), size // 2)) AS s FROM (SELECT r, w, unnest([{windows}]) AS size FROM d))),
m AS (
  SELECT r, list(label) AS labels, max(len(list_intersect(b.words, t.words)) / len(t.words)) AS best
  FROM blocks b JOIN t ON b.size = t.size AND len(list_intersect(b.words, t.words)) >= ceil({THRESHOLD} * len(t.words) - 1e-9) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word,
       hi::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(b.labels)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, m.labels))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""


SQL = _sql()
