"""Groups of records by five keys, nested: publications, repeated contents, families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical
from .similarity import components, cut

KINDS = ("publication", "content", "family")


def keyed(records: DataFrame, ident: str, fields: dict[str, Column], structure: Column | None = None) -> DataFrame:
    """(ident, strict, substance, regional, stem, summary): digests of the five keys, null where a key is too short.

    fields: title, summary, period (texts), region, institution, executor, category, subcategory (as they are);
    structure: what the substance digest is of, a struct of any nesting.
    """
    texts = ("title", "summary", "period")
    plain = {n: fields[n].cast("string") for n in ("region", "institution", "executor", "category", "subcategory")}
    taken = {**{n: fields[n] for n in texts}, **plain}
    rows = records.select(ident, *[c.alias(n) for n, c in taken.items()], *([structure.alias("structure")] if structure is not None else []))
    # The draft is a column, so that it is made once for all that look at it, and the structure goes no further.
    drafted = canonical.draft(F.col("structure"), rows.schema["structure"].dataType) if structure is not None else F.lit(None).cast("string")
    rows = rows.select(ident, *taken, drafted.alias("draft"))
    rows = rows.withColumns({n: canonical.normal(F.col(n)) for n in texts})
    short, title = canonical.letters(F.col("summary")), canonical.letters(F.col("title"))
    stem = canonical.title_stem(F.col("title"))
    rows = rows.withColumns({"short": short, "head": title, "stem": stem})
    place = [F.col("region"), F.col("institution"), F.col("executor")]
    # Parts of a key are told apart from their neighbours, and null from empty.
    key = lambda *parts: F.sha1(F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), p), F.lit("-")) for p in parts])))
    substance = F.sha1(canonical.settled(F.col("draft"))) if structure is not None else F.lit(None).cast("string")
    return rows.select(
        ident,
        key(F.col("head"), *place, F.col("short"), F.col("period")).alias("strict"),
        substance.alias("substance"),
        F.when(F.char_length("short") >= 40, key(F.col("short"), *place, F.col("category"), F.col("subcategory"))).alias("regional"),
        F.when(F.char_length("stem") >= 8, F.sha1("stem")).alias("stem"),
        F.when(F.char_length("short") >= 80, F.sha1("short")).alias("summary"),
    )


def allocate(keys: DataFrame, ident: str) -> DataFrame:
    """(ident, publication, content, family): each the least id of its group; families hold both other kinds.

    All three groupings are found at once, as components over (kind, id): records of equal keys are linked to the least of
    them, which takes one aggregate and one join for all keys.
    """
    strict, content, family = (F.lit(k) for k in range(3))
    uses = F.array(
        F.struct(strict.alias("kind"), F.concat(F.lit("p"), "strict").alias("key")),
        F.struct(content.alias("kind"), F.concat(F.lit("c"), "substance").alias("key")),
        F.struct(content.alias("kind"), F.concat(F.lit("r"), "regional").alias("key")),
        *[F.struct(family.alias("kind"), F.concat(F.lit(p), c).alias("key")) for p, c in (("p", "strict"), ("c", "substance"), ("r", "regional"), ("f", "stem"), ("s", "summary"))],
    )
    used = cut(keys.select(F.col(ident).alias("a"), F.explode(uses).alias("u")).select("a", "u.kind", "u.key").where(F.col("key").isNotNull()))
    least = used.groupBy("kind", "key").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = used.join(least, ["kind", "key"]).where("a <> b")
    node = lambda c: F.struct("kind", F.col(c).alias("id"))
    edges = edges.select(node("a").alias("a"), node("b").alias("b")).distinct()
    nodes = keys.select(ident, F.explode(F.array(strict, content, family)).alias("kind"))
    nodes = nodes.select(F.struct("kind", F.col(ident).alias("id")).alias("node"))
    found = components(nodes, edges, "node").select("node.kind", F.col("node.id").alias(ident), F.col("component.id").alias("group"))
    return found.groupBy(ident).agg(*[F.max(F.when(F.col("kind") == k, F.col("group"))).alias(n) for k, n in enumerate(KINDS)])
