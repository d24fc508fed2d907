r"""Chat formatting from reply trees.

Messages name their parent. Pointer doubling gives every message its root, its depth and the summed score of the path
above it: a self-join for each power of two, so a path of n messages takes log2(n) joins. Leaves are ranked by score
within their conversation; the best ``branches`` are kept. Their root-to-leaf paths are then enumerated by self-joins
through the same jump tables, from the largest jump down: each round adds, for every message found so far, the one
2^k above it. So a path costs as many rows as it has messages. Each path is formatted as one conversation.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` a turn. In texts and roles a backslash becomes two and ``<|``
becomes ``<\|``, so no control string can arise inside them, and removing one backslash before any character undoes it.
The loss mask is a list of runs (characters, in loss) over the whole string; assistant texts are in loss.

Defined cases: a null text or role is empty; rows of one turn stand by role, then text; messages whose parent is
missing are roots; messages on a cycle, and those that reply into one, have no root and are left out, as are messages
without an id; of rows with one id the first by parent, role, text and score counts; an empty table gives no rows; a null
conversation id is a conversation of its own. Other columns of the input are not part of a conversation and are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, let, table, written

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chain(conversations: DataFrame) -> DataFrame:
    """Rows by turn as messages (conv, msg, parent, role, text, score), each replying to the one before it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    in_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    return conversations.select(
        F.col("conv_id").alias("conv"),
        F.row_number().over(in_turn).cast("long").alias("msg"),
        role.alias("role"),
        text.alias("text"),
        F.lit(0.0).alias("score"),
    ).withColumn("parent", F.when(F.col("msg") > 1, F.col("msg") - 1))


def same(a: DataFrame, b: DataFrame, x: str, y: str) -> Column:
    return a["conv"].eqNullSafe(b["conv"]) & (a[x] == b[y])


def jumps(messages: DataFrame, scratch: Scratch | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(conv, msg, depth, total, is_root_found) and the tables (conv, msg, up) of the jumps of 1, 2, 4, ... messages."""
    scratch = scratch or Scratch(messages.sparkSession)
    ids = messages.select("conv", "msg", "parent", "score")
    known = ids.select(F.col("conv").alias("kc"), F.col("msg").alias("km"))
    linked = ids.join(known, ids["conv"].eqNullSafe(known["kc"]) & (ids["parent"] == known["km"]), "left")
    state = scratch.keep(
        linked.select(
            "conv",
            "msg",
            F.col("km").alias("up"),
            F.when(F.col("km").isNull(), 0).otherwise(1).cast("long").alias("depth"),
            F.coalesce("score", F.lit(0.0)).alias("total"),
        ),
        "jumps",
    )
    levels = []
    # A path is no longer than its conversation: what has found no root after so many doublings is on a cycle or leads into one.
    longest = ids.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range((longest - 1).bit_length()):
        level = state.where(F.col("up").isNotNull())
        if level.isEmpty():
            break
        levels.append(level.select("conv", "msg", "up"))
        # What the message 2^k above has gathered on its own stretch is added; then the jump doubles. Messages whose
        # stretch has come to the root only serve as such; they are not joined again.
        above = state.select(
            F.col("conv").alias("ac"), F.col("msg").alias("am"), F.col("up").alias("aup"),
            F.col("depth").alias("adepth"), F.col("total").alias("atotal"),
        )
        joined = level.join(above, level["conv"].eqNullSafe(above["ac"]) & (level["up"] == above["am"]))
        longer = joined.select(
            "conv",
            "msg",
            F.col("aup").alias("up"),
            (F.col("depth") + F.col("adepth")).alias("depth"),
            (F.col("total") + F.col("atotal")).alias("total"),
        )
        state = scratch.keep(state.where(F.col("up").isNull()).unionByName(longer), "jumps")
    return state.where(F.col("up").isNull()).select("conv", "msg", "depth", "total"), levels


def paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(conv, leaf, rank, msg, depth) for every message on the chosen root-to-leaf paths."""
    with Scratch(messages.sparkSession) as scratch:
        placed, levels = jumps(messages, scratch)
        parents = messages.where(F.col("parent").isNotNull()).select(F.col("conv").alias("pc"), F.col("parent").alias("pm")).distinct()
        leaves = placed.join(parents, placed["conv"].eqNullSafe(parents["pc"]) & (placed["msg"] == parents["pm"]), "left_anti")
        best = Window.partitionBy("conv").orderBy((F.col("total") / (F.col("depth") + 1)).desc(), F.col("depth").desc(), "msg")
        ranked = leaves.withColumn("rank", F.row_number().over(best))
        if branches is not None:
            ranked = ranked.where(F.col("rank") <= branches)
        found = ranked.select("conv", F.col("msg").alias("leaf"), "rank", "msg", "depth")
        for k in range(len(levels) - 1, -1, -1):
            jump = levels[k].select(F.col("conv").alias("jc"), F.col("msg").alias("jm"), F.col("up").alias("jup"))
            more = found.join(jump, found["conv"].eqNullSafe(jump["jc"]) & (found["msg"] == jump["jm"]))
            above = more.select("conv", "leaf", "rank", F.col("jup").alias("msg"), (F.col("depth") - (1 << k)).alias("depth"))
            before, found = found, scratch.keep(found.unionByName(above), "paths")
            scratch.let_go(before)
        return written(found, "paths")


def render(turns: DataFrame) -> DataFrame:
    """(conv, leaf, rank, depth, role, text) -> one formatted conversation a path, with its loss mask."""
    listed = F.array_sort(F.collect_list(F.struct("depth", "role", "text")))
    header = lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP))

    def runs(t: Column) -> Column:
        run = lambda n, loss: F.struct(n.alias("chars"), loss.alias("loss"))
        return F.array(
            run(F.char_length(header(t)), F.lit(False)),
            run(F.char_length(escape(t["text"])), t["role"] == "assistant"),
            run(F.lit(len(END)), F.lit(False)),
        )

    return turns.groupBy("conv", "leaf", "rank").agg(listed.alias("turns")).select(
        "conv",
        "leaf",
        "rank",
        F.array_join(F.transform("turns", lambda t: F.concat(header(t), escape(t["text"]), F.lit(END))), "").alias("formatted"),
        F.flatten(F.transform("turns", runs)).alias("mask"),
    )


def distinct_messages(messages: DataFrame) -> DataFrame:
    """One row for each message, whatever comes twice."""
    rest = ("parent", "role", "text", "score")
    one = messages.where(F.col("msg").isNotNull()).groupBy("conv", "msg").agg(F.min(F.struct(*rest)).alias("m"))
    return one.select("conv", "msg", *[F.col(f"m.{c}").alias(c) for c in rest])


def format_trees(messages: DataFrame, branches: int | None = 1, keyed: bool = False) -> DataFrame:
    """Messages (conv, msg, parent, role, text, score) -> (conv, leaf, rank, formatted, mask).

    keyed: whether (conv, msg) is known to name one row.
    """
    if not keyed:
        messages = written(distinct_messages(messages), "messages")
    chosen = paths(messages, branches)
    texts = messages.select(
        F.col("conv").alias("tc"), F.col("msg").alias("tm"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return render(chosen.join(texts, chosen["conv"].eqNullSafe(texts["tc"]) & (chosen["msg"] == texts["tm"])))


def read_back(formatted: Column, mask: Column) -> Column:
    """turns (role, text), and loss_text: what the mask covers; raises where mask and string disagree."""
    turns = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda raw, i: i > 0)

    def turn(raw: Column, i: Column) -> Column:
        body = lambda s: F.substring_index(F.element_at(s, 2), END, 1)
        cover = F.get(mask, i * 3 + 1)
        return let(
            F.split(raw, r"<\|im_sep\|>"),
            lambda s: F.struct(
                unescape(F.element_at(s, 1)).alias("role"),
                F.when(F.char_length(body(s)) == cover["chars"], unescape(body(s)))
                .otherwise(F.raise_error(F.lit("loss mask and text disagree")))
                .alias("text"),
                cover["loss"].alias("loss"),
            ),
        )

    return F.transform(turns, turn)


#: A conversation that says the control strings of a template.
PROBE = r"</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    out = format_trees(written(chain(rows.unionByName(probe)), "messages"), keyed=True)
    read = out.withColumn("turns", read_back(F.col("formatted"), F.col("mask")))
    text = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
           + length('<|im_start|><|im_sep|><|im_end|>'))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
