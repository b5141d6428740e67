"""Chat formatting by quotation linking.

Each message is split into its own body and its quoted lines (leading ``>`` marks, nested levels;
a line announcing a quote, "... wrote:", goes with it). Quoted lines, runs of quoted lines, all lines of
one level together and the sentences in them are normalised and hashed, whatever their length, and joined to
the earliest message of the conversation that said them (as a line, a sentence or its whole body). A message replies to the message it quotes at the lowest level (most quoted characters,
then the latest turn); without a link it replies to the turn before it. Conversations come out in
reply order (depth in the reply tree, then turn), without quotes, one row per message, so a
conversation of any length is never held in one task.

DataFrame functions only. Null text: empty body. Null conv_id: one conversation of its own; null
turn: before all others. Messages with equal conv_id and turn share their place in the tree, all are
returned (their quotes are pooled). A passage can only link to an earlier turn, so there are no cycles.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, let, positions, stage

ANNOUNCES = r"(?i)^(on|am|le|el)\b.{0,200}\b(wrote|schrieb|a écrit|escribió)\s?:$"
_MARKS = r"^[\x20\t]*+(?:>[\x20\t]*+)*+"
ENDS = "[.!?\u2026\u3002\uff01\uff1f]+"       # of sentences
MAX_ROUNDS = 64


def normalised(line: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def parsed_lines(text: Column) -> Column:
    """array<struct<level, line>> of a message; level 0 is the message's own text."""
    def one(raw: Column) -> Column:
        return let(F.regexp_extract(raw, _MARKS, 0), lambda marks: F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.when(marks.contains(">"), F.substring(raw, F.length(marks) + 1, F.length(raw))).otherwise(raw).alias("line")))
    return let(F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), one), lambda all_: F.filter(all_, lambda x, i: ~(
        (x["level"] == 0) & F.trim(x["line"]).rlike(ANNOUNCES) & F.coalesce(F.get(all_, i + 1)["level"] > 0, F.lit(False)))))


def _passages(lines: Column) -> Column:
    """array<struct<level, s>>: what may be quoted (level 0) or is quoted. Single lines, all lines of one level
    together, each run of successive quoted lines, and the sentences of these texts, so that a passage is
    found however it was wrapped."""
    text = lambda some: F.array_join(F.transform(some, lambda x: x["line"]), " ")
    made = lambda level, s: F.struct(level.alias("level"), s.alias("s"))

    def runs(all_: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(all_) - 1), lambda i: (i == 0) | (F.get(all_, i)["level"] != F.get(all_, i - 1)["level"]))
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(all_)))
        return let(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda z: F.filter(F.transform(z, lambda r: made(
            F.get(all_, r["a"])["level"], text(F.slice(all_, r["a"] + 1, r["b"] - r["a"])))), lambda r: r["level"] > 0))

    def levels(all_: Column) -> Column:
        return F.transform(F.array_distinct(F.transform(all_, lambda x: x["level"])), lambda v: made(v, text(F.filter(all_, lambda x: x["level"] == v))))

    def sentences(texts: Column) -> Column:
        return F.flatten(F.transform(texts, lambda t: F.transform(F.split(t["s"], ENDS), lambda x: made(t["level"], x))))
    single = lambda all_: F.transform(all_, lambda x: made(x["level"], x["line"]))
    return let(lines, lambda all_: let(F.concat(levels(all_), runs(all_)), lambda texts: F.concat(single(all_), texts, sentences(texts))))


def _keys(lines: Column) -> Column:
    """array<struct<level, key, chars>> of a message's passages, normalised; each once."""
    plain = F.transform(_passages(lines), lambda x: F.struct(x["level"].alias("level"), normalised(x["s"]).alias("s")))
    plain = F.array_distinct(F.filter(plain, lambda x: x["s"] != ""))
    return F.transform(plain, lambda x: F.struct(x["level"].alias("level"), F.xxhash64(x["s"]).alias("key"), F.length(x["s"]).alias("chars")))


def _numbered(slots: DataFrame, order: list[str], name: str, kind: str, spent: list[str]) -> DataFrame:
    """Gapless positions of the slots inside their conversation. The slots are range-partitioned,
    so a long conversation spans many tasks."""
    dealt = stage(slots.repartitionByRange(slots.sparkSession.sparkContext.defaultParallelism * 2, "conv", *order)
                  .withColumn("__part", F.spark_partition_id()), f"chat-{kind}", spent)
    return positions(dealt, ["conv"], ["__part"], [F.col(c) for c in order], name).drop("__part")


def reply_links(lines: DataFrame) -> DataFrame:
    """(conv, slot, to_slot): for each quoting slot the slot it answers. ``lines``: conv, slot, lines."""
    keyed = lines.select("conv", "slot", F.explode(_keys(F.col("lines"))).alias("k")).select("conv", "slot", "k.*")
    said = keyed.filter("level = 0").groupBy("conv", "key").agg(F.min("slot").alias("to_slot"))
    quoted = keyed.filter("level > 0")
    links = (quoted.join(said, ["conv", "key"]).filter("to_slot < slot")
             .groupBy("conv", "slot", "level", "to_slot").agg(F.sum("chars").alias("chars")))
    return links.groupBy("conv", "slot").agg(F.max_by("to_slot", F.struct(-F.col("level"), F.col("chars"), F.col("to_slot"))).alias("to_slot"))


def _depths(tree: DataFrame, spent: list[str]) -> DataFrame:
    """Depth of each (conv, n) in a forest of parent pointers, by doubling: every round each node
    jumps to its ancestor's ancestor, so the rounds grow with the logarithm of the longest chain."""
    state = stage(tree.select("conv", "n", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")), "chat-up", spent)
    for _ in range(MAX_ROUNDS):
        if not state.filter("up IS NOT NULL").limit(1).count():
            return state.select("conv", "n", "depth")
        above = state.select("conv", F.col("n").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"))
        state = stage(state.join(above, ["conv", "up"], "left")
                      .select("conv", "n", F.col("__up").alias("up"), (F.col("depth") + F.coalesce("__depth", F.lit(0))).alias("depth")), "chat-up", spent)
    raise RuntimeError("a reply chain is longer than 2**64 messages")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) with body, parent_turn, depth, position, by_quote,
    n_quoted_lines and the formatted chat turn; other columns are not carried."""
    spent: list[str] = []
    conv = F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    slot = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63)).cast("long"))
    lines = parsed_lines(F.col("text"))
    parsed = stage(messages.select("conv_id", "turn", "role", conv.alias("conv"), slot.alias("slot"), lines.alias("lines")), "chat-lines")
    slots = _numbered(parsed.select("conv", "slot").distinct(), ["slot"], "n", "slots", spent)
    links = stage(reply_links(parsed), "chat-links", spent)
    slots = stage(slots.join(links, ["conv", "slot"], "left"), "chat-numbered", spent)
    at = slots.select("conv", F.col("slot").alias("to_slot"), F.col("n").alias("to_n"))
    tree = slots.join(at, ["conv", "to_slot"], "left").withColumn(
        "parent", F.when(F.col("to_n").isNotNull(), F.col("to_n")).when(F.col("n") > 0, F.col("n") - 1))
    tree = stage(tree.select("conv", "slot", "n", "parent", F.col("to_n").isNotNull().alias("by_quote")), "chat-tree", spent)
    # without any link a conversation is one chain: its depths are known, only the others are walked
    branched = tree.filter("by_quote").select("conv").distinct()
    walked = _depths(tree.join(branched, "conv", "left_semi"), spent)
    tree = tree.join(walked, ["conv", "n"], "left").withColumn("depth", F.coalesce("depth", F.col("n")))
    placed = _numbered(tree, ["depth", "slot"], "position", "order", spent)
    above = slots.select("conv", F.col("n").alias("parent"), F.col("slot").alias("p_slot"))
    placed = stage(placed.join(above, ["conv", "parent"], "left")
                   .select("conv", "slot", F.nullif("p_slot", F.lit(-(2**63)).cast("long")).alias("parent_turn"), "depth", "position", "by_quote"), "chat-placed")
    drop_stages(messages.sparkSession, spent)
    body = F.trim(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n"))
    return (parsed.join(placed, ["conv", "slot"])
            .select("conv_id", "turn", "role", "parent_turn", F.col("depth").cast("long").alias("depth"), "position", "by_quote",
                    F.size(F.filter("lines", lambda x: x["level"] > 0)).alias("n_quoted_lines"), F.btrim(body, F.lit(" \n\t\r")).alias("body"))
            .withColumn("formatted", F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("body"), F.lit("\n"))))
