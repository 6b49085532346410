"""Multi-party perspective rotation: a dialogue rendered once for each of its participants.

In a participant's rendering that speaker is the assistant, all others are named users, system turns stay
system turns, and the mask marks what the assistant says (with the end marker) as the text to learn from.

Every participant has one rendering, of all turns, with mask offsets in it. It is made of blocks of at most BLOCK
turns, nearly always one. Conversations of one block are grouped as they are, which moves each text once, and
their participants are read off the group. The turns of longer ones get their places from global prefix counts
over range partitions, and so do the characters of their blocks, so that no task holds more than a block of one
conversation, even if a third of all turns belong to it, until the blocks of one rendering are joined to its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.sharding import global_positions
from millrace.session import cut, drop, table

BLOCK = 512
#: Long conversations, and names of who takes part in them, that are broadcast at most.
BROADCAST_LONG = 100_000
COLUMNS = ("conv_id", "perspective", "block", "n_turns", "start", "text", "mask")
START, END = "<|im_start|>", "<|im_end|>"


def _clean(text: Column) -> Column:
    """Text can't forge markers: a blank breaks them up."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(role: Column) -> Column:
    return F.regexp_replace(F.coalesce(role, F.lit("unknown")), r"[^\p{L}\p{N}_.-]+", "_")


def rotate(conversations: DataFrame, system: str = "system", block: int = BLOCK) -> DataFrame:
    """conv_id, perspective, n_turns, text and mask (array of start, end in characters), a row a participant.

    conversations: conv_id, turn, role, text and anything else. Turns are in order of turn, then role, then
    text (nulls first); turns that repeat all stay. A null role is the participant "unknown", a null text is
    empty, a null conv_id is a conversation of its own. A conversation of system turns alone has no
    perspective and gives no row; an empty table gives none. A row is as large as its rendering: for those over
    2 GB, which are no row in Spark, there is rotate_blocks.
    """
    short, long = _renderings(conversations, system, block)
    if long is None:
        return short.drop("block", "start")
    whole = long.groupBy("conv_id", "perspective", "n_turns").agg(F.sort_array(F.collect_list(F.struct("block", "text", "mask"))).alias("b"))
    text = F.array_join(F.transform("b", lambda x: x["text"]), "")
    whole = whole.select("conv_id", "perspective", "n_turns", text.alias("text"), F.flatten(F.transform("b", lambda x: x["mask"])).alias("mask"))
    return short.drop("block", "start").unionByName(whole)


def rotate_blocks(conversations: DataFrame, system: str = "system", block: int = BLOCK) -> DataFrame:
    """The renderings of rotate in blocks of at most `block` turns: conv_id, perspective, block, n_turns, start, text, mask.

    n_turns is that of the whole conversation, start the character of the whole rendering at which the block
    begins, and the mask holds characters of the whole rendering: the texts joined in order of block are the text
    of rotate, the masks joined its mask, whatever the block.
    """
    short, long = _renderings(conversations, system, block)
    return short if long is None else short.unionByName(long)


def _renderings(conversations: DataFrame, system: str, block: int) -> tuple[DataFrame, DataFrame | None]:
    """rotate_blocks of the conversations of one block, and of the longer ones if there are any."""
    c = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.col("text").cast("string").alias("text"))
    # a row a long conversation
    long = c.groupBy(F.col("conv_id").alias("id")).agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("role") != system, F.col("role"))).alias("people"))
    long = cut(long.where(F.col("n") > block), "chat-long")
    n_long, names = long.agg(F.count("*"), F.sum(F.size("people"))).first()
    few = n_long + (names or 0) <= BROADCAST_LONG
    known = F.broadcast(long) if few else long
    same = F.col("conv_id").eqNullSafe(F.col("id"))
    rest = c.join(known, same, "left_anti") if n_long else c
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    blocks = rest.groupBy("conv_id").agg(turns).select("conv_id", F.lit(0).alias("block"), F.size("turns").cast("long").alias("n"), "turns")
    people = F.array_distinct(F.filter(F.transform("turns", lambda t: t["role"]), lambda r: r != system))
    short = _render(blocks.select("conv_id", "block", "n", "turns", F.explode(people).alias("perspective")), system).withColumn("start", F.lit(0).cast("long"))
    if not n_long:
        return short.select(*COLUMNS), None
    mine = c.join(known.select("id"), same, "left_semi").withColumn("one", F.lit(1).cast("long"))
    placed = global_positions(mine, ["conv_id", "turn", "role", "text"], "one").select("conv_id", "turn", "role", "text", "position")
    first = placed.groupBy(F.col("conv_id").alias("id")).agg(F.min("position").alias("first"))
    first = cut(first.join(long.withColumnRenamed("id", "id_"), F.col("id").eqNullSafe(F.col("id_"))).drop("id_"), "chat-first")
    numbered = placed.join(F.broadcast(first) if few else first, same)
    at = F.floor((F.col("position") - F.col("first")) / block).cast("int").alias("block")
    parts = numbered.groupBy("conv_id", at).agg(turns, F.first("people").alias("people"), F.first("n").alias("n"))
    made = _render(parts.select("conv_id", "block", "n", "turns", F.explode("people").alias("perspective")), system)
    made = cut(made.withColumn("chars", F.char_length("text").cast("long")), "chat-blocks")
    drop(first)
    # where each block begins in its rendering, from the narrow columns alone
    key = F.struct("conv_id", "perspective").alias("key")
    before = global_positions(made.select(key, "block", "chars"), ["key", "block"], "chars").select("key", "block", "before")
    origin = before.groupBy(F.col("key").alias("of")).agg(F.min("before").alias("origin"))
    starts = before.join(F.broadcast(origin) if few else origin, F.col("key") == F.col("of")).select("key", F.col("block").alias("at"), (F.col("before") - F.col("origin")).alias("start"))
    placed = made.join(starts, (F.struct("conv_id", "perspective") == F.col("key")) & (F.col("block") == F.col("at")))
    moved = F.transform("mask", lambda m: F.struct((m["start"] + F.col("start")).alias("start"), (m["end"] + F.col("start")).alias("end")))
    return short.select(*COLUMNS), placed.withColumn("mask", moved).select(*COLUMNS)


def _render(each: DataFrame, system: str) -> DataFrame:
    """conv_id, perspective, block, n_turns, text and mask, by characters of the text, of each row's turns."""
    me = F.col("perspective")
    role = lambda t: F.when(t["role"] == me, "assistant").when(t["role"] == system, system).otherwise(F.concat(F.lit("user name="), _name(t["role"])))
    parts = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), role(t), F.lit("\n")).alias("head"), F.concat(_clean(t["text"]), F.lit(END)).alias("said"), (t["role"] == me).alias("own")))
    each = each.select("conv_id", "perspective", "block", "n", parts.alias("parts"))
    sizes = F.transform("parts", lambda p: (F.char_length(p["head"]) + F.char_length(p["said"]) + 1).cast("long"))
    each = each.withColumn("sizes", sizes)
    before = lambda i: F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x)
    spans = F.transform("parts", lambda p, i: F.when(p["own"], F.struct((before(i) + F.char_length(p["head"])).alias("start"), (before(i) + F.char_length(p["head"]) + F.char_length(p["said"])).alias("end"))))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["said"], F.lit("\n"))), "")
    return each.select("conv_id", "perspective", "block", F.col("n").alias("n_turns"), text.alias("text"), F.array_compact(spans).alias("mask"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


QUERIES = {"op8_chat": op8_chat}
