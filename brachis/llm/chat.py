"""Preference formatting: the common turns of a chosen and a rejected conversation once, then both completions, masked.

The longest common prefix of turns (role and text both equal) is rendered as the prompt; what each side adds is rendered as
its completion, with a mask: segments of code points, ``length:1`` where they are to be learned (the text and end mark of
assistant turns) and ``length:0`` elsewhere (role headers, other roles).

Conversations that begin with the same turn are partners. One without a partner is given a rejected side: its own turns up
to its last assistant turn, in whose place stands that of another conversation without a partner.

Defined results: null roles and texts are empty; turns stand by turn, role and text, null turns first, repeated rows are
repeated turns; rows with a null conv_id belong to no conversation and are left out; equal conversations have empty
completions; a pair without common turns has an empty prompt; a conversation without a partner that has no assistant turn,
or is the only one that has, has null rejected columns and an empty prompt.
A conversation is one row of the result, so it has to fit in one; nothing larger is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, stage_table

LEARNED = "assistant"
END = "<|end|>\n"


def conversations_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order as an array of (role, text)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.struct(F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    given = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("conv_id"), row.alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return given.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def first_turn_pairs(conversations: DataFrame, learned: str = LEARNED) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, derived): every conversation in one pair.

    Conversations in the order of their first turn's digest and id are paired two by two inside a group of one first turn,
    the smaller id being the chosen one. The last of an odd number is chosen in a pair of its own; with ``derived`` its
    rejected_id is the next one of those that has a turn of ``learned``, whose last such turn is to be put in. The order is
    made by range partitions, so a first turn that very many share is spread by the id.
    """
    key = F.md5(F.concat(F.col("turns")[0]["role"], F.lit("\x1f"), F.col("turns")[0]["text"]).cast("binary"))
    keyed = stage_table(conversations.select(key.alias("key"), "conv_id", (_last(F.col("turns"), learned) == 0).alias("mute")), "first-turns")
    odd = keyed.groupBy("key").agg(F.max("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).where(F.col("n") % 2 == 1)
    alone = keyed.join(odd.select("conv_id", F.lit(True).alias("alone")), "conv_id", "left").withColumn("alone", F.col("alone").isNotNull())
    alone = stage_table(alone.withColumn("mute", F.col("alone") & F.col("mute")), "odd-ones")
    paired, givers = alone.agg(F.count_if(~F.col("alone")), F.count_if(F.col("alone") & ~F.col("mute"))).first()
    placed = ranked(alone, "alone", "mute", "key", "conv_id")
    side = placed.where(F.col("rank") < paired).select(F.floor(F.col("rank") / 2).alias("pair_id"), (F.col("rank") % 2).alias("side"), "conv_id")
    pick = lambda k: F.max(F.when(F.col("side") == k, F.col("conv_id")))
    pairs = side.groupBy("pair_id").agg(pick(0).alias("chosen_id"), pick(1).alias("rejected_id")).withColumn("derived", F.lit(False))
    lone = placed.where(F.col("rank") >= paired).select((F.col("rank") - paired).alias("at"), "conv_id", "mute")
    giver = lone.where(~F.col("mute")).select(F.col("at").alias("from"), F.col("conv_id").alias("rejected_id"))
    wanted = F.when(~F.col("mute") & F.lit(givers > 1), (F.col("at") + 1) % max(1, givers))
    lone = lone.withColumn("from", wanted).join(giver, "from", "left")
    return pairs.unionByName(lone.select((F.col("at") + paired // 2).alias("pair_id"), F.col("conv_id").alias("chosen_id"), "rejected_id", F.col("rejected_id").isNotNull().alias("derived")))


def _last(turns, learned: str):
    """Place from 1 of the last turn of this role; 0 without any."""
    return F.coalesce(F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == learned, i + 1).otherwise(0))), F.lit(0))


def _rendered(turns):
    one = F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(END)))
    return F.array_join(one, "")


def _mask(turns, learned: str):
    header = lambda t: (F.length(t["role"]) + 5).cast("string")
    body = lambda t: (F.length(t["text"]) + len(END)).cast("string")
    one = F.transform(turns, lambda t: F.concat(header(t), F.lit(":0,"), body(t), F.when(t["role"] == learned, ":1").otherwise(":0")))
    return F.array_join(one, ",")


def format_preferences(conversations: DataFrame, pairs: DataFrame, learned: str = LEARNED) -> DataFrame:
    """Every pair's prompt and masked completions.

    ``conversations(conv_id, turns)``, ``pairs(pair_id, chosen_id, rejected_id, derived)``; an id may be in any number of
    pairs. A derived pair's rejected conversation is the chosen one up to its last turn of ``learned``, with that of the other.
    """
    side = lambda name: conversations.select(F.col("conv_id").alias(f"{name}_id"), F.col("turns").alias(name))
    both = pairs.join(side("chosen"), "chosen_id").join(side("rejected"), "rejected_id", "left")
    last = _last(F.col("chosen"), learned)
    put_in = F.concat(F.slice("chosen", F.lit(1), F.greatest(last - 1, F.lit(0))), F.slice("rejected", F.greatest(_last(F.col("rejected"), learned), F.lit(1)), F.lit(1)))
    both = both.withColumn("rejected", F.when(F.col("derived"), put_in).otherwise(F.col("rejected")))
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    stop = F.array_position(same, F.lit(False))
    both = both.withColumn("shared", F.when(F.col("rejected").isNull(), 0).when(stop == 0, F.size("chosen")).otherwise(stop - 1).cast("int"))
    rest = lambda name: F.slice(name, F.col("shared") + 1, F.size(name))
    there = F.col("rejected").isNotNull()
    return both.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "derived",
        F.col("shared").cast("long").alias("prompt_turns"),
        _rendered(F.slice("chosen", 1, F.col("shared"))).alias("prompt"),
        _rendered(rest("chosen")).alias("chosen"),
        _mask(rest("chosen"), learned).alias("chosen_mask"),
        F.when(there, _rendered(rest("rejected"))).alias("rejected"),
        F.when(there, _mask(rest("rejected"), learned)).alias("rejected_mask"),
    )


def preferences(turns: DataFrame) -> DataFrame:
    """Format the conversations of ``turns``, paired by their first turn."""
    conversations = stage_table(conversations_of(turns), "conversations")
    return format_preferences(conversations, first_turn_pairs(conversations))
