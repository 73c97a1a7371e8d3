"""Mixing sources to target weights by capped water-filling.

A share of all words is dealt to the sources by weight; a source stops at ``epochs`` times its size and what it cannot
take is dealt again to the others by weight, until none is above its limit. A source then repeats each document
floor(target / size) times, and the rest of its target is made up of documents drawn by a seeded hash of id and text: those
with the smallest hashes, up to the hash at which the words drawn come nearest the target. That hash is found by two
histograms of 4,096 buckets a source, and then among the hashes of one bucket, so no source, however large, is sorted or
gathered. Equal rows have one hash; where the draw ends among them, some are taken by their number.

Defined results: a null or wordless text has size 0; a null source is a source of its own, last in order; empty sources
get target 0; rows that share a doc_id, or have none, are drawn by their text; of equal rows as many are taken as bring the
words nearest the target, whichever they are. Reruns agree, since the draw depends on doc_id, text and seed only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, drop_table, ranked, stage_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 20_177
#: Plans of up to this many sources (a few MB) are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 100_000
_BITS = 12


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """(source, source_size, target) of ``sources(source, source_size)`` by capped water-filling; weights repeat in order."""
    placed = ranked(sources, F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    state = stage_table(placed.select("source", "source_size", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"), (F.col("source_size") * float(epochs)).alias("cap")), "sources")
    total, weight = state.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (total or 0)
    level, was = (budget / weight if weight else 0.0), -1.0
    while level != was and weight:
        over = F.col("cap") < F.lit(level) * F.col("weight")
        held, free = state.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        was, level = level, max(level, (budget - held) / free) if free else level
    return state.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def plan_mix(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """Per source of ``sizes(source, size, h)``: target, whole repetitions, the hash ``cut`` below which one more is taken, and
    how many ``extra`` ones of the rows with that very hash."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(totals, weights, share, epochs)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = stage_table(plan, "mix-plan")
    def cut(words: DataFrame, need: str, at: str) -> DataFrame:
        """Of ``words(source, need, at, words, ...)`` each source's first row at which the words so far reach the need."""
        run = Window.partitionBy("source").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = words.withColumn("upto", F.sum("words").over(run)).where(F.col("upto") >= F.col(need))
        rest = (F.col(need) - F.col("upto") + F.col("words")).alias("rest")
        more = [c for c in words.columns if c not in {"source", need, at, "words"}]
        return stage_table(reached.groupBy("source").agg(F.min(F.struct(at, rest, *more)).alias("e")).select("source", "e.*"), "mix-edge")

    def inside(edge: DataFrame, *met) -> DataFrame:
        """The rows of ``sizes`` in the bucket of their source's edge."""
        edge = edge.withColumnRenamed("source", "_source")
        side = F.broadcast(edge) if edge.count() <= BROADCAST_SOURCES else edge
        return sizes.join(side, sizes["source"].eqNullSafe(edge["_source"]) & met[0]).drop("_source")

    some = plan.where("need > 0").select(F.col("source").alias("_source"), "need")
    first = sizes.groupBy("source", _bucket(1).alias("b1")).agg(F.sum("size").alias("words"))
    first = first.join(some, first["source"].eqNullSafe(some["_source"])).drop("_source")
    edge = cut(first, "need", "b1").select("source", F.col("b1").alias("cut1"), F.col("rest").alias("need"))
    second = inside(edge, _bucket(1) == F.col("cut1")).groupBy("source", "need", "cut1", _bucket(2).alias("b2")).agg(F.sum("size").alias("words"))
    edge = cut(second, "need", "b2").select("source", F.col("b2").alias("cut2"), F.col("rest").alias("need"))
    third = inside(edge, _bucket(2) == F.col("cut2")).groupBy("source", "need", "h", "size").agg(F.count(F.lit(1)).alias("rows"))
    edge = cut(third.withColumn("words", F.col("size") * F.col("rows")), "need", "h")
    extra = F.when(F.col("size") > 0, F.round(F.col("rest") / F.col("size"))).otherwise(0).cast("long")
    edge = edge.select(F.col("source").alias("_source"), "h", "rows", extra.alias("extra"))
    whole_group = F.col("extra") >= F.col("rows")
    edge = edge.select("_source", F.when(whole_group, F.col("h") + 1).otherwise(F.col("h")).alias("cut"), F.when(whole_group, 0).otherwise(F.col("extra")).alias("extra"))
    out = plan.join(edge, plan["source"].eqNullSafe(edge["_source"]), "left")
    return stage_table(out.select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut"), F.coalesce("extra", F.lit(0)).alias("extra")), "mix")


def _bucket(level: int):
    """The first 12 or 24 of a hash's 63 bits."""
    return F.shiftright("h", 63 - level * _BITS)


def _hash(id_col: str, text_col: str, seed: int):
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), 1)


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows(source, h, ...)`` with the plan's columns and ``copies``; equal rows among which the draw ends are numbered."""
    plan = stage_table(plan.withColumnRenamed("source", "_source"), "mix-side")
    side = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    met = rows.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    out = met.withColumn("copies", F.col("whole") + (F.col("h") < F.col("cut")).cast("long"))
    if plan.where("extra > 0").isEmpty():
        return out
    edge = (F.col("h") == F.col("cut")) & (F.col("extra") > 0)
    placed = stage_table(ranked(out.where(edge), "source"), "mix-equal")
    begins = placed.groupBy(F.col("source").alias("_source")).agg(F.min("rank").alias("_begin"))
    placed = placed.join(begins, F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.withColumn("copies", F.col("whole") + (F.col("rank") - F.col("_begin") < F.col("extra")).cast("long"))
    return out.where(~edge).unionByName(placed.select(*out.columns))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), _hash(id_col, text_col, seed).alias("h"))
    thin = stage_table(thin, "mix-sizes")
    out = _with_copies(thin, plan_mix(thin, weights, share, epochs))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, columns unchanged, each as often as the mix takes it."""
    h = _hash("doc_id", "text", seed).alias("h")
    thin = stage_table(docs.select("source", n_words(F.col("text")).alias("size"), h), "mix-sizes")
    plan = plan_mix(thin, weights, share, epochs).select("source", "whole", "cut", "extra")
    drop_table(thin)
    out = _with_copies(docs.select(F.struct(*docs.columns).alias("_row"), "source", h), plan).where(F.col("copies") > 0)
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
