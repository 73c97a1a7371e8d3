"""Families' sequences: hits joined with proteomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import tip_of


def members(hits: DataFrame, proteins: DataFrame) -> DataFrame:
    """(hmm, tip, genome, protein, ord, sequence) of hits whose protein has a sequence; a repeated hit gives one row."""
    own = proteins.where(F.length("sequence") > 0).select("genome", "protein", "ord", "sequence")
    return hits.select("hmm", "genome", "protein").distinct().join(own, ["genome", "protein"]).select("hmm", tip_of(F.col("genome"), F.col("protein")).alias("tip"), "genome", "protein", "ord", "sequence")


def large_enough(rows: DataFrame, by: str | list[str] = "hmm", least: int = 3) -> DataFrame:
    """Rows of groups of at least ``least`` rows; counts are aggregated before they meet the rows."""
    keys = [by] if isinstance(by, str) else by
    enough = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).drop("_n")
    return rows.join(enough, keys, "left_semi")


def combined(rows: DataFrame, order: list[str] | tuple = ("hmm", "ord")) -> DataFrame:
    """One row a tip over all families: that of the first family."""
    rank = F.row_number().over(Window.partitionBy("tip").orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def with_ancestors(modern: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(tip, sequence, hmm) of both; of a tip in both the ancestor's sequence counts."""
    both = modern.select("tip", "sequence", "hmm", F.lit(0).alias("_rank")).unionByName(ancestors.select("tip", "sequence", "hmm", F.lit(1).alias("_rank")))
    return both.groupBy("tip").agg(F.max_by(F.struct("sequence", "hmm"), F.struct("_rank", "hmm")).alias("s")).select("tip", "s.sequence", "s.hmm")


def reordered(rows: DataFrame, guide: DataFrame, on: str = "tip", order: str = "ord") -> DataFrame:
    """``rows`` in the order of another table."""
    return rows.join(guide.select(on, F.col(order).alias("_guide")), on).orderBy("_guide").drop("_guide")
