"""Profile hits: projection, filtering, competitive resolution, membership.

Every window has a total order; ``order`` names the columns that settle ties (a source's ``ord``, or whatever identifies
a row). Rows with a null key are left out of rankings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import split_combined


def scan_hits(raw: DataFrame, genome: Column) -> DataFrame:
    """Hits of proteins searched against profiles: the target is the profile, the query the protein."""
    cover = (F.col("ali_to") - F.col("ali_from") + 1) / F.col("qlen")
    return raw.select(genome.alias("genome"), F.col("query").alias("protein"), F.col("target").alias("hmm"), "bitscore", "evalue", cover.alias("coverage"))


def search_hits(raw: DataFrame) -> DataFrame:
    """Hits of profiles searched against the combined proteome: the target is ``genome~protein``, the query the profile."""
    genome, protein = split_combined(F.col("target"))
    cover = (F.col("ali_to") - F.col("ali_from") + 1) / F.col("tlen")
    return raw.select(genome.alias("genome"), protein.alias("protein"), F.col("query").alias("hmm"), "bitscore", "evalue", cover.alias("coverage"))


def filter_hits(hits: DataFrame, thresholds: DataFrame | None = None, min_score: float = 25.0, min_coverage: float = 0.5) -> DataFrame:
    """Hits of enough coverage and score, with the ``min_score_required`` that each met.

    Coverage is only tested if ``min_coverage`` is positive, so that hits without one survive at 0. ``thresholds(hmm,
    min_score)`` has one row a profile; profiles without one meet ``min_score``.
    """
    if min_coverage > 0:
        hits = hits.where(F.col("coverage") >= min_coverage)
    if thresholds is None:
        hits = hits.withColumn("min_score_required", F.lit(float(min_score)))
    else:
        own = thresholds.select("hmm", F.col("min_score").alias("_own"))
        hits = hits.join(own, "hmm", "left").withColumn("min_score_required", F.coalesce("_own", F.lit(float(min_score)))).drop("_own")
    return hits.where(F.col("bitscore") >= F.col("min_score_required"))


def best_hits(hits: DataFrame, order: list[str] | tuple = ()) -> DataFrame:
    """The best hit of each (genome, protein), with its lead over the next row (its score, if it stands alone).

    The next row may be another domain of the same profile, which makes the lead 0. Two rows a key are enough, and the
    ranking is cut to them before the shuffle.
    """
    hits = hits.dropna(subset=["genome", "protein"])
    rank = F.row_number().over(Window.partitionBy("genome", "protein").orderBy(F.col("bitscore").desc(), *order))
    top = hits.withColumn("_rank", rank).where(F.col("_rank") <= 2)
    row = F.struct(*hits.columns)
    best = top.groupBy("genome", "protein").agg(F.max(F.when(F.col("_rank") == 1, row)).alias("_best"), F.max(F.when(F.col("_rank") == 2, F.col("bitscore"))).alias("_next"))
    return best.select("_best.*", (F.col("_best.bitscore") - F.coalesce("_next", F.lit(0.0))).alias("delta_bitscore"))


def preferred(scan: DataFrame, search: DataFrame) -> DataFrame:
    """The scan's rows, or if it has none the search's; ``source`` says which."""
    if not scan.isEmpty():
        return scan.withColumn("source", F.lit("hmmscan"))
    return search.withColumn("source", F.lit("hmmsearch"))


def keep_profiles(rows: DataFrame, manifest: DataFrame | None, column: str = "hmm") -> DataFrame:
    """Rows whose profile the manifest names; no manifest keeps all."""
    return rows if manifest is None else rows.join(manifest.select(F.col("hmm").alias(column)).distinct(), column, "left_semi")


def top_members(hits: DataFrame, keep_all: bool = False, order: list[str] | tuple = ("protein",)) -> DataFrame:
    """The best hit of each (genome, hmm); all of them with ``keep_all``."""
    if keep_all:
        return hits
    rank = F.row_number().over(Window.partitionBy("genome", "hmm").orderBy(F.col("bitscore").desc(), *order))
    return hits.dropna(subset=["genome", "hmm"]).withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def representative_hits(hits: DataFrame, dedup_by_genome: bool = True, max_hits: int = 50, order: list[str] | tuple = ("genome", "protein")) -> DataFrame:
    """Of each profile the best hit a genome, and of those the ``max_hits`` best; without ``dedup_by_genome`` all rows."""
    if not dedup_by_genome:
        return hits
    one = top_members(hits, order=order)
    rank = F.row_number().over(Window.partitionBy("hmm").orderBy(F.col("bitscore").desc(), *order))
    return one.withColumn("_rank", rank).where(F.col("_rank") <= max_hits).drop("_rank")


def first_source_wins(sources: list[DataFrame], key: list[str] | tuple = ("genome", "protein", "hmm"), order: list[str] | tuple = ()) -> DataFrame:
    """The union of the sources with one row a key, of the earliest source and there the first by ``order``."""
    ranked = [s.withColumn("src", F.lit(n)) for n, s in enumerate(sources)]
    union = ranked[0]
    for more in ranked[1:]:
        union = union.unionByName(more, allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("src", *order))
    return union.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
