"""Protein tips matched with coding sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import cds_candidates, cds_id, split_tip
from ..functions.sequences import strip_protein_stop, trim_cds_stop


def first_match(rows: DataFrame, candidates: Column, targets: DataFrame, key: list[str], by: list[str] | tuple = ()) -> DataFrame:
    """(key, found, rank): the first of a row's candidates that ``targets(by, name)`` holds; rows without a match are left out."""
    listed = rows.select(*key, *(c for c in by if c not in key), F.posexplode(candidates).alias("rank", "name")).where(F.col("name").isNotNull())
    hit = listed.join(targets.select(*by, "name").distinct(), [*by, "name"])
    return hit.groupBy(*key).agg(F.min(F.struct("rank", "name")).alias("m")).select(*key, F.col("m.name").alias("found"), F.col("m.rank").alias("rank"))


def match_cds(tips: DataFrame, cds: DataFrame, mode: str = "after_last_pipe") -> DataFrame:
    """(hmm, tip, genome, cds_name, rank, cds): each tip's coding sequence, without its last stop codon.

    ``tips(hmm, tip)``, ``cds(genome, name, ord, sequence)``. Names are tried in the order of ``cds_candidates``; where none
    is there, the genome's first CDS whose name holds the tip's CDS id or is held by it counts, with null rank.
    """
    tip = F.col("tip")
    rows = tips.select("hmm", "tip", split_tip(tip)[0].alias("genome"))
    exact = first_match(rows, cds_candidates(tip, mode), cds, ["hmm", "tip", "genome"], ["genome"])
    left = rows.join(exact.select("hmm", "tip", "genome"), ["hmm", "tip", "genome"], "left_anti")
    # the genome's equality keeps this an ordinary join, of unmatched tips only
    near = left.withColumn("id", cds_id(tip, mode)).join(cds.select("genome", "name", "ord"), "genome")
    near = near.where(F.contains(F.col("name"), F.col("id")) | F.contains(F.col("id"), F.col("name")))
    near = near.groupBy("hmm", "tip", "genome").agg(F.min_by("name", "ord").alias("found")).withColumn("rank", F.lit(None).cast("int"))
    both = exact.unionByName(near).withColumnRenamed("found", "cds_name")
    own = cds.select("genome", F.col("name").alias("cds_name"), trim_cds_stop(F.col("sequence")).alias("cds"))
    return both.join(own, ["genome", "cds_name"]).select("hmm", "tip", "genome", "cds_name", "rank", "cds")


def clean_alignment(alignment: DataFrame, column: str = "aligned") -> DataFrame:
    """The alignment without protein stops."""
    return alignment.withColumn(column, strip_protein_stop(F.col(column)))


def codon_subset(alignment: DataFrame, matched: DataFrame, least: int = 3) -> DataFrame:
    """(hmm, tip, ord, cds) in the alignment's order, of families with at least ``least`` matched tips."""
    rows = alignment.select("hmm", "tip", "ord").join(matched.select("hmm", "tip", "cds"), ["hmm", "tip"])
    enough = rows.groupBy("hmm").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return rows.join(enough.select("hmm"), "hmm", "left_semi").orderBy("hmm", "ord")
