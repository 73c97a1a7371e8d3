"""Lineages joined by normalised genome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import UNKNOWN, genome_key


def with_lineage(rows: DataFrame, taxonomy: DataFrame, genome: str = "genome", normalise: bool = True) -> DataFrame:
    """Adds ``taxonomy`` by the genome's key; ``Unknown`` where there is none. The lineages have one row a key."""
    key = genome_key(F.col(genome)) if normalise else F.col(genome)
    side = taxonomy.select(F.col("genome_key").alias("_key"), F.col("taxonomy").alias("_lineage"))
    return rows.join(side, key == F.col("_key"), "left").withColumn("taxonomy", F.coalesce("_lineage", F.lit(UNKNOWN))).drop("_key", "_lineage")


def genome_lineages(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(genome, taxonomy) of the distinct genomes of a table."""
    return with_lineage(rows.select("genome").distinct(), taxonomy)
