"""Ancestral sequences from state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import ancestor_id
from ..functions.sequences import informative_length


def ancestral_sequences(states: DataFrame, least: int = 10) -> DataFrame:
    """(hmm, node, tip, sequence): each node's states in site order, ``X`` at sites from 1 that it lacks.

    ``states(hmm, node, site, state, ord)``; of a repeated site the last row counts. Sequences with fewer than ``least``
    residues other than gaps and ``X`` are dropped. The last site is the node's own.
    """
    site = states.groupBy("hmm", "node", "site").agg(F.max_by("state", "ord").alias("state"))
    node = site.where(F.col("site") >= 1).groupBy("hmm", "node").agg(F.max("site").alias("last"), F.map_from_entries(F.collect_list(F.struct("site", "state"))).alias("by_site"))
    letters = F.transform(F.sequence(F.lit(1), F.col("last")), lambda i: F.coalesce(F.element_at("by_site", i), F.lit("X")))
    rows = node.select("hmm", "node", ancestor_id(F.col("hmm"), F.col("node")).alias("tip"), F.array_join(letters, "").alias("sequence"))
    return rows.where(informative_length(F.col("sequence")) >= least)


def ordered_text(rows: DataFrame, by: str, order: str, letter: str) -> DataFrame:
    """(by, seq): single letters put together in order, ties by letter."""
    row = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(letter).alias("s"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(row, lambda z: z["s"]), "").alias("seq"))
