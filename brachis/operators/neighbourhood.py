"""Gene neighbourhoods: the features around a focal one by rank, and tracks of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import feature_uid, first_present

#: Attribute names for identifiers and for labels, best first.
ID_FIELDS = ("ID", "protein_id", "locus_tag")
LABEL_FIELDS = ("gene", "product", "Name", "locus_tag")


def ordinal_window(rows: DataFrame, focal: Column, by: list[str], order: list[str], width: int, focal_id: Column) -> DataFrame:
    """Rows at most ``width`` places from a focal row of their group: adds ``focal``, ``off`` and ``is_focal``.

    Every focal row gives a window of its own. Each focal row is sent to the places that it covers and met there by
    equality, so a group with many rows is joined by place and never held together.
    """
    numbered = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    around = F.explode(F.sequence(F.lit(-width), F.lit(width))).alias("off")
    centre = numbered.where(focal).select(*by, focal_id.alias("focal"), F.col("_i").alias("_c"), around).withColumn("_i", F.col("_c") + F.col("off")).where(F.col("_i") >= 1)
    hit = numbered.join(centre, [*by, "_i"])
    return hit.select(*rows.columns, "focal", F.col("off").cast("long").alias("off"), (F.col("off") == 0).alias("is_focal"))


def matches(attributes: Column, protein: Column, fields: tuple = ID_FIELDS) -> Column:
    """Whether any of the id fields holds the protein."""
    return F.coalesce(F.expr("false") if not fields else F.greatest(*(F.coalesce(F.array_contains(F.element_at(attributes, F.lit(f)), protein), F.lit(False)) for f in fields), F.lit(False)), F.lit(False))


def neighbourhoods(hits: DataFrame, features: DataFrame, width: int = 10, by_contig: bool = False, id_fields: tuple = ID_FIELDS, label_fields: tuple = LABEL_FIELDS) -> DataFrame:
    """The features at most ``width`` places from each hit's first matching one.

    ``hits(hmm, genome, protein, file)``, ``features`` as read by the sources. The window runs over the whole file, across
    contigs, or with ``by_contig`` over the first contig with a match, as it must for GenBank records. A hit without a
    match gives no rows. ``idx`` numbers a neighbourhood's features from 0.
    """
    groups = ["file", "contig"] if by_contig else ["file"]
    place = features.withColumn("_i", F.row_number().over(Window.partitionBy(*groups).orderBy("ord")))
    names = F.array_distinct(F.flatten(F.array(*(F.coalesce(F.element_at("attributes", F.lit(f)), F.array().cast("array<string>")) for f in id_fields))))
    named = place.select(*groups, "ord", "_i", F.explode(names).alias("protein"))
    focal = hits.select("hmm", "genome", "protein", "file").distinct().join(named, ["file", "protein"])
    first = focal.groupBy("hmm", "genome", "protein", "file").agg(F.min_by(F.struct(*groups, F.col("_i").alias("_c")), "ord").alias("f"))
    first = first.select("hmm", "genome", F.col("protein").alias("focal"), "f.*", F.explode(F.sequence(F.lit(-width), F.lit(width))).alias("_off")).withColumn("_i", F.col("_c") + F.col("_off"))
    hit = place.join(first, [*groups, "_i"])
    hit = hit.withColumn("protein_id", first_present(F.col("attributes"), id_fields)).withColumn("label", first_present(F.col("attributes"), label_fields))
    idx = F.row_number().over(Window.partitionBy("hmm", "genome", "focal").orderBy("_off")) - 1
    hit = hit.withColumn("idx", idx)
    translation = F.coalesce(F.element_at("attributes", F.lit("translation"))[0], F.lit(""))
    uid = feature_uid(F.col("genome"), F.col("contig"), F.col("protein_id"), F.col("idx"))
    return hit.select("hmm", "genome", "focal", "idx", uid.alias("uid"), "contig", "start", "end", "strand", "label", "protein_id", translation.alias("translation"), (F.col("_off") == 0).alias("is_focal"))


def first_available(preferred: DataFrame, fallback: DataFrame, key: list[str] | tuple = ("hmm", "genome", "focal")) -> DataFrame:
    """All of ``preferred``, and of ``fallback`` the groups that it lacks."""
    return preferred.unionByName(fallback.join(preferred.select(*key).distinct(), list(key), "left_anti"))


def tracks(rows: DataFrame) -> DataFrame:
    """Adds what a drawing needs: start and size relative to the track, its extent, arrow direction and colour."""
    track = Window.partitionBy("hmm", "genome", "focal")
    low, high = F.min("start").over(track), F.max("end").over(track)
    return rows.select("*", (F.col("start") - low).alias("rel_start"), (F.col("end") - low).alias("rel_end"), (high - low + 1).alias("track_size"), F.when(F.col("strand") == 1, 1).otherwise(-1).alias("direction"), F.when(F.col("is_focal"), "tomato").otherwise("skyblue").alias("colour"))


def in_tree_order(groups: DataFrame, leaves: DataFrame) -> DataFrame:
    """``groups(genome, ord, ...)`` with ``place``: those of the tree's leaves first, in leaf order, the rest as they were.

    ``leaves(genome, leaf_ord)``: a genome on several leaves stands at the first.
    """
    leaf = leaves.groupBy(F.col("genome").alias("_key")).agg(F.min("leaf_ord").alias("_leaf"))
    met = groups.join(leaf, F.col("genome") == F.col("_key"), "left")
    return met.withColumn("place", F.row_number().over(Window.partitionBy(*(["hmm"] if "hmm" in groups.columns else [])).orderBy(F.col("_leaf").asc_nulls_last(), "ord"))).drop("_key", "_leaf")


def similarity_links(links: DataFrame, min_identity: float = 30, min_bitscore: float = 50) -> DataFrame:
    """Links between neighbourhoods that are alike enough to draw."""
    return links.where((F.col("identity") >= min_identity) & (F.col("bitscore") >= min_bitscore))
