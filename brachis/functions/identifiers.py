"""Column functions on genome, protein, tip and feature identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
ANCESTOR = "ANC|"
#: Endings of sequence files, and of CDS identifiers.
SEQUENCE_ENDINGS = ("faa", "fna", "fa", "fasta", "ffn", "cds")
CDS_SUFFIXES = ("_cds", "_CDS", ".cds", ".p01", "_1")


def genome_key(genome: Column) -> Column:
    """A genome id without one trailing ``.gz`` and then without any number of sequence-file endings."""
    return F.regexp_replace(F.regexp_replace(genome, r"(?i)\.gz$", ""), rf"(?i)(\.({'|'.join(SEQUENCE_ENDINGS)}))+$", "")


def split_combined(target: Column) -> tuple[Column, Column]:
    """Genome and protein of ``genome~protein``, cut at the first tilde; without one the genome is unknown."""
    at = F.locate("~", target)
    return F.when(at > 0, F.substring_index(target, "~", 1)).otherwise(F.when(target.isNotNull(), UNKNOWN)), F.when(at > 0, F.substr(target, at + 1)).otherwise(target)


def tip_of(genome: Column, protein: Column) -> Column:
    return F.concat(genome, F.lit("|"), protein)


def split_tip(tip: Column) -> tuple[Column, Column]:
    """Genome and protein of a tip, cut at the first pipe; without one the genome is unknown."""
    at = F.locate("|", tip)
    return F.when(at > 0, F.substring_index(tip, "|", 1)).otherwise(F.when(tip.isNotNull(), UNKNOWN)), F.when(at > 0, F.substr(tip, at + 1)).otherwise(tip)


def after_first_pipe(name: Column) -> Column:
    at = F.locate("|", name)
    return F.when(at > 0, F.substr(name, at + 1)).otherwise(name)


def cds_id(tip: Column, mode: str = "after_last_pipe") -> Column:
    """The CDS identifier of a protein tip; an unknown mode counts as ``after_last_pipe``."""
    if mode == "same":
        return tip
    return after_first_pipe(tip) if mode == "strip_pipe" else F.substring_index(tip, "|", -1)


def cds_candidates(tip: Column, mode: str = "after_last_pipe") -> Column:
    """Candidate CDS names, best first; null where a candidate does not apply."""
    name = cds_id(tip, mode)
    listed = [name, F.substring_index(name, "|", -1), F.replace(name, F.lit("|"), F.lit("_")), tip, after_first_pipe(tip)]
    for suffix in CDS_SUFFIXES:
        listed += [F.concat(name, F.lit(suffix)), F.when(name.endswith(suffix), F.substr(name, F.lit(1), F.length(name) - len(suffix)))]
    return F.array(*listed)


def first_present(attributes: Column, fields: list[str] | tuple[str, ...], default: str = "NA") -> Column:
    """The first value of the first of ``fields`` that a map of string arrays holds."""
    return F.coalesce(*(F.element_at(attributes, F.lit(f))[0] for f in fields), F.lit(default))


def strand_of(sign: Column) -> Column:
    return F.when(sign == "+", 1).otherwise(-1)


def feature_uid(genome: Column, contig: Column, protein: Column, index: Column) -> Column:
    return F.concat_ws("|", genome, contig, protein, index.cast("string"))


def lineage_kind(name: Column) -> Column:
    """``ancestral`` for reconstructed sequences, else ``modern``."""
    return F.when(name.startswith(ANCESTOR), "ancestral").otherwise("modern")


def ancestor_id(hmm: Column, node: Column) -> Column:
    return F.concat(F.lit(ANCESTOR), hmm, F.lit("_"), node)
