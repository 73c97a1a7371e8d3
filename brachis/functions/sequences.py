"""Column functions on protein and nucleotide sequences."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The residues that statistics count, and the characters that stand for none.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
GAPS = ("-", ".", "X", "x", "?", "*")
STOPS = ("TAA", "TAG", "TGA")


def _without(sequence: Column, drop: str) -> Column:
    return F.translate(sequence, drop, "")


def for_embedding(sequence: Column) -> Column:
    return _without(sequence, " \n*.")


def for_motifs(sequence: Column) -> Column:
    return _without(sequence, "*-X")


def for_discovery(sequence: Column) -> Column:
    return _without(sequence, "*-")


def informative_length(sequence: Column) -> Column:
    """Length without gaps and unknown residues."""
    return F.length(_without(sequence, "-X"))


def strip_protein_stop(sequence: Column) -> Column:
    """Trailing gaps, then trailing stops, then trailing gaps go; then every stop inside does.

    Aligned rows may end up of different lengths.
    """
    trimmed = F.regexp_replace(F.regexp_replace(F.regexp_replace(sequence, r"-+$", ""), r"\*+$", ""), r"-+$", "")
    return F.replace(trimmed, F.lit("*"), F.lit(""))


def trim_cds_stop(sequence: Column) -> Column:
    """Line breaks and spaces go, then one final stop codon in any case."""
    return F.regexp_replace(F.regexp_replace(sequence, r"[\n\r ]", ""), rf"(?i)({'|'.join(STOPS)})$", "")


def residue(character: Column) -> Column:
    """The residue that a character of an alignment counts as; null for gaps and letters outside the alphabet."""
    upper = F.upper(character)
    return F.when(~character.isin(*GAPS) & upper.isin(*RESIDUES), upper)


def find_all(text: str, motif: str) -> list[int]:
    """All 0-based starts of a motif, overlapping ones too, in time linear in the text; an empty motif stands everywhere."""
    if not motif:
        return list(range(len(text) + 1))
    out, at = [], text.find(motif)
    while at >= 0:
        out.append(at)
        at = text.find(motif, at + 1)
    return out


def motif_positions(sequence: Column, motif: Column) -> Column:
    """All 0-based starts of a motif, overlapping ones too; case counts. Null where either is null."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        both = zip(texts.to_pylist(), wanted.to_pylist(), strict=True)
        return pa.array([None if t is None or m is None else find_all(t, m) for t, m in both], pa.list_(pa.int32()))

    return run(sequence, motif)


def motif_starts(sequence: Column, motifs: list[str]) -> Column:
    """``motif_positions`` of every motif in one pass: an array with one array of starts a motif."""

    @F.arrow_udf("array<array<int>>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [find_all(t, m) for m in motifs] for t in texts.to_pylist()], pa.list_(pa.list_(pa.int32())))

    return run(sequence)


def kmer_at(sequence: Column, position: Column, k: int = 5) -> Column:
    """The k-mer around a 0-based position, moved inwards at the ends (shorter sequences: all of it)."""
    start = F.greatest(F.lit(0), position - k // 2)
    end = F.least(F.length(sequence), start + k)
    start = F.greatest(F.lit(0), end - k)
    return F.substr(sequence, start + 1, end - start)


def raw_position(point: Column, length: Column, points: int = 500) -> Column:
    """The position in a sequence of this length of a point of a profile of ``points``."""
    return F.least(F.floor(point / F.lit(float(points)) * length).cast("int"), length - 1)


def resample(profile: Column, points: int = 500) -> Column:
    """A profile linearly interpolated at ``points`` equally spaced places, its ends included.

    A profile of one value is that value everywhere; an empty one gives null.
    """
    last = F.size(profile) - 1

    def at(i: Column) -> Column:
        x = i.cast("double") * last / F.lit(float(points - 1))
        low = F.least(F.floor(x).cast("int"), last)
        a, b = F.get(profile, low), F.get(profile, F.least(low + 1, last))
        return a + (b - a) * (x - low)

    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.lit(points - 1)), at))
