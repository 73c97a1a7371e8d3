"""Motif search, attention scores and motif discovery. Attention comes as a column, whichever model made it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import lineage_kind
from ..functions.sequences import for_discovery, for_motifs, kmer_at, motif_starts, raw_position, resample

POINTS = 500


def attention_mean(attention, layers: int = 4) -> np.ndarray:
    """Mean of the last ``layers`` layers and all heads of an array layers x heads x tokens x tokens."""
    x = np.array(attention.tolist() if isinstance(attention, np.ndarray) and attention.dtype == object else attention, np.float64)
    return x[max(0, len(x) - layers) :].mean((0, 1))


def attention_to_motif(mean: np.ndarray, positions: list[int], size: int) -> float:
    """Attention that reaches the motif's tokens, over the number of tokens, averaged over the places; one begin mark."""
    tokens = len(mean)
    scores = [mean[:, p + 1 : min(p + 1 + size, tokens)].sum() / tokens for p in positions if p + 1 < tokens]
    return float(np.mean(scores)) if scores else 0.0


def attention_profile(mean: np.ndarray, length: int) -> np.ndarray:
    """Attention that each residue receives from the others, begin and end marks left out."""
    return mean[1 : length + 1, 1 : length + 1].sum(0)


def _nested(x):
    return [_nested(y) for y in x] if isinstance(x, (list, np.ndarray)) and len(x) and isinstance(x[0], (list, np.ndarray)) else list(x)


def motif_scores(attention: Column, positions: Column, size: Column, layers: int = 4) -> Column:
    """``attention_to_motif`` of each row; a null attention gives null."""

    @F.pandas_udf("double")
    def run(a: pd.Series, p: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else attention_to_motif(attention_mean(_nested(x), layers), list(y), int(m)) for x, y, m in zip(a, p, n, strict=True)], dtype="float64")

    return run(attention, positions, size)


def profiles(attention: Column, length: Column, layers: int = 4) -> Column:
    """``attention_profile`` of each row; a null attention gives null."""

    @F.pandas_udf("array<double>")
    def run(a: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else attention_profile(attention_mean(_nested(x), layers), int(m)).tolist() for x, m in zip(a, n, strict=True)])

    return run(attention, length)


def score_motifs(sequences: DataFrame, motifs: list[str], clusters: DataFrame | None = None, least: int = 10, layers: int = 4) -> DataFrame:
    """One row a motif place: hmm, seq_id, motif, start_pos, end_pos, attention_score, motif_present, clade_id, type.

    ``sequences(hmm, seq_id, sequence[, attention])``; cleaned sequences shorter than ``least`` are left out. A motif that a
    sequence lacks gives one row with places -1 and score 0; places of one motif share their mean score, which is null
    without an attention. ``clusters(seq_id, clade_id)``: empty string where there is none.
    """
    clean = sequences.withColumn("clean", for_motifs(F.col("sequence"))).where(F.length("clean") >= least)
    found = clean.withColumn("found", motif_starts(F.col("clean"), motifs))
    named = F.arrays_zip(F.array(*map(F.lit, motifs)).alias("motif"), F.col("found").alias("at"))
    rows = found.withColumn("each", F.explode(named)).withColumns({"motif": F.col("each.motif"), "at": F.col("each.at")}).drop("each", "found", "clean")
    score = motif_scores(F.col("attention"), F.col("at"), F.length("motif"), layers) if "attention" in sequences.columns else F.lit(None).cast("double")
    rows = rows.withColumn("present", F.size("at") > 0).withColumn("score", score)
    rows = rows.select("hmm", "seq_id", "motif", F.explode(F.when(F.col("present"), F.col("at")).otherwise(F.array(F.lit(-1)))).alias("start_pos"), "present", "score")
    if clusters is not None:
        rows = rows.join(clusters, "seq_id", "left")
    clade = F.coalesce("clade_id", F.lit("")) if clusters is not None else F.lit("")
    return rows.select(
        "hmm",
        "seq_id",
        "motif",
        "start_pos",
        F.when(F.col("present"), F.col("start_pos") + F.length("motif")).otherwise(-1).alias("end_pos"),
        F.when(F.col("present"), F.col("score")).otherwise(0.0).alias("attention_score"),
        F.col("present").alias("motif_present"),
        clade.alias("clade_id"),
        lineage_kind(F.col("seq_id")).alias("type"),
    )


def mean_profile(rows: DataFrame, by: list[str], profile: str = "profile", points: int = POINTS) -> DataFrame:
    """(by, i, value): the mean of the profiles, each resampled to ``points``; empty and null ones are left out."""
    long = rows.select(*by, F.posexplode(resample(F.col(profile), points)).alias("i", "x"))
    return long.groupBy(*by, "i").agg(F.avg("x").alias("value"))


def find_peaks(delta: np.ndarray, top_n: int = 20, distance: int = 5) -> list[tuple[int, float]]:
    """The highest local maxima at least ``distance`` apart, highest first; without any the highest points.

    A flat top counts at its middle; of two peaks too close the lower goes, highest peaks deciding first.
    """
    found, i, last = [], 1, len(delta) - 1
    while i < last:
        if delta[i - 1] < delta[i]:
            j = i
            while j < last and delta[j + 1] == delta[i]:
                j += 1
            if j < last and delta[j + 1] < delta[i]:
                found.append((i + j) // 2)
            i = j
        i += 1
    keep = dict.fromkeys(found, True)
    for p in sorted(found, key=lambda p: (delta[p], p), reverse=True):
        if keep[p]:
            keep |= {q: False for q in found if q != p and abs(q - p) < distance}
    peaks = [p for p in found if keep[p]] or list(range(len(delta)))
    return [(p, float(delta[p])) for p in sorted(peaks, key=lambda p: (delta[p], p), reverse=True)[:top_n]]


def profile_peaks(sequences: DataFrame, standard: str, novel: str, top_n: int = 20, distance: int = 5) -> DataFrame:
    """(point, delta): peaks of the novel clade's mean profile over the standard clade's; those of 0 and less go last, after the cut.

    ``sequences(clade_id, profile)``. One group of ``POINTS`` rows at most is searched, whatever the number of sequences.
    """
    means = mean_profile(sequences.where(F.col("clade_id").isin(standard, novel)), ["clade_id"])
    part = lambda c: F.max(F.when(F.col("clade_id") == c, F.col("value")))
    delta = means.groupBy("i").agg((part(novel) - part(standard)).alias("delta")).where(F.col("delta").isNotNull())

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(find_peaks(rows.sort_values("i")["delta"].to_numpy(), top_n, distance), columns=["point", "delta"])

    return delta.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, "point int, delta double").where(F.col("delta") > 0)


def discover_motifs(sequences: DataFrame, standard: str, novel: str, k: int = 5, top_n: int = 20, least: int = 10, layers: int = 4) -> DataFrame:
    """k-mers of the novel clade's sequences at the profile peaks: kmer, n_sequences, mean_attention_delta, median_position,
    representative_seq_id, source_clade, reference_clade.

    ``sequences(seq_id, ord, sequence, clade_id)`` with ``attention`` or a ready ``profile``.
    """
    rows = sequences.withColumn("clean", for_discovery(F.col("sequence"))).where(F.length("clean") >= least)
    if "profile" not in rows.columns:
        rows = rows.withColumn("profile", profiles(F.col("attention"), F.length("clean"), layers))
    rows = rows.where(F.col("profile").isNotNull())
    peaks = profile_peaks(rows, standard, novel, top_n)
    at = raw_position(F.col("point"), F.length("clean"), POINTS)
    met = rows.where(F.col("clade_id") == novel).join(F.broadcast(peaks), F.lit(True))  # at most top_n rows
    found = met.select(kmer_at(F.col("clean"), at, k).alias("kmer"), at.alias("position"), "delta", "seq_id", "ord", "point")
    return kmer_summary(found, top_n).withColumns({"source_clade": F.lit(novel), "reference_clade": F.lit(standard)})


def kmer_summary(found: DataFrame, top_n: int = 20) -> DataFrame:
    """Of ``found(kmer, position, delta, seq_id, ord, point)`` the ``top_n`` k-mers by mean delta, ties by k-mer."""
    out = found.groupBy("kmer").agg(
        F.countDistinct("seq_id").alias("n_sequences"),
        F.avg("delta").alias("mean_attention_delta"),
        F.median("position").alias("median_position"),
        F.min_by("seq_id", F.struct(-F.col("delta"), "ord")).alias("representative_seq_id"),
    )
    return out.orderBy(F.col("mean_attention_delta").desc(), "kmer").limit(top_n)


def _kmer_keys(text: str, k: int) -> np.ndarray | None:
    """A number for each k-mer of a text; None where code points are too large for k of them to fit in one number."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = 62 // k
    if len(points) and points.max() >> bits:
        return None
    key, n = np.zeros(len(points) - k + 1, np.int64), len(points) - k + 1
    for i in range(k):
        key = key << bits | points[i : i + n]
    return key


def _kmer_of(key: int, k: int) -> str:
    bits = 62 // k
    return "".join(chr(key >> bits * i & (1 << bits) - 1) for i in range(k - 1, -1, -1))


def common_kmers(sequences: DataFrame, k: int = 5, top_n: int = 50) -> DataFrame:
    """Of all k-mers of ``sequences(seq_id, sequence)`` the ``top_n`` that most of them hold, ties by k-mer: kmer, n_sequences,
    mean_position, median_position (from 1), representative_seq_id (the smallest).

    Every position of every sequence counts. The first pass counts sequences only, summed over a batch before they leave the
    task; positions are then summed for the k-mers chosen. Rows of one seq_id are one sequence; null ones count for none.
    """
    given = sequences.select("seq_id", "sequence").where(F.length("sequence") >= k)
    kind = given.schema["seq_id"].dataType
    repeated = given.groupBy("seq_id").agg(F.count(F.lit(1)).alias("_rows")).where((F.col("_rows") > 1) & F.col("seq_id").isNotNull())

    def held(batches):
        def summed(keys: list[np.ndarray], rare: dict[str, int]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate([np.empty(0, np.int64), *keys]), return_counts=True)
            kmers = [_kmer_of(x, k) for x in found.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(kmers + list(rare), pa.string()), pa.array(n.tolist() + list(rare.values()), pa.int64())], names=["kmer", "n"])

        keys, rare, size = [], {}, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                key = _kmer_keys(text, k)
                if key is None:
                    for x in {text[i : i + k] for i in range(len(text) - k + 1)}:
                        rare[x] = rare.get(x, 0) + 1
                else:
                    keys.append(np.unique(key))
                size += len(text)
                if size > 8_000_000:
                    yield summed(keys, rare)
                    keys, rare, size = [], {}, 0
        yield summed(keys, rare)

    def held_by(batches):
        for batch in batches:
            for at, text in enumerate(batch.column(1).to_pylist()):
                kmers = list({text[i : i + k] for i in range(len(text) - k + 1)})
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([at] * len(kmers), pa.int64())), pa.array(kmers, pa.string())], names=["seq_id", "kmer"])

    once = given.where(F.col("seq_id").isNotNull()).join(repeated, "seq_id", "left_anti").select("sequence").mapInArrow(held, "kmer string, n long")
    again = T.StructType([T.StructField("seq_id", kind), T.StructField("kmer", T.StringType())])
    several = given.join(repeated, "seq_id", "left_semi").select("seq_id", "sequence").mapInArrow(held_by, again).distinct().select("kmer", F.lit(1).cast("long").alias("n"))
    unnamed = given.where(F.col("seq_id").isNull()).select("sequence").mapInArrow(held, "kmer string, n long").select("kmer", F.lit(0).cast("long").alias("n"))
    counted = once.unionByName(several).unionByName(unnamed).groupBy("kmer").agg(F.sum("n").alias("n_sequences"))
    chosen = counted.orderBy(F.col("n_sequences").desc(), "kmer").limit(top_n).collect()  # top_n rows
    number = {r.kmer: i for i, r in enumerate(chosen)}
    places = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("p", T.IntegerType()), T.StructField("seq_id", kind)])

    def placed(batches):
        narrow = sorted((int(key[0]), i) for x, i in number.items() if (key := _kmer_keys(x, k)) is not None)
        keys, numbers = np.array([x for x, _ in narrow], np.int64), np.array([i for _, i in narrow], np.int32)
        for batch in batches:
            at, p, rows = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                key = _kmer_keys(text, k)
                if key is None:
                    found = np.array([number.get(text[i : i + k], -1) for i in range(len(text) - k + 1)], np.int32)
                elif len(keys):
                    near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    found = np.where(keys[near] == key, numbers[near], -1)
                else:
                    continue
                here = np.flatnonzero(found >= 0)
                at.append(found[here]), p.append(here + 1), rows.append(np.full(len(here), row))
            if at:
                ids = batch.column(0).take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.concatenate(p).astype(np.int32)), ids], names=places.names)

    by_place = given.mapInArrow(placed, places).groupBy("at", "p").agg(F.count(F.lit(1)).alias("n"), F.min("seq_id").alias("first"))
    found = by_place.groupBy("at").agg(
        (F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("mean_position"),
        F.percentile("p", F.lit(0.5), F.col("n")).alias("median_position"),
        F.min("first").alias("representative_seq_id"),
    )
    named = sequences.sparkSession.createDataFrame([(i, r.kmer, r.n_sequences) for i, r in enumerate(chosen)], "at int, kmer string, n_sequences long")
    out = found.join(F.broadcast(named), "at").select("kmer", "n_sequences", "mean_position", "median_position", "representative_seq_id")
    return out.orderBy(F.col("n_sequences").desc(), "kmer")
