"""Alignment statistics by site: residue counts, conservation, divergence between clades."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import RESIDUES, residue

PSEUDOCOUNT = 1e-6


def sites(alignment: DataFrame, sequence: str = "aligned", width: int | None = None) -> DataFrame:
    """One row a character: the alignment's other columns, ``site`` from 1 and ``aa`` (null for gaps and other letters).

    With ``width`` every row has that many sites, those beyond its end without residue.
    """
    keep = [c for c in alignment.columns if c != sequence]
    if not width:  # cut into characters once, so that a row's work grows with its length and not with its square
        long = alignment.where(F.length(sequence) >= 1).select(*keep, F.posexplode(F.split(sequence, "")).alias("site", "aa"))
        return long.select(*keep, (F.col("site") + 1).alias("site"), residue(F.col("aa")).alias("aa"))
    numbers = F.sequence(F.lit(1), F.lit(width))
    long = alignment.select(*keep, sequence, F.explode(numbers).alias("site"))
    return long.select(*keep, "site", residue(F.substr(sequence, F.col("site"), F.lit(1))).alias("aa"))


def site_counts(long: DataFrame, by: list[str] | tuple = ("hmm",), clades: DataFrame | None = None) -> DataFrame:
    """(by, [clade,] site, aa, n): residues counted by site, for each clade if ``clades(clade, tip)`` is given.

    A tip may be in several clades, and counts once in each.
    """
    keys = list(by)
    if clades is not None:
        long = long.join(clades.select("clade", "tip").distinct(), "tip")
        keys.append("clade")
    return long.where(F.col("aa").isNotNull()).groupBy(*keys, "site", "aa").agg(F.count(F.lit(1)).alias("n"))


def _uncertainty(total: Column, weighted: Column) -> Column:
    """One less the entropy in base 20, from the residues' sum n and sum n ln n."""
    return F.lit(1.0) - (F.ln(total) - weighted / total) / F.lit(math.log(len(RESIDUES)))


#: Conservation metrics by name: columns of a site's sum n and sum n ln n over its residues. Users may add their own.
METRICS: dict[str, Callable[[Column, Column], Column]] = {"inverse_shannon_uncertainty": _uncertainty}


def conservation(long: DataFrame, by: list[str] | tuple = ("hmm",), metric: str = "inverse_shannon_uncertainty") -> DataFrame:
    """(by, scope, site_1based, conservation): a metric of ``METRICS`` by site, gaps left out.

    A site without a residue has a null score. Letters outside the alphabet are left out like gaps, and do not cost the
    family its table.
    """
    if metric not in METRICS:
        raise ValueError(f"no conservation metric {metric!r}; there are {', '.join(sorted(METRICS))}")
    keys = [*by, "site"]
    counts = long.groupBy(*keys, "aa").agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("aa").isNotNull(), F.col("n"))
    # entropy = ln(N) - sum(n ln n) / N, so one aggregation will do
    sums = counts.groupBy(*keys).agg(F.sum(n).alias("total"), F.sum(n * F.ln(n)).alias("weighted"))
    return sums.select(*by, F.lit("global").alias("scope"), F.col("site").alias("site_1based"), METRICS[metric](F.col("total"), F.col("weighted")).alias("conservation"))


def divergence(a: Column, b: Column, total_a: Column, total_b: Column, pseudocount: float = PSEUDOCOUNT) -> Column:
    """One residue's term, in bits, of the relative entropy of counts a to counts b."""
    share = lambda n, total: (n + pseudocount) / (total + pseudocount * len(RESIDUES))
    return share(a, total_a) * F.log2(share(a, total_a) / share(b, total_b))


def kl_divergence(long: DataFrame, clades: DataFrame, pairs: DataFrame, by: list[str] | tuple = ("hmm",), pseudocount: float = PSEUDOCOUNT) -> DataFrame:
    """(by, pair, site_1based, kl_bits, nA, nB) for ``pairs(a, b)`` of clades.

    The clade ``background`` that no row defines stands for all tips outside the pair's other clade. Each site and pair is
    summed over all residues, those that neither clade has included. Both sides are counted in one pass: the long table
    meets the pairs once, and each residue adds to the side or sides that its tip is on.
    """
    sided = _sided(long.select("tip"), clades, pairs)
    return _divergence(long.join(sided, "tip"), long.select(*by, "site").distinct(), pairs, by, pseudocount)


def alignment_divergence(alignment: DataFrame, clades: DataFrame, pairs: DataFrame, by: list[str] | tuple = ("hmm",), pseudocount: float = PSEUDOCOUNT, sequence: str = "aligned") -> DataFrame:
    """``kl_divergence`` of an alignment's rows: sides are given to rows before they are cut into sites, so no site is shuffled by tip."""
    rows = alignment.select(*by, "tip", sequence)
    last = rows.groupBy(*by).agg(F.max(F.length(sequence)).alias("last")).where(F.col("last") >= 1)
    places = last.select(*by, F.explode(F.sequence(F.lit(1), F.col("last"))).alias("site"))
    return _divergence(sites(rows.join(_sided(rows.select("tip"), clades, pairs), "tip"), sequence), places, pairs, by, pseudocount)


def _sided(tips: DataFrame, clades: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, tip, side): on which side of which pairs the tips stand."""
    named = clades.select("clade", "tip").distinct()
    side = lambda which: pairs.join(named, F.col(which) == F.col("clade")).select("a", "b", "tip", F.lit(which).alias("side"))
    sided = side("a").unionByName(side("b"))
    rest = pairs.join(named.select(F.col("clade").alias("b")).distinct(), "b", "left_anti").where(F.col("b") == "background")
    outside = tips.distinct().join(rest, F.lit(True)).join(named.select(F.col("clade").alias("a"), "tip"), ["a", "tip"], "left_anti")
    return sided.unionByName(outside.select("a", "b", "tip", F.lit("b").alias("side")))


def _divergence(met: DataFrame, places: DataFrame, pairs: DataFrame, by: list[str] | tuple, pseudocount: float) -> DataFrame:
    """``kl_divergence`` from ``met(by, a, b, side, site, aa)`` and all ``places(by, site)``."""
    spark = met.sparkSession
    counted = met.where(F.col("aa").isNotNull()).groupBy(*by, "a", "b", "site", "aa")
    on = lambda which: F.count(F.when(F.col("side") == which, 1))
    counts = counted.agg(on("a").alias("n_a"), on("b").alias("n_b"))
    alphabet = spark.createDataFrame([(r,) for r in RESIDUES], "aa string")
    grid = places.join(F.broadcast(pairs.select("a", "b").distinct()), F.lit(True)).join(F.broadcast(alphabet), F.lit(True))
    keys = [*by, "a", "b", "site"]
    full = grid.join(counts, [*keys, "aa"], "left").fillna(0, ["n_a", "n_b"])
    totals = full.groupBy(*keys).agg(F.sum("n_a").alias("nA"), F.sum("n_b").alias("nB"), F.collect_list(F.struct("n_a", "n_b")).alias("c"))  # 20 rows a key
    term = lambda x: divergence(x["n_a"], x["n_b"], F.col("nA"), F.col("nB"), pseudocount)
    bits = F.aggregate("c", F.lit(0.0), lambda acc, x: acc + term(x))
    return totals.select(*by, F.concat_ws(":", "a", "b").alias("pair"), F.col("site").alias("site_1based"), bits.alias("kl_bits"), "nA", "nB")


def clade_pairs(clades: DataFrame, wanted: str | None = None) -> DataFrame:
    """(a, b): the pairs asked for as ``A:B,A:background``, or else all pairs of clades in the order that they come.

    A single clade is paired with ``background``; several are only paired with each other.
    """
    spark = clades.sparkSession
    if wanted:
        listed = [p.strip() for p in wanted.split(",") if p.strip()]
        if bad := [p for p in listed if ":" not in p]:
            raise ValueError(f"a pair is written A:B, not {bad[0]}")
        return spark.createDataFrame([tuple(x.strip() for x in p.split(":", 1)) for p in listed], "a string, b string")
    named = clades.groupBy("clade").agg(F.min("ord").alias("ord"))
    x, y = named.alias("x"), named.alias("y")
    two = x.join(y, F.col("x.ord") < F.col("y.ord")).select(F.col("x.clade").alias("a"), F.col("y.clade").alias("b"))
    alone = named.join(named.agg(F.count(F.lit(1)).alias("k")).where(F.col("k") == 1), F.lit(True)).select(F.col("clade").alias("a"), F.lit("background").alias("b"))
    return two.unionByName(alone)


def missing_tips(clades: DataFrame, present: DataFrame, shown: int = 10) -> DataFrame:
    """(clade, n_missing, missing): clade tips that a tree or alignment lacks, the first ``shown`` by the clades' order."""
    gone = clades.join(present.select("tip").distinct(), "tip", "left_anti")
    first = F.slice(F.array_sort(F.collect_list(F.struct("ord", "tip"))), 1, shown)
    return gone.groupBy("clade").agg(F.count(F.lit(1)).alias("n_missing"), F.transform(first, lambda t: t["tip"]).alias("missing"))
