"""Embedding space: pooling, principal components, clusters, dispersion.

Vectors are arrays of numbers. Components are fitted from moments summed over any number of tasks, so a family of any size
is never gathered. Clustering compares all pairs: a small family in one task, a large one tile against tile, whose spanning
forests are merged; only the one tree of a family, as many edges as it has members, is one task's work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import lineage_kind, split_tip
from ..functions.sequences import for_embedding

#: Members of a family that one task clusters by itself, and of a tile of a larger one.
MAX_FAMILY = 20_000
TILE = 4_000
#: Rows of a family whose moments one task sums.
MOMENT_ROWS = 50_000


#: Embedding back ends by name: of the settings, a function of a list of cleaned sequences that gives a matrix of vectors.
#: Models are not part of this library, so users register theirs; a task calls it once and then batch by batch.
BACKENDS: dict[str, Callable[[dict], Callable[[list[str]], np.ndarray]]] = {}


def embed(rows: DataFrame, settings: dict) -> DataFrame:
    """(hmm, tip, vector) of ``rows(hmm, tip, sequence)`` by the back end that the settings name."""
    name, size = settings["backend"], int(settings.get("batch_size", 8))
    if name not in BACKENDS:
        raise ValueError(f"no embedding back end {name!r} is registered; give vectors instead, or add one to BACKENDS")
    make = BACKENDS[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = None
        for batch in batches:
            vectors = vectors or make(settings)
            found = [v for lo in range(0, len(batch), size) for v in np.asarray(vectors(batch["sequence"].iloc[lo : lo + size].tolist()), np.float32).tolist()]
            yield pd.DataFrame({"hmm": batch["hmm"], "tip": batch["tip"], "vector": found})

    cleaned = rows.select("hmm", "tip", for_embedding(F.col("sequence")).alias("sequence"))
    return cleaned.mapInPandas(run, "hmm string, tip string, vector array<float>")


def mean_pool(tokens: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask is 1, over at least one; ``tokens`` is an array of arrays."""
    dims = F.size(F.get(tokens, F.lit(0)))
    kept = F.transform(F.filter(F.arrays_zip(tokens.alias("t"), mask.alias("m")), lambda x: x["m"] == 1), lambda x: x["t"])
    return F.transform(F.sequence(F.lit(0), dims - 1), lambda j: F.aggregate(kept, F.lit(0.0), lambda acc, v: acc + F.get(v, j)) / F.greatest(F.lit(1), F.size(kept)))


def special_mask(attention: Column, first: int = 1, last: int = 1) -> Column:
    """An attention mask without its ``first`` and ``last`` real tokens (such as begin and end marks)."""
    n = F.aggregate(attention, F.lit(0), lambda acc, x: acc + x.cast("int"))
    return F.transform(attention, lambda x, i: F.when((i >= first) & (i < n - last), x).otherwise(F.lit(0)))


def n_components(wanted: int, dims: int, rows: int) -> int:
    return min(max(2, wanted), dims, max(2, rows - 1))


def _moments(by: str):
    """Sums of each family's rows and of their outer products, the rows of a family being together: one at a time is held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n, total, square = None, 0, 0.0, 0.0
        row = lambda: pd.DataFrame([(key, n, total.tolist(), square.ravel().tolist())], columns=[by, "n", "total", "square"])
        for batch in batches:
            for name, part in batch.groupby(by, dropna=False, sort=False):
                if n and name != key:
                    yield row()
                    n, total, square = 0, 0.0, 0.0
                x = np.array(part["vector"].tolist(), np.float64)
                key, n, total, square = name, n + len(x), total + x.sum(0), square + x.T @ x
        if n:
            yield row()

    return run


def fit_pca(vectors: DataFrame, components: int = 3, by: str = "hmm", least: int = 3) -> DataFrame:
    """(by, n, mean, axes, explained_variance_ratio) of each family's ``vectors(by, vector)``, of at least ``least`` rows.

    Axes are unit vectors by falling variance, each with its largest loading positive.
    """
    kind = vectors.schema[by].dataType
    double = T.ArrayType(T.DoubleType())
    partial = T.StructType([T.StructField(by, kind), T.StructField("n", T.LongType()), T.StructField("total", double), T.StructField("square", double)])
    rows = vectors.select(by, F.col("vector").cast("array<double>").alias("vector")).dropna()
    # a family's rows come together, large ones in several parts, so that there are few matrices and not one a batch
    sizes = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / MOMENT_ROWS).cast("int").alias("_parts"))
    dealt = rows.join(sizes, by).withColumn("_part", F.pmod(F.xxhash64("vector"), F.col("_parts").cast("long")))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = dealt.repartition(parts, by, "_part").sortWithinPartitions(by, "_part").select(by, "vector").mapInPandas(_moments(by), partial)

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        n = int(part["n"].sum())
        if n < least:
            return pd.DataFrame(columns=[by, "n", "mean", "axes", "explained_variance_ratio"])
        total = np.sum([np.array(x) for x in part["total"]], axis=0)
        d = len(total)
        mean = total / n
        cov = np.sum([np.array(x) for x in part["square"]], axis=0).reshape(d, d) / n - np.outer(mean, mean)
        values, axes = np.linalg.eigh(cov)
        k = n_components(components, d, n)
        values, axes = np.maximum(values[::-1], 0), axes[:, ::-1].T[:k]
        axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(1)[:, None], 1) < 0, -1, 1)
        share = values[:k] / values.sum() if values.sum() > 0 else np.zeros(k)
        return pd.DataFrame([(part[by].iloc[0], n, mean.tolist(), axes.tolist(), share.tolist())], columns=[by, "n", "mean", "axes", "explained_variance_ratio"])

    fitted = T.StructType([T.StructField(by, kind), T.StructField("n", T.LongType()), T.StructField("mean", double), T.StructField("axes", T.ArrayType(double)), T.StructField("explained_variance_ratio", double)])
    return sums.groupBy(by).applyInPandas(solve, fitted)  # one row a task and family


def project(vectors: DataFrame, fitted: DataFrame, by: str = "hmm") -> DataFrame:
    """``vectors`` with ``pc``, the coordinates along the fitted axes from the mean; families without axes are left out."""
    centred = F.zip_with("vector", "mean", lambda v, m: v.cast("double") - m)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    met = vectors.join(fitted.select(by, "mean", "axes"), by).withColumn("_c", centred)
    return met.withColumn("pc", F.transform("axes", lambda axis: dot(F.col("_c"), axis))).drop("mean", "axes", "_c")


def coordinates(rows: DataFrame, k: int, source: str = "pc", prefix: str = "PC") -> DataFrame:
    """Array coordinates as columns PC1..PCk, with genome and protein from the tip."""
    genome, protein = split_tip(F.col("tip"))
    keep = [c for c in rows.columns if c not in {source, "vector", "genome", "protein"}]
    return rows.select(*keep, genome.alias("genome"), protein.alias("protein"), *(F.get(source, F.lit(j)).alias(f"{prefix}{j + 1}") for j in range(k)))


def layout_2d(vectors: DataFrame, by: str = "hmm") -> DataFrame:
    """A plane layout: the first two principal components, under the names of a manifold layout, which needs a library."""
    placed = project(vectors, fit_pca(vectors, 2, by), by)
    return coordinates(placed, 2, prefix="UMAP")


def plot_points(layout: DataFrame, clusters: DataFrame | None = None, clades: DataFrame | None = None) -> DataFrame:
    """What a drawing of a layout needs: each point's coordinates, its cluster, its clades and whether it is an ancestor.

    ``clusters(hmm, tip, cluster_id)``; a point without a cluster has none, and one in several clades has them comma-joined.
    """
    out = layout.withColumn("type", lineage_kind(F.col("tip")))
    if clusters is not None:
        out = out.join(clusters.select("hmm", "tip", "cluster_id"), ["hmm", "tip"], "left")
    if clades is not None:
        named = clades.groupBy("tip").agg(F.array_join(F.array_sort(F.collect_set("clade")), ",").alias("clade"))
        out = out.join(named, "tip", "left")
    return out


def dispersion(points: DataFrame, clades: DataFrame, by: str = "hmm", vector: str = "pc", least: int = 3) -> DataFrame:
    """(by, clade, n, mean_dist_to_centroid, median_dist_to_centroid) of clades with at least ``least`` points.

    ``clades(clade, tip)``: a tip counts in each of its clades. The centroid is summed over tasks, so no clade is gathered.
    """
    inside = points.select(by, "tip", F.col(vector).alias("v")).join(clades.select("clade", "tip").distinct(), "tip")
    dense = array_to_vector(F.col("v").cast("array<double>"))
    centre = inside.groupBy(by, "clade").agg(vector_to_array(Summarizer.mean(dense)).alias("c"))
    square = F.zip_with("v", "c", lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    far = inside.join(centre, [by, "clade"]).withColumn("d", F.sqrt(F.aggregate(square, F.lit(0.0), lambda acc, x: acc + x)))
    out = far.groupBy(by, "clade").agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean_dist_to_centroid"), F.median("d").alias("median_dist_to_centroid"))
    return out.where(F.col("n") >= least)


def _spanning_tree(x: np.ndarray, core: np.ndarray, side: np.ndarray | None = None) -> np.ndarray:
    """Edges (a, b, weight) of a minimum spanning tree of mutual reachability distances, by weight; with ``side`` only edges
    between the two sides count."""
    n = len(x)
    best, source, inside = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, bool)
    edges, at = np.empty((max(n - 1, 0), 3)), 0
    for k in range(n - 1):
        inside[at] = True
        reach = np.maximum(np.maximum(np.sqrt(((x - x[at]) ** 2).sum(1)), core), core[at])
        closer = ~inside & (reach < best)
        if side is not None:
            closer &= side != side[at]
        best[closer], source[closer] = reach[closer], at
        nearest = int(np.where(inside, np.inf, best).argmin())
        edges[k] = source[nearest], nearest, best[nearest]
        at = nearest
    return edges[np.argsort(edges[:, 2], kind="stable")]


def _spanning_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the edges of a minimum spanning forest, by weight, then ends."""
    up: dict[int, int] = {}
    kept = []
    for k in np.lexsort((b, a, weight)).tolist():
        roots = []
        for v in (int(a[k]), int(b[k])):
            while (w := up.get(v, v)) != v:
                up[v] = up.get(w, w)
                v = up[v]
            roots.append(v)
        if roots[0] != roots[1]:
            up[roots[0]] = roots[1]
            kept.append(k)
    return np.array(kept, np.int64)


def density_clusters(x: np.ndarray, min_cluster_size: int = 5, min_samples: int | None = None) -> np.ndarray:
    """Hierarchical density clusters by excess of mass, numbered from 0 in order of their first point; -1 is noise.

    The core distance is to the ``min_samples``-th nearest point, the point itself counted.
    """
    n, k = len(x), min_samples or min_cluster_size
    labels = np.full(n, -1)
    if n < max(2, min_cluster_size, k):
        return labels
    core = np.array([np.partition(np.sqrt(((x - p) ** 2).sum(1)), k - 1)[k - 1] for p in x])
    return tree_clusters(_spanning_tree(x, core), n, min_cluster_size)


def tree_clusters(tree: np.ndarray, n: int, min_cluster_size: int = 5) -> np.ndarray:
    """``density_clusters`` of n points from the edges (a, b, weight) of their spanning tree, by weight."""
    labels = np.full(n, -1)
    # the merge tree: nodes below n are points, node n + i is made by the i-th edge
    up, left, right, height, size = list(range(2 * n - 1)), {}, {}, {}, [1] * n + [0] * (n - 1)
    for i, (a, b, w) in enumerate(tree):
        roots = []
        for v in (int(a), int(b)):
            while up[v] != v:
                up[v] = up[up[v]]
                v = up[v]
            roots.append(v)
        node = n + i
        up[roots[0]] = up[roots[1]] = node
        left[node], right[node], height[node], size[node] = roots[0], roots[1], w, size[roots[0]] + size[roots[1]]

    def points(node: int) -> list[int]:
        found, stack = [], [node]
        while stack:
            v = stack.pop()
            if v < n:
                found.append(v)
            else:
                stack += [left[v], right[v]]
        return found

    # condense: a split into two large enough parts makes clusters, smaller parts fall out of theirs
    density = lambda w: 1 / w if w > 0 else np.inf
    born, parent, stability, members, children = [0.0], [-1], [0.0], [[]], [[]]
    stack = [(2 * n - 2, 0)]
    while stack:
        node, cluster = stack.pop()
        if node < n:
            members[cluster].append(node)
            continue
        level = density(height[node])
        parts = left[node], right[node]
        large = [p for p in parts if size[p] >= min_cluster_size]
        gain = level - born[cluster] if np.isfinite(level) else 0.0
        if len(large) == 2:
            stability[cluster] += gain * size[node]
            for p in parts:
                born.append(level), parent.append(cluster), stability.append(0.0), members.append([]), children.append([])
                children[cluster].append(len(born) - 1)
                stack.append((p, len(born) - 1))
            continue
        for p in parts:
            if p in large:
                stack.append((p, cluster))
            else:
                fallen = points(p)
                stability[cluster] += gain * len(fallen)
                members[cluster] += fallen
    # choose: a cluster stands if it is at least as stable as the best below it; the root never does
    best, chosen = list(stability), set()
    for c in range(len(born) - 1, 0, -1):
        below = sum(best[d] for d in children[c])
        if children[c] and below > stability[c]:
            best[c] = below
        else:
            chosen.add(c)
    found = []
    for c in sorted(chosen):
        a = parent[c]
        while a > 0 and a not in chosen:
            a = parent[a]
        if a <= 0:
            stack, own = [c], []
            while stack:
                d = stack.pop()
                own += members[d]
                stack += children[d]
            found.append(sorted(own))
    for number, own in enumerate(sorted(found)):
        labels[own] = number
    return labels


def cluster(vectors: DataFrame, min_cluster_size: int = 5, by: str = "hmm", max_family: int = MAX_FAMILY, tile: int = TILE) -> DataFrame:
    """(by, tip, cluster_id) of each family's ``vectors(by, tip, vector)``; families of over ``max_family`` rows by tiles.

    Both ways give the same clusters but where distances tie.
    """
    kind = vectors.schema[by].dataType
    schema = T.StructType([T.StructField(by, kind), T.StructField("tip", T.StringType()), T.StructField("cluster_id", T.IntegerType())])
    rows = vectors.select(by, F.col("tip").cast("string").alias("tip"), F.col("vector").cast("array<double>").alias("vector"))
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > max_family)
    small = rows.join(large, by, "left_anti") if (counted := large.agg(F.max("_n")).first()[0]) else rows

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("tip")
        found = density_clusters(np.array(part["vector"].tolist(), np.float64), min_cluster_size)
        return pd.DataFrame({by: part[by], "tip": part["tip"], "cluster_id": found.astype(np.int32)})

    out = small.groupBy(by).applyInPandas(run, schema)
    return out.unionByName(_tiled_clusters(rows.join(large, by, "left_semi"), min_cluster_size, by, tile, counted)) if counted else out


def _tiled_clusters(rows: DataFrame, min_cluster_size: int, by: str, tile: int, largest: int) -> DataFrame:
    """``cluster`` of large families: nearest neighbours and spanning forests by pairs of tiles, merged two by two."""
    kind = rows.schema[by].dataType
    field = lambda name, t: T.StructField(name, t)
    place = F.row_number().over(Window.partitionBy(by).orderBy("tip")) - 1
    numbered = rows.select(by, "tip").withColumn("i", place.cast("long"))  # ids alone are numbered
    points = rows.join(numbered, [by, "tip"])
    home, tiles = F.floor(F.col("i") / tile), -(-largest // tile)

    def paired(table: DataFrame) -> DataFrame:
        """Every point with every tile of its family."""
        last = table.groupBy(by).agg(F.max(home).alias("_last"))
        met = table.join(F.broadcast(last), by).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
        return met.withColumns({"lo": F.least(home, "_o"), "hi": F.greatest(home, "_o"), "own": home}).drop("_o", "_last")

    def near(part: pd.DataFrame) -> pd.DataFrame:
        x, i, low = np.array(part["vector"].tolist()), part["i"].to_numpy(), (part["own"] == part["lo"]).to_numpy()
        sides = [(low, low)] if part["lo"].iloc[0] == part["hi"].iloc[0] else [(low, ~low), (~low, low)]
        found = []
        for a, b in sides:
            other, k = x[b], min(min_cluster_size, int(b.sum()))
            found += [(j, np.sort(np.partition(np.sqrt(((other - p) ** 2).sum(1)), k - 1)[:k]).tolist()) for j, p in zip(i[a].tolist(), x[a])]
        return pd.DataFrame([(part[by].iloc[0], *f) for f in found], columns=[by, "i", "near"])

    near_schema = T.StructType([field(by, kind), field("i", T.LongType()), field("near", T.ArrayType(T.DoubleType()))])
    listed = paired(points).select(by, "lo", "hi", "own", "i", "vector").groupBy(by, "lo", "hi").applyInPandas(near, near_schema)
    core = listed.groupBy(by, "i").agg(F.get(F.array_sort(F.flatten(F.collect_list("near"))), F.lit(min_cluster_size - 1)).alias("core"))
    edge_schema = T.StructType([field(by, kind), field("lo", T.LongType()), field("hi", T.LongType()), field("a", T.LongType()), field("b", T.LongType()), field("weight", T.DoubleType())])

    def frame(part: pd.DataFrame, a, b, weight) -> pd.DataFrame:
        return pd.DataFrame({by: part[by].iloc[0], "lo": part["lo"].iloc[0], "hi": part["hi"].iloc[0], "a": a, "b": b, "weight": weight}, columns=edge_schema.names)

    def spanned(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("i")
        x, i, one = np.array(part["vector"].tolist()), part["i"].to_numpy(), part["lo"].iloc[0] == part["hi"].iloc[0]
        edges = _spanning_tree(x, part["core"].to_numpy(), None if one else (part["own"] == part["lo"]).to_numpy())
        ends = np.sort(i[edges[:, :2].astype(np.int64)], axis=1)
        return frame(part, ends[:, 0], ends[:, 1], edges[:, 2])

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        a, b, w = (part[c].to_numpy() for c in ("a", "b", "weight"))
        kept = _spanning_forest(a, b, w)
        return frame(part, a[kept], b[kept], w[kept])

    edges = paired(points.join(core, [by, "i"])).select(by, "lo", "hi", "own", "i", "vector", "core").groupBy(by, "lo", "hi").applyInPandas(spanned, edge_schema)
    while tiles > 1:  # four pairs of tiles become one of tiles twice as large, with half as many edges
        tiles = -(-tiles // 2)
        edges = edges.withColumns({"lo": F.floor(F.col("lo") / 2), "hi": F.floor(F.col("hi") / 2)}).groupBy(by, "lo", "hi").applyInPandas(merged, edge_schema)

    def label(part: pd.DataFrame) -> pd.DataFrame:
        tree = part.sort_values(["weight", "a", "b"])[["a", "b", "weight"]].to_numpy(np.float64)
        found = tree_clusters(tree, len(tree) + 1, min_cluster_size)
        return pd.DataFrame({by: part[by].iloc[0], "i": np.arange(len(found)), "cluster_id": found.astype(np.int32)})

    labelled = edges.groupBy(by).applyInPandas(label, T.StructType([field(by, kind), field("i", T.LongType()), field("cluster_id", T.IntegerType())]))
    return numbered.join(labelled, [by, "i"]).select(by, "tip", "cluster_id")


def cluster_counts(assigned: DataFrame, by: str = "hmm") -> DataFrame:
    """(by, n_clusters, n_noise)."""
    return assigned.groupBy(by).agg(F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("n_clusters"), F.count_if(F.col("cluster_id") == -1).alias("n_noise"))


def assignments(assigned: DataFrame, taxonomy: DataFrame | None = None) -> DataFrame:
    """(hmm, tip, protein, genome, cluster_id, taxonomy, type): the table of clusters, keyed by the whole tip."""
    from .taxonomy import with_lineage

    genome, protein = split_tip(F.col("tip"))
    rows = assigned.select("hmm", "tip", protein.alias("protein"), genome.alias("genome"), "cluster_id", lineage_kind(F.col("tip")).alias("type"))
    return with_lineage(rows, taxonomy) if taxonomy is not None else rows.withColumn("taxonomy", F.lit(""))
