import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brachis.llm import embeddings, queries
from tests.oracle import compare


def brute(rows, threshold):
    fit = {}
    for at, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v and None not in v and np.isfinite(v).all() and any(v):
            fit[at] = np.array(v) / np.linalg.norm(v)
    links = {a: [b for b in fit if a != b and len(fit[a]) == len(fit[b]) and fit[a] @ fit[b] >= threshold] for a in fit}
    root = {a: a for a in range(len(rows))}
    for _ in rows:
        for a, found in links.items():
            for b in found:
                low = min(root[a], root[b], key=lambda r: rows[r][0])
                root[a] = root[b] = low
    return [(v, len(links.get(a, [])), rows[root[a]][0], v is not None and v == rows[root[a]][0]) for a, (v, _) in enumerate(rows)]


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    rows = [(100 + k, v.tolist()) for k, v in enumerate(base)]
    for k in range(60):
        rows.append((1000 - k, (base[k % 7] + 0.12 * rng.normal(size=16)).tolist()))
    rows += [(50, base[3].tolist()), (51, (base[3] * 1e-100).tolist()), (51, (base[3] * 1e-100).tolist())]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [float("nan")] + [1.0] * 15), (5, [None] + [1.0] * 15), (6, [float("inf")] + [1.0] * 15), (None, base[0].tolist()), (7, [1.0, 2.0]), (8, [2.0, 4.1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("rep", F.lit("clash"))
    got = sorted(map(repr, map(tuple, embeddings.near_duplicates(table).collect())))
    assert got == sorted(map(repr, brute(rows, 0.95)))
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_component_links_in_tiles(spark):
    rng = np.random.default_rng(2)
    for noise in (0.05, 0.3):
        x = rng.normal(size=8) + noise * rng.normal(size=(50, 8))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        members = spark.createDataFrame([(1, k, 1 + k % 3, bytearray(v.astype("<f8").tobytes())) for k, v in enumerate(x)], "component long, rep long, n long, unit binary")
        n = np.array([1 + k % 3 for k in range(50)])
        near = x @ x.T >= 0.95
        marked = embeddings.with_core(members, 0.95)
        core = np.array([r.core for r in sorted(marked.collect(), key=lambda r: r.rep)])
        assert core.any() and near[np.ix_(core, core)].all()
        for table in (marked, members.withColumn("core", F.lit(False))):
            for tile, visitors in ((7, 12), (7, 1000), (1000, 20), (1000, 1000)):
                got = {r.rep: r.links for r in embeddings.component_links(table, 0.95, tile, visitors).collect()}
                assert got == {k: int(near[k] @ n - n[k]) for k in range(50)}


def test_sketches_settle_pairs_rightly():
    rng = np.random.default_rng(4)
    for d in (1, 3, 64, 300):
        x = rng.normal(size=(200, d)) * (rng.random((200, d)) < 0.5) + 1e-3
        x[100:] = x[:100] + 0.1 * rng.normal(size=(100, d))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        drawn, error = embeddings._drawn(embeddings._sketched(x))
        assert (np.linalg.norm(drawn - x, axis=1) <= error).all()
        i, j, sure = embeddings._near_pairs(drawn, error, 120, 0.95)
        dots = x @ x.T
        met = {(a, b): s for a, b, s in zip(i.tolist(), j.tolist(), sure.tolist())}
        for a in range(200):
            for b in range(max(0, a - 120), a):
                assert dots[a, b] < 0.95 if (a, b) not in met else dots[a, b] >= 0.95 or not met[a, b]


@pytest.mark.parametrize("bucket", [100_000, 150])
def test_links_do_not_depend_on_the_partitions(spark, monkeypatch, bucket):
    """Planted pairs just above the threshold, in a table without other links; in one bucket a pass, and in several."""
    monkeypatch.setattr(embeddings, "SORT_TASK", bucket)
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(rng.normal(size=(600, 48)))
    y = rng.normal(size=(600, 48))
    y = unit(y - (y * x).sum(1, keepdims=True) * x)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, 0.952 * x + math.sqrt(1 - 0.952**2) * y]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    was, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (2, 60):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append({r.vec_id: r.n_links for r in embeddings.near_duplicates(table).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert found[0] == found[1] and sum(found[0].values()) >= 0.99 * 1200


def test_passes_grow_slowly():
    assert embeddings.passes_for(100) <= embeddings.passes_for(10**5) <= embeddings.passes_for(10**9) < 100


def test_pairs_in_a_hot_cone_are_found(spark):
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    axis = unit(rng.normal(size=64))
    hot = unit(math.sqrt(0.85) * axis + math.sqrt(0.15) * unit(rng.normal(size=(16_000, 64))))
    side = rng.normal(size=(200, 64))
    side = unit(side - (side * hot[:200]).sum(1, keepdims=True) * hot[:200])
    twins = 0.955 * hot[:200] + math.sqrt(1 - 0.955**2) * side
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([hot, twins, rng.normal(size=(4_000, 64))]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r.component_id for r in embeddings.near_duplicates(table).where("vec_id < 16200").collect()}
    assert sum(got[k] == got[16_000 + k] for k in range(200)) >= 198


def test_query_equals_oracle(spark):
    assert compare(spark, "/root/testdata/sf0.001", "op4", queries.op4_embedding_dedup, queries.ORACLE_SQL["op4_embedding_dedup"]) == 500
