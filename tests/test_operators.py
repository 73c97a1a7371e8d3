import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brachis.functions import identifiers as ids
from brachis.functions import sequences as seq
from brachis.operators import ancestral, codon, embedspace, hits, members, motifs, neighbourhood, sites, taxonomy, trees

HIT = "genome string, protein string, hmm string, bitscore double, evalue double, coverage double"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_genome_key(spark):
    names = ["genome.faa", "genome.faa.gz", "genome.fna", "genome.cds.fna", "genome", "a.gz.faa", "A.FAA.GZ", None]
    rows = frame(spark, [(n,) for n in names], "g string").select(ids.genome_key(F.col("g"))).collect()
    assert [r[0] for r in rows] == ["genome"] * 5 + ["a.gz", "A", None]


def test_identifiers(spark):
    assert one(spark, *ids.split_combined(F.lit("g~p~q")), *ids.split_combined(F.lit("p"))) == ("g", "p~q", "Unknown", "p")
    assert one(spark, *ids.split_tip(F.lit("g|p|q")), *ids.split_tip(F.lit("p"))) == ("g", "p|q", "Unknown", "p")
    assert one(spark, *(ids.cds_id(F.lit("g|a|b"), m) for m in ("same", "strip_pipe", "after_last_pipe", "other"))) == ("g|a|b", "a|b", "b", "b")
    assert one(spark, ids.lineage_kind(F.lit("ANC|x")), ids.lineage_kind(F.lit("g|p"))) == ("ancestral", "modern")
    names = [c for c in one(spark, ids.cds_candidates(F.lit("g|x_1")))[0] if c is not None]
    assert names[:5] == ["x_1", "x_1", "x_1", "g|x_1", "x_1"] and names[-2:] == ["x_1_1", "x"]


def test_sequences(spark):
    assert one(spark, seq.strip_protein_stop(F.lit("M-K*L*--")), seq.strip_protein_stop(F.lit("MK--*"))) == ("M-KL", "MK")
    assert one(spark, seq.trim_cds_stop(F.lit("ATG\ntaa")), seq.trim_cds_stop(F.lit("ATGTAATAG"))) == ("ATG", "ATGTAA")
    assert one(spark, seq.motif_positions(F.lit("AAAA"), F.lit("AA")), seq.motif_positions(F.lit("A"), F.lit("AA")), seq.motif_positions(F.lit(""), F.lit("AA"))) == ([0, 1, 2], [], [])
    assert one(spark, *(seq.kmer_at(F.lit("ABCDEFGH"), F.lit(p), 5) for p in (0, 4, 7)), seq.kmer_at(F.lit("ABC"), F.lit(1), 5)) == ("ABCDE", "CDEFG", "DEFGH", "ABC")
    assert one(spark, *(seq.raw_position(F.lit(p), F.lit(10)) for p in (0, 250, 499))) == (0, 5, 9)
    got = one(spark, seq.resample(F.array(F.lit(0.0), F.lit(2.0), F.lit(1.0)), 5), seq.resample(F.array(F.lit(3.0)), 3), seq.resample(F.array().cast("array<double>"), 3))
    assert got == ([0.0, 1.0, 2.0, 1.5, 1.0], [3.0, 3.0, 3.0], None)
    assert one(spark, *(seq.residue(F.lit(c)) for c in "a-XBxW")) == ("A", None, None, None, None, "W")


def test_filter_hits(spark):
    rows = frame(spark, [("A", 100.0, 0.9), ("B", 20.0, 0.8), ("C", 50.0, 0.3), ("D", 60.0, None)], "hmm string, bitscore double, coverage double")
    assert [r.hmm for r in hits.filter_hits(rows, None, 25, 0.5).collect()] == ["A"]
    own = frame(spark, [("A", 200.0), ("B", 10.0)], "hmm string, min_score double")
    got = {r.hmm: r.min_score_required for r in hits.filter_hits(rows, own, 25, 0).collect()}
    assert got == {"B": 10.0, "C": 25.0, "D": 25.0}


def test_best_hits(spark):
    rows = frame(spark, [("g1", "p1", "hmmA", 100.0, 0.1, 0.9), ("g1", "p1", "hmmB", 80.0, 0.1, 0.9), ("g1", "p2", "hmmA", 50.0, 0.1, 0.9), ("g2", "p1", "hmmA", 9.0, 0.1, 0.5), ("g2", "p1", "hmmA", 9.0, 0.1, 0.6), (None, "p", "h", 1.0, 1.0, 1.0)], HIT)
    got = {(r.genome, r.protein): (r.hmm, r.bitscore, r.delta_bitscore) for r in hits.best_hits(rows, ("hmm", "coverage")).collect()}
    assert got == {("g1", "p1"): ("hmmA", 100.0, 20.0), ("g1", "p2"): ("hmmA", 50.0, 50.0), ("g2", "p1"): ("hmmA", 9.0, 0.0)}
    assert hits.best_hits(rows.limit(0), ("hmm",)).count() == 0


def test_plans_prune_before_the_shuffle(spark):
    rows = frame(spark, [("g", "p", "h", 1.0, 1.0, 1.0)], HIT)
    for df in (hits.best_hits(rows, ("hmm",)), hits.top_members(rows), hits.representative_hits(rows)):
        assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_membership(spark):
    rows = frame(spark, [("g1", "p1", "H", 9.0, 0.1, 0.9), ("g1", "p2", "H", 8.0, 0.1, 0.9), ("g2", "p1", "H", 7.0, 0.1, 0.9), ("g3", "p9", "H", 6.0, 0.1, 0.9)], HIT)
    proteins = frame(spark, [("g1", "p1", 0, "MK"), ("g1", "p2", 1, "ML"), ("g2", "p1", 0, ""), ("g3", "p0", 0, "MM")], "genome string, protein string, ord long, sequence string")
    assert [r.tip for r in members.members(hits.top_members(rows), proteins).collect()] == ["g1|p1"]
    assert members.members(hits.top_members(rows, keep_all=True), proteins).count() == 2
    assert [(r.genome, r.protein) for r in hits.representative_hits(rows, max_hits=2).orderBy("genome").collect()] == [("g1", "p1"), ("g2", "p1")]
    manifest = frame(spark, [("X",)], "hmm string")
    assert hits.keep_profiles(rows, manifest).count() == 0 and hits.keep_profiles(rows, None).count() == 4
    assert members.large_enough(rows, "genome", 2).select("genome").distinct().count() == 1
    first = hits.first_source_wins([rows.where("genome = 'g1'"), rows], order=("bitscore",))
    assert first.count() == 4 and first.where("src = 1").count() == 2
    assert hits.preferred(rows.limit(0), rows).first().source == "hmmsearch"
    both = members.with_ancestors(frame(spark, [("t", "M", "h")], "tip string, sequence string, hmm string"), frame(spark, [("t", "K", "h"), ("u", "L", "h")], "tip string, sequence string, hmm string"))
    assert dict((r.tip, r.sequence) for r in both.collect()) == {"t": "K", "u": "L"}


def test_lineage(spark):
    best = frame(spark, [("genomeA.faa", "p"), ("genomeB", "p"), ("genomeC.fna", "p")], "genome string, protein string")
    tax = frame(spark, [("genomeA", "TaxA"), ("genomeC", "TaxC")], "genome_key string, taxonomy string")
    assert {r.genome: r.taxonomy for r in taxonomy.with_lineage(best, tax).collect()} == {"genomeA.faa": "TaxA", "genomeB": "Unknown", "genomeC.fna": "TaxC"}


def reference_kl(p, q, eps=1e-6):
    n, m = sum(p.values()), sum(q.values())
    total = 0.0
    for r in seq.RESIDUES:
        a, b = (p.get(r, 0) + eps) / (n + 20 * eps), (q.get(r, 0) + eps) / (m + 20 * eps)
        total += a * math.log2(a / b)
    return total


def test_site_statistics(spark):
    rng = random.Random(1)
    rows = [("h", f"t{k}", "".join(rng.choice("ACDx-B") for _ in range(6))) for k in range(12)]
    long = sites.sites(frame(spark, rows, "hmm string, tip string, aligned string"))
    clades = frame(spark, [("x", f"t{k}", k) for k in range(5)] + [("y", f"t{k}", k + 5) for k in range(4, 9)], "clade string, tip string, ord long")
    count = lambda tips, s: {r: n for r in "ACD" if (n := sum(a[s] == r for _, t, a in rows if t in tips))}
    x, y = {f"t{k}" for k in range(5)}, {f"t{k}" for k in range(4, 9)}
    pairs = frame(spark, [("x", "y"), ("x", "background")], "a string, b string")
    got = {(r.pair, r.site_1based): r for r in sites.kl_divergence(long, clades, pairs).collect()}
    assert len(got) == 12
    for s in range(6):
        for name, other in (("x:y", y), ("x:background", {t for _, t, _ in rows} - x)):
            r = got[name, s + 1]
            assert r.kl_bits == pytest.approx(reference_kl(count(x, s), count(other, s)), abs=1e-9)
            assert (r.nA, r.nB) == (sum(count(x, s).values()), sum(count(other, s).values()))
    for r in sites.conservation(long).collect():
        c = count({t for _, t, _ in rows}, r.site_1based - 1)
        n = sum(c.values())
        want = 1 + sum(v / n * math.log(v / n) for v in c.values()) / math.log(20) if n else None
        assert r.conservation == (pytest.approx(want) if n else None)
    assert {(r.clade, r.n) for r in sites.site_counts(long, clades=clades).groupBy("clade").agg(F.sum("n").alias("n")).collect()} == {("x", sum(sum(count(x, s).values()) for s in range(6))), ("y", sum(sum(count(y, s).values()) for s in range(6)))}


def test_clade_pairs_and_missing(spark):
    clades = frame(spark, [("b", "t1", 0), ("a", "t2", 1), ("b", "t3", 2), ("c", "t4", 3)], "clade string, tip string, ord long")
    assert sorted(map(tuple, sites.clade_pairs(clades).collect())) == [("a", "c"), ("b", "a"), ("b", "c")]
    assert list(map(tuple, sites.clade_pairs(clades.where("clade = 'a'")).collect())) == [("a", "background")]
    assert list(map(tuple, sites.clade_pairs(clades, "a : b, c:background").collect())) == [("a", "b"), ("c", "background")]
    with pytest.raises(ValueError):
        sites.clade_pairs(clades, "ab")
    gone = {r.clade: r.missing for r in sites.missing_tips(clades, frame(spark, [("t2",)], "tip string")).collect()}
    assert gone == {"b": ["t1", "t3"], "c": ["t4"]}


def test_ancestral(spark):
    rows = [("h", "N1", s, "M", k) for k, s in enumerate(range(1, 12))] + [("h", "N1", 11, "K", 99), ("h", "N1", 13, "L", 100), ("h", "N2", 2, "A", 0)]
    got = ancestral.ancestral_sequences(frame(spark, rows, "hmm string, node string, site int, state string, ord long")).collect()
    assert [(r.tip, r.sequence) for r in got] == [("ANC|h_N1", "M" * 10 + "KXL")]


def test_cds_matching(spark):
    tips = frame(spark, [("h", t) for t in ("g|p1", "g|p2", "g|p3_1", "g|zz", "g|abc")], "hmm string, tip string")
    cds = frame(spark, [("g", n, k, "ATGTAA") for k, n in enumerate(["p1", "p2_cds", "p3", "long_abc_x", "xabc", "f|p1"])], "genome string, name string, ord long, sequence string")
    got = {r.tip: (r.cds_name, r.rank, r.cds) for r in codon.match_cds(tips, cds).collect()}
    assert {t: v[0] for t, v in got.items()} == {"g|p1": "p1", "g|p2": "p2_cds", "g|p3_1": "p3", "g|abc": "long_abc_x"}
    assert got["g|p1"][1] == 0 and got["g|abc"][1] is None and got["g|p1"][2] == "ATG"
    plan = codon.match_cds(tips, cds)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    alignment = frame(spark, [("h", t, k, "M*") for k, t in enumerate(("g|abc", "g|p2", "g|p1"))], "hmm string, tip string, ord long, aligned string")
    assert [r.tip for r in codon.codon_subset(codon.clean_alignment(alignment), codon.match_cds(tips, cds)).collect()] == ["g|abc", "g|p2", "g|p1"]


def test_motif_search(spark):
    text = "aßaaßa th" * 3
    assert seq.find_all(text, "aa") == [i for i in range(len(text)) if text.startswith("aa", i)]
    assert seq.find_all("aaa", "aa") == [0, 1] and seq.find_all("a", "aa") == [] and seq.find_all("", "a") == [] and seq.find_all("ab", "") == [0, 1, 2]
    found = one(spark, seq.motif_starts(F.lit("ßaßaß"), ["ßaß", "x", "ßaßaßa"]), seq.motif_positions(F.lit(None).cast("string"), F.lit("a")))
    assert found == ([[0, 2], [], []], None)
    long = spark.range(1).select(F.size(seq.motif_positions(F.repeat(F.lit("ath ßx th"), 120_000), F.lit("th"))))
    assert long.first()[0] == 240_000  # over a million characters


def features(spark):
    rows = [("f", k, "c1" if k < 3 else "c2", 10 * k, 10 * k + 5, 1, {"ID": [f"p{k}"], "product": [f"n{k}"]}) for k in range(6)]
    return frame(spark, rows, "file string, ord long, contig string, start int, end int, strand int, attributes map<string, array<string>>")


def test_neighbourhoods(spark):
    asked = frame(spark, [("h", "g", "p2", "f"), ("h", "g", "nope", "f")], "hmm string, genome string, protein string, file string")
    got = neighbourhood.neighbourhoods(asked, features(spark), 1).orderBy("idx").collect()
    assert [(r.protein_id, r.is_focal, r.contig) for r in got] == [("p1", False, "c1"), ("p2", True, "c1"), ("p3", False, "c2")]
    assert got[0].uid == "g|c1|p1|0" and got[0].label == "n1"
    inside = neighbourhood.neighbourhoods(asked, features(spark), 1, by_contig=True)
    assert [r.protein_id for r in inside.orderBy("idx").collect()] == ["p1", "p2"]
    drawn = neighbourhood.tracks(inside).orderBy("idx").collect()
    assert [(r.rel_start, r.rel_end, r.track_size, r.colour) for r in drawn] == [(0, 5, 16, "skyblue"), (10, 15, 16, "tomato")]
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    groups = frame(spark, [("x", 0), ("y", 1), ("z", 2)], "genome string, ord long")
    leaves = frame(spark, [("z", 0), ("x", 1), ("z", 5)], "genome string, leaf_ord int")
    assert [r.genome for r in neighbourhood.in_tree_order(groups, leaves).orderBy("place").collect()] == ["z", "x", "y"]


def test_pca_and_dispersion(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6)) + 3
    rows = frame(spark, [("h", f"g|t{k}", v.tolist()) for k, v in enumerate(x)] + [("small", "g|a", [1.0] * 6)], "hmm string, tip string, vector array<double>").repartition(3)
    fitted = embedspace.fit_pca(rows)
    model = fitted.collect()
    assert [m.hmm for m in model] == ["h"]
    c = x - x.mean(0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(model[0].explained_variance_ratio, (s**2 / (s**2).sum())[:3])
    got = {r.tip: r.pc for r in embedspace.project(rows, fitted).collect()}
    z = np.array([got[f"g|t{k}"] for k in range(40)])
    assert np.allclose(np.abs(z), np.abs(c @ vt[:3].T), atol=1e-8)
    clades = frame(spark, [("A", f"g|t{k}") for k in range(5)] + [("B", "g|t0")], "clade string, tip string")
    d = np.sqrt(((z[:5] - z[:5].mean(0)) ** 2).sum(1))
    found = embedspace.dispersion(embedspace.project(rows, fitted), clades).collect()
    assert [(r.clade, r.n) for r in found] == [("A", 5)]
    assert found[0].mean_dist_to_centroid == pytest.approx(d.mean()) and found[0].median_dist_to_centroid == pytest.approx(np.median(d))
    assert embedspace.coordinates(embedspace.project(rows, fitted), 3).columns == ["hmm", "tip", "genome", "protein", "PC1", "PC2", "PC3"]


def test_pca_of_families_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = frame(spark, [(f"h{k % 3}", f"g|{k}", rng.normal(size=4).tolist()) for k in range(120)] + [("h0", "g|null", None)], "hmm string, tip string, vector array<double>").repartition(5)
    key = lambda r: (r.hmm, r.n, np.round(r.mean, 9).tolist(), np.round(r.explained_variance_ratio, 9).tolist())
    whole = sorted(key(r) for r in embedspace.fit_pca(rows).collect())
    monkeypatch.setattr(embedspace, "MOMENT_ROWS", 7)
    assert sorted(key(r) for r in embedspace.fit_pca(rows).collect()) == whole and [w[1] for w in whole] == [40, 40, 40]


def test_density_clusters(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.2, (20, 2)) for c in ((0, 0), (5, 5), (0, 8))] + [np.array([[20.0, -20.0]])])
    found = embedspace.density_clusters(x, 5)
    assert found[60] == -1
    for k in range(3):
        part = found[20 * k : 20 * k + 20]
        assert (part == k).sum() >= 15 and set(part) <= {k, -1}
    assert (embedspace.density_clusters(x[:3], 5) == -1).all()
    assert set(embedspace.density_clusters(np.zeros((8, 2)), 5)) <= {-1, 0}
    rows = frame(spark, [("h", f"t{k}", v.tolist()) for k, v in enumerate(x)], "hmm string, tip string, vector array<double>")
    assert tuple(embedspace.cluster_counts(embedspace.cluster(rows)).first())[:2] == ("h", 3)
    # the same by tiles, beside a family that one task clusters
    both = rows.unionByName(frame(spark, [("s", f"u{k}", [float(k), 0.0]) for k in range(9)], "hmm string, tip string, vector array<double>"))
    plain = sorted(map(tuple, embedspace.cluster(both).collect()))
    for tile in (7, 16, 100):
        assert sorted(map(tuple, embedspace.cluster(both, max_family=10, tile=tile).collect())) == plain


def test_pooling(spark):
    tokens = F.array(*(F.array(F.lit(float(a)), F.lit(float(b))) for a, b in ((9, 9), (1, 2), (3, 4), (9, 9), (9, 9))))
    mask = F.array(*map(F.lit, (1, 1, 1, 1, 0)))
    assert one(spark, embedspace.mean_pool(tokens, embedspace.special_mask(mask))) == ([2.0, 3.0],)


def test_motif_scores(spark):
    rows = frame(spark, [("h", "g|a", "MKMKMKMKMKMK*"), ("h", "ANC|h_1", "AAAAAAAAAAAAA"), ("h", "s", "MK")], "hmm string, seq_id string, sequence string")
    got = sorted((r.seq_id, r.start_pos, r.end_pos, r.motif_present, r.type, r.clade_id) for r in motifs.score_motifs(rows, ["KMKMK"], frame(spark, [("g|a", "7")], "seq_id string, clade_id string")).collect())
    assert got == [("ANC|h_1", -1, -1, False, "ancestral", "")] + [("g|a", p, p + 5, True, "modern", "7") for p in (1, 3, 5, 7)]
    a = np.random.default_rng(0).random((6, 2, 7, 7))
    mean = a[2:].mean((0, 1))
    scored = frame(spark, [(a.tolist(), [0, 2], 2)], "a array<array<array<array<double>>>>, p array<int>, n int").select(motifs.motif_scores(F.col("a"), F.col("p"), F.col("n")), motifs.profiles(F.col("a"), F.lit(5))).first()
    assert scored[0] == pytest.approx(np.mean([mean[:, [1, 2]].sum() / 7, mean[:, [3, 4]].sum() / 7]))
    assert scored[1] == pytest.approx(mean[1:6, 1:6].sum(0).tolist())


def test_find_peaks():
    assert motifs.find_peaks(np.array([0.0, 1, 0, 2, 0, 0, 0, 0, 3, 3, 0]), 5, 5) == [(8, 3.0), (3, 2.0)]
    assert motifs.find_peaks(np.arange(4.0), 2) == [(3, 3.0), (2, 2.0)]


def test_discovery(spark):
    flat, bump = [1.0] * 50, [1.0] * 20 + [2.0, 5.0, 2.0] + [1.0] * 27
    rows = [(f"s{k}", k, "ACDEFGHIKL" * 5, "0", flat) for k in range(3)] + [(f"n{k}", k, "ACDEFGHIKL" * 5, "1", bump) for k in range(3)]
    found = motifs.discover_motifs(frame(spark, rows, "seq_id string, ord long, sequence string, clade_id string, profile array<double>"), "0", "1").collect()
    at = min(int(np.argmax(np.interp(np.linspace(0, 49, 500), np.arange(50), bump)) / 500 * 50), 49)
    s = "ACDEFGHIKL" * 5
    assert [(r.kmer, r.n_sequences, r.median_position, r.representative_seq_id) for r in found] == [(s[at - 2 : at + 3], 3, float(at), "n0")]


def test_trees(spark):
    text = "((a:1,b:2)ab:1,('c d':1,(e,f)[note]ef)x,g)root;"
    nodes = trees.parse_newick(text)
    assert [n[2] for n in nodes if n[3]] == ["a", "b", "c d", "e", "f", "g"]
    table = trees.tree_nodes(frame(spark, [("h", text)], "hmm string, newick string"))
    assert [r.tip for r in trees.tips(table).orderBy("leaf_ord").collect()] == ["g", "a", "b", "c d", "e", "f"]
    clades = frame(spark, [("one", "e", 0), ("one", "c d", 1), ("all", "a", 2), ("all", "f", 3), ("self", "g", 4), ("bad", "zz", 5), ("bad", "a", 6)], "clade string, tip string, ord long")
    got = {r.clade: (r.status, r.detail, r.mrca_name) for r in trees.common_ancestors(table, clades).collect()}
    assert got == {"one": ("ok", None, "x"), "all": ("ok", None, "root"), "self": ("ok", None, "g"), "bad": ("missing_tips", "zz", None)}
