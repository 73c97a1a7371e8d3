import json
import statistics

import pytest

import __spark_entry__ as entry
from brachis.plans import adapters, catalogue, config, pipeline
from brachis.streaming import hits as stream
from tests.oracle import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_catalogue_equals_oracle(spark, name):
    assert compare(spark, SMALL, name, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name]) >= 0


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_merged():
    base = {"a": 1, "b": {"c": 2, "d": 3}}
    assert config.merged(base, {"b": {"c": 99}, "e": 5}) == {"a": 1, "b": {"c": 99, "d": 3}, "e": 5}
    assert base["b"]["c"] == 2


def test_resolve(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"filtering": {"min_coverage": 0.6}, "resources": {"cpu": 3}}))
    args = config.parser().parse_args(["--config", str(tmp_path / "c.json"), "--faa_dir", "x", "--motifs", "AB, CD", "--standard-clade", "0", "--novel-clade", "1", "--start_at", "embed"])
    c = config.resolve(args, {"SLURM_CPUS_PER_TASK": "16"})
    assert (c["filtering"]["min_coverage"], c["filtering"]["global_min_score"], c["resources"]["cpu"]) == (0.6, 25.0, 16)
    assert c["motifs"]["motif_list"] == ["AB", "CD"] and c["discover"]["enabled"]
    assert config.resolve(config.parser().parse_args(["--cpu", "2"]), {"SLURM_CPUS_PER_TASK": "16"})["resources"]["cpu"] == 2
    with pytest.raises(SystemExit):
        config.validate(c)


def test_steps():
    assert len(config.STEPS) == 11
    assert config.in_range("embed") and config.in_range("embed", "embed", "embed")
    assert not config.in_range("prep", "embed") and not config.in_range("post", None, "embed")


def test_run_steps_resumes(spark, tmp_path):
    scan = spark.createDataFrame([("g", "p", "h", 90.0, 0.1, 0.9), ("g", "p", "i", 50.0, 0.1, 0.9)], "genome string, protein string, hmm string, bitscore double, evalue double, coverage double")
    proteins = spark.createDataFrame([("g", "p", 0, "MKMKMKMKMKMK")], "genome string, protein string, ord long, sequence string")
    c = config.merged(config.DEFAULTS, {"motifs": {"enabled": True, "motif_list": ["KM"]}})
    out = pipeline.run_steps(spark, c, {"scan_hits": scan, "proteins": proteins}, str(tmp_path))
    assert [(r.hmm, r.delta_bitscore, r.source) for r in out["best_hits"].collect()] == [("h", 40.0, "hmmscan")]
    assert out["members"].count() == 2 and out["motif_attention_scores"].count() == 10
    again = pipeline.run_steps(spark, c, {"proteins": proteins}, str(tmp_path))
    assert again["best_hits"].count() == 1
    other = config.merged(c, {"filtering": {"global_min_score": 60.0}})
    assert pipeline.run_steps(spark, other, {"scan_hits": scan, "proteins": proteins}, str(tmp_path))["members"].count() == 1


def test_external(spark):
    units = spark.createDataFrame([("a", "hello"), ("b", None)], "key string, text string")
    run = adapters.run_external(units, "key", {"text": "in.txt"}, lambda d: ["cp", "in.txt", "out.txt"], "out.txt")
    assert {r.key: r.output for r in run.collect()} == {"a": "hello", "b": ""}
    bad = adapters.run_external(units, "key", {"text": "in.txt"}, lambda d: ["no-such-program"], "out.txt").collect()
    assert all(r.output is None and r.error for r in bad)
    assert adapters.missing(["no-such-program", "cp"]) == ["no-such-program"]


def test_hit_stream(spark, tmp_path):
    rows = spark.createDataFrame([("g.faa", "p", "h", 90.0, 0.1, 0.9), ("g.faa", "q", "h", 5.0, 0.1, 0.9)], "genome string, protein string, hmm string, bitscore double, evalue double, coverage double")
    rows.write.parquet(str(tmp_path / "in"))
    tax = spark.createDataFrame([("g", "T")], "genome_key string, taxonomy string")
    out = stream.enriched(stream.read_hit_stream(spark, str(tmp_path / "in")), None, tax)
    stream.write_hit_stream(out, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert [(r.protein, r.taxonomy) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("p", "T")]


def test_site_queries_take_whole_texts(spark, tmp_path):
    rows = [(1, "en", "A" * 100 + "C"), (2, "de", "A" * 100 + "D" * 20), (3, "fr", "ä" * 130 + "W"), (4, "en", "")]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    kept = {(r.hmm, r.site_1based): r.conservation for r in catalogue.site_conservation(spark, str(tmp_path)).collect()}
    assert set(kept) == {(lang, s) for lang, n in (("en", 101), ("de", 120), ("fr", 131)) for s in range(1, n + 1)}
    assert kept["en", 101] == kept["fr", 131] == 1.0 and kept["fr", 130] is None
    split = {r.site: r for r in catalogue.site_divergence(spark, str(tmp_path)).collect()}
    assert set(split) == set(range(1, 132))
    assert split[100].kl_bits == 0 and split[101].kl_bits > 10 and (split[110].na, split[110].nb, split[131].na) == (0, 1, 0)


def test_kmers_of_whole_texts(spark, tmp_path):
    texts = [(7, "x" * 60 + "hello hello"), (3, "y" * 90 + "hello"), (3, "hello"), (9, "hell"), (4, "z" * 5 + "äöü€𐍈hello"), (8, None), (None, "hello")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    places = [(t[p : p + 5], p + 1, d) for d, t in texts if t for p in range(len(t) - 4)]
    want = {}
    for kmer in {x for x, *_ in places}:
        at, ids = [p for x, p, _ in places if x == kmer], {d for x, _, d in places if x == kmer} - {None}
        want[kmer] = (len(ids), pytest.approx(sum(at) / len(at), abs=1e-6), statistics.median(at), min(ids, default=None))
    top = sorted(want, key=lambda x: (-want[x][0], x.encode()))[:50]
    got = catalogue.kmers(spark, str(tmp_path)).collect()
    assert [r.kmer for r in got] == top and top[0] == "hello" and len(top) < 50
    assert {r.kmer: (r.n_sequences, r.mean_p, r.med, r.rep) for r in got} == {x: want[x] for x in top}
