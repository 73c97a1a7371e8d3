"""All eleven steps over fixture files, as the command line runs them."""

import json
import os
import stat
import warnings

import pytest

from brachis.operators import embedspace, sites
from brachis.plans import adapters, config, inputs, outputs, pipeline

STEMS = {"A": "MKMKHPEVYACDEFGHIKLMNP", "B": "MKMRHPEVYACDEFGHIKLMNP", "C": "MKLKHPEVFACDEFGHIKLWNP", "D": "MKLKHPEVFACDEYGHIKLWNP"}


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def program(folder, name, text):
    put(folder, name, "#!/bin/sh\n" + text)
    path = os.path.join(folder, name)
    os.chmod(path, os.stat(path).st_mode | stat.S_IXUSR)


@pytest.fixture
def project(tmp_path, spark, monkeypatch):
    root, out = str(tmp_path), str(tmp_path / "out")
    tips = [f"g{g}|p{g}" for g in STEMS]
    for g, s in STEMS.items():
        put(f"{root}/faa", f"g{g}.faa", f">p{g} first\n{s}\n>q{g}\nMMMMMMMMMMMM\n")
        put(f"{root}/cds", f"g{g}.fna", f">p{g}\n{'ATG' * len(s)}TAA\n")
        put(f"{root}/gff", f"g{g}.gff3", "##gff-version 3\n" + "".join(f"c1\tx\tCDS\t{10 * k + 1}\t{10 * k + 9}\t.\t+\t0\tID={'p' + g if k == 2 else f'n{k}'};product=x{k}\n" for k in range(5)))
        line = f"famX - 50 p{g} - {len(s)} 1e-9 90.0 0 1 1 1e-9 1e-9 90 0 1 {len(s)} 1 {len(s)} 1 22 0.9 x\n"
        put(f"{out}/hmmscan_tbl", f"g{g}.faa.tbl", "# comment\n" + line)
    put(f"{root}/hmm", "famX.hmm", "HMMER3/f\nNAME  famX\nLENG  22\n//\n")
    put(root, "clades.tsv", "clade_name\ttip\n" + "".join(f"{'one' if k < 2 else 'two'}\t{t.replace('|', '.faa|')}\n" for k, t in enumerate(tips)))
    put(root, "tax.tsv", "genome\tlineage\n" + "".join(f"g{g}\td__X;s__{g}\n" for g in STEMS))
    named = {t.replace("|", ".faa|"): s for t, s in zip(tips, STEMS.values())}
    put(f"{out}/alignments_clipkit", "famX.clipkit.faa", "".join(f">{t}\n{s}\n" for t, s in named.items()))
    put(f"{out}/alignments_hmm", "famX.afa", ">other\nAAAA\n")
    a, b, c, d = named
    put(f"{out}/trees_iqtree", "famX.treefile", f"(({a}:1,{b}:1)N2:1,({c}:1,{d}:1)N3:1)N1;\n")
    put(f"{out}/trees_iqtree", "famX.state", "# made\nNode\tSite\tState\n" + "".join(f"N{n}\t{k + 1}\t{x}\n" for n in (1, 2) for k, x in enumerate(STEMS["A"])))
    vectors = [("famX", t, [float(k + j % 3) for j in range(4)]) for k, t in enumerate([*named, "ANC|famX_N1", "ANC|famX_N2"])]
    spark.createDataFrame(vectors, "hmm string, tip string, vector array<double>").write.parquet(f"{root}/vectors")
    flat = [(t, [[[[1.0 + (i + 2 * j) % 5 + (t > "gB") * (j == 7) * 9 for j in range(24)] for i in range(24)]]]) for t in named]
    spark.createDataFrame(flat, "seq_id string, attention array<array<array<array<double>>>>").write.parquet(f"{root}/attention")
    bin_dir = f"{root}/bin"
    program(bin_dir, "pal2nal.pl", 'test "$3" = -output || exit 1\ncat "$2"\n')
    program(bin_dir, "hyphy", 'echo "{\\"test\\": \\"$1\\"}" > "$7"\n')
    program(bin_dir, "diamond", 'test "$1" = blastp || exit 0\ngrep -c ">" in.faa 2>/dev/null\nprintf "a\\tb\\t99.0\\t5\\t0\\t0\\t1\\t5\\t1\\t5\\t1e-9\\t80\\na\\tc\\t10.0\\t5\\t0\\t0\\t1\\t5\\t1\\t5\\t1e-9\\t80\\n"\n')
    monkeypatch.setenv(adapters.PROGRAMS, bin_dir)
    own = {
        "inputs": {"faa_dir": f"{root}/faa", "hmm_input": f"{root}/hmm", "cds_dir": f"{root}/cds", "taxonomy_file": f"{root}/tax.tsv", "vectors": f"{root}/vectors", "attention": f"{root}/attention"},
        "output": {"outdir": out},
        "phylo": {"combined_tree": True},
        "embeddings": {"enabled": True, "write_full_vectors": True, "hdbscan_min_cluster_size": 2},
        "post": {"enabled": True, "compute_conservation": True, "compute_kl": True, "clades_tsv": f"{root}/clades.tsv"},
        "synteny": {"enabled": True, "gff_dir": f"{root}/gff", "window_genes": 1},
        "codon": {"enabled": True},
        "hyphy": {"enabled": True, "hyphy_tests": "RELAX,MEME"},
        "motifs": {"enabled": True, "motif_list": ["HPEVY"]},
        "discover": {"enabled": True, "standard_clade": "0", "novel_clade": "1"},
    }
    put(root, "config.json", json.dumps(own))
    return root, out


def test_every_step_leaves_its_tables(spark, project):
    root, out = project
    pipeline.main(["--config", f"{root}/config.json"])
    assert json.load(open(f"{out}/summary/resolved_config.json"))["synteny"]["window_genes"] == 1
    read = lambda p: spark.read.csv(f"{out}/{p}", sep="\t", header=True)
    assert read("summary/hmmscan_hits.filtered.tsv").count() == 4
    assert {r.taxonomy for r in read("summary/best_hits.competitive.tsv").collect()} == {f"d__X;s__{g}" for g in STEMS}
    assert read("summary/genome_taxonomy.tsv").count() == 4
    assert read("summary/post_scikitbio/conservation.tsv").count() == 22
    assert read("summary/post_scikitbio/kl_divergence.tsv").count() == 22
    assert {(r.clade, r.status, r.mrca_name) for r in read("summary/post_scikitbio/mrca_sanity.tsv").collect()} == {("one", "ok", "N2"), ("two", "ok", "N3")}
    assert read("embeddings/pca.tsv").count() == 4 and read("embeddings/vectors.tsv").count() == 16
    assert {(r.clade, r.type) for r in read("embeddings/umap.points.tsv").collect()} == {("one", "modern"), ("two", "modern")}
    assert sorted(r.type for r in read("embeddings/combined_with_ancestors.points.tsv").collect()) == ["ancestral"] * 2 + ["modern"] * 4
    clusters = read("summary/clade_assignment.tsv")
    assert {r.hmm for r in clusters.select("hmm").distinct().collect()} == {"famX", "combined_with_ancestors"} and clusters.count() == 10
    tracks = read("synteny/tracks.tsv")
    assert tracks.count() == 12 and "place" in tracks.columns
    assert [tuple(r) for r in read("synteny/links.tsv").select("query", "target").collect()] == [("a", "b")]
    assert read("summary/motif_attention_scores.tsv").count() == 6  # four members and two ancestors
    lines = lambda p: [r.value for r in spark.read.text(f"{out}/{p}").collect()]
    assert "\n".join(lines("combined_proteomes.faa")).count(">") == 8
    assert "\n".join(lines("fasta_per_hmm/by_family")).count(">") == 4
    assert "\n".join(lines("ancestral/by_family")).count(">ANC|famX_N") == 2
    assert "\n".join(lines("codon_alignments/by_family")).count(">") == 4
    assert sorted(json.loads(x)["test"] for x in lines("summary/hyphy/selection_tests") if x) == ["MEME", "RELAX"]


def test_changed_inputs_are_not_answered_from_old_tables(spark, project):
    root, out = project
    args = ["--config", f"{root}/config.json", "--stop_after", "extract"]
    pipeline.main(args)
    put(f"{root}/faa", "gE.faa", f">pE\n{STEMS['A']}\n")
    put(f"{out}/hmmscan_tbl", "gE.faa.tbl", "famX - 50 pE - 22 1e-9 95.0 0 1 1 1e-9 1e-9 90 0 1 22 1 22 1 22 0.9 x\n")
    pipeline.main(args)
    assert spark.read.csv(f"{out}/summary/best_hits.competitive.tsv", sep="\t", header=True).count() == 5


def test_enabled_steps_without_input_are_errors(spark):
    proteins = spark.createDataFrame([("g", "p", 0, "MK")], "genome string, protein string, ord long, sequence string")
    for step, own in {"embed": {"embeddings": {"enabled": True}}, "synteny": {"synteny": {"enabled": True}}, "codon": {"codon": {"enabled": True}}, "hyphy": {"hyphy": {"enabled": True}}, "post": {"post": {"enabled": True, "compute_kl": True}}, "discover_motifs": {"discover": {"enabled": True}}}.items():
        c = config.merged(config.DEFAULTS, own | {"workflow": {"start_at": step}})
        with pytest.raises(pipeline.MissingInput, match=step):
            pipeline.run_steps(spark, c, {"proteins": proteins})
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert "members" not in pipeline.run_steps(spark, config.DEFAULTS, {"proteins": proteins})
    assert any("no hits" in str(w.message) for w in told)


def test_unknown_settings_are_named():
    assert config.unknown({"phylo": {"mafft": True, "zap": 1}, "other": {}, "synteny": {"similarity": {"method": "x", "y": 1}}}) == ["phylo.zap", "other", "synteny.similarity.y"]
    assert config.unknown(config.DEFAULTS) == []


def test_programs_that_print(spark, tmp_path, monkeypatch):
    program(str(tmp_path), "mafft", 'test "$1 $2" = "--fftns --thread" || exit 3\ntr a-z A-Z < "$5"\n')
    program(str(tmp_path), "hmmalign", 'test "$1" = --trim || exit 4\ncat "$7" > "$5"\n')
    program(str(tmp_path), "esl-reformat", 'test "$1" = afa || exit 5\ncat "$2"\n')
    program(str(tmp_path), "iqtree2", 'test "$3 $4" = "-m MFP" || exit 6\necho "(a,b,c);" > "$(echo "$@" | sed "s/.*-pre \\([^ ]*\\).*/\\1/").treefile"\n')
    program(str(tmp_path), "hmmpress", 'test "$1" = -f || exit 7\ntouch "$2.h3i"\n')
    program(str(tmp_path), "hmmscan", 'test -f all.hmm.h3i || exit 8\nawk \'/^>/ {n = substr($1, 2)} !/^>/ {print "famX - 50", n, "-", length($0), "1e-9 90.0 0 1 1 1e-9 1e-9 90 0 1", length($0), 1, length($0), "1 9 0.9 x"}\' "$6" > "$4"\n')
    program(str(tmp_path), "hmmsearch", 'test "$1 $2" = "-Z 3" || exit 9\necho "gA~pA - 22 famX - 50 1e-9 90.0 0 1 1 1e-9 1e-9 90 0 1 20 1 20 1 9 0.9 x" > "$6"\n')
    monkeypatch.setenv(adapters.PROGRAMS, str(tmp_path))
    rows = [("famX", f"g{k}|p", "mk" * 6, k) for k in range(3)]
    members = spark.createDataFrame(rows, "hmm string, tip string, sequence string, ord long")
    c = config.merged(config.DEFAULTS, {"phylo": {"mafft": True, "mafft_mode": "fftns", "skip_clipkit": True}})
    made = pipeline._phylo({"members": members}, c)
    assert [(r.tip.lower(), r.aligned) for r in made["alignment"].orderBy("ord").collect()] == [(f"g{k}|p", "MK" * 6) for k in range(3)]
    assert [tuple(r) for r in made["newick"].collect()] == [("famX", "(a,b,c);")]
    texts = spark.createDataFrame([("famX", "NAME famX\n//\n")], "hmm string, text string")
    proteins = spark.createDataFrame([("gA", "pA", 0, "MKMKMKMKMK"), ("gA", "pB", 1, "MK" * 9), ("gB", "pC", 0, "MK" * 7)], "genome string, protein string, ord long, sequence string")
    t = {"profile_texts": texts, "proteins": proteins, "members": members}
    t |= pipeline._prep(t, config.DEFAULTS)
    aligned = pipeline._phylo(t, config.merged(config.DEFAULTS, {"phylo": {"skip_clipkit": True}}))["alignment"]
    assert aligned.count() == 3
    found = pipeline._hmmer(t, config.DEFAULTS)
    assert sorted(r.protein for r in found["scan_filtered"].collect()) == ["pA", "pB", "pC"]
    assert {(r.genome, r.protein, r.hmm) for r in found["search_filtered"].collect()} == {("gA", "pA", "famX")}  # the stub answers each genome alike
    assert adapters.tree("x", "a", "p")[-2:] == ["-asr", "-quiet"] and adapters.align("--auto --x", "a")[1:3] == ["--auto", "--x"]
    assert adapters.protein_search("blast", "a")[0] == "blastp" and adapters.protein_search("mmseqs", "a")[0][1] == "easy-search"


def test_extension_points(spark, monkeypatch):
    monkeypatch.setitem(embedspace.BACKENDS, "counts", lambda settings: lambda texts: [[t.count(x) for x in "MKA"] for t in texts])
    rows = spark.createDataFrame([("h", f"g|{k}", "MK*" * k + "A") for k in range(5)], "hmm string, tip string, sequence string")
    got = {r.tip: list(r.vector) for r in embedspace.embed(rows, {"backend": "counts", "batch_size": 2}).collect()}
    assert got == {f"g|{k}": [k, k, 1] for k in range(5)}
    with pytest.raises(ValueError, match="no embedding back end"):
        embedspace.embed(rows, {"backend": "none"})
    monkeypatch.setitem(sites.METRICS, "total", lambda total, weighted: total.cast("double"))
    long = sites.sites(spark.createDataFrame([("h", "a", "MK"), ("h", "b", "M-")], "hmm string, tip string, aligned string"))
    assert {r.site_1based: r.conservation for r in sites.conservation(long, metric="total").collect()} == {1: 2.0, 2: 1.0}
    with pytest.raises(ValueError, match="no conservation metric"):
        sites.conservation(long, metric="none")


def test_bins_are_read_again(spark, tmp_path):
    put(str(tmp_path), "famX.faa", ">g1|p\nMK\n")
    put(str(tmp_path), "famY.faa", ">g2|p\nMK\n")
    put(str(tmp_path), "combined_all_hits.faa", ">g3|p\nMK\n")
    from brachis.sources import fasta

    keep = spark.createDataFrame([("famX",)], "hmm string")
    assert sorted((r.hmm, r.genome) for r in fasta.read_bins(spark, str(tmp_path)).collect()) == [("famX", "g1"), ("famY", "g2")]
    assert [r.hmm for r in fasta.read_bins(spark, str(tmp_path), keep).collect()] == ["famX"]
    assert inputs.listed(spark, str(tmp_path / "nowhere")) == [] and set(outputs.TABLES) & set(outputs.FASTAS) == set()
