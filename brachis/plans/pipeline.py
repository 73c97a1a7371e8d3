"""The steps over tables: each step is a function of named tables, kept as Parquet under a key of settings and inputs.

Models and external programs are absent from the plan: their results (domain tables, vectors, alignments, trees, states,
attention) are inputs by name, whatever made them. Where such a table is missing and the program is installed, the step
runs it (see ``adapters``); a step that is enabled and can get its input in neither way is an error.
"""

from __future__ import annotations

import hashlib
import json
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import genome_key
from ..operators import ancestral, codon, embedspace, hits, members, motifs, neighbourhood, sites, taxonomy, trees
from ..sources import fasta
from ..sources.files import stem
from . import adapters
from .config import STEPS, in_range

Tables = dict[str, DataFrame]


class MissingInput(SystemExit):
    """An enabled step has no way to its input."""


def _need(t: Tables, step: str, *names: str) -> None:
    if gone := [n for n in names if n not in t]:
        raise MissingInput(f"step {step} is enabled and needs {', '.join(gone)}")


def _report(made: DataFrame, step: str) -> DataFrame:
    """What a program made; units that failed are told and left out."""
    made = made.persist()
    if bad := made.where(F.col("output").isNull()).limit(3).collect():
        warnings.warn(f"{step}: " + "; ".join(f"{r[0]}: {r['error']}" for r in bad), stacklevel=2)
    return made.where(F.col("output").isNotNull()).drop("error")


def _as_fasta(rows: DataFrame, by: list[str], name: str, sequence: str, order: str = "ord", out: str = "text") -> DataFrame:
    """(by, text): each group's records as one text, a unit of a program; a group has to fit in one row."""
    record = F.struct(F.col(order), fasta.fasta_record(F.col(name), F.col(sequence)).alias("r"))
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(record)), lambda x: x["r"]), "\n").alias(out))


def _records(made: DataFrame, key: str = "hmm", name: str = "tip", sequence: str = "aligned") -> DataFrame:
    """(key, name, ord, sequence) of texts in FASTA."""
    cut = made.select(key, F.posexplode(F.split(F.regexp_replace("output", r"^>", ""), r"\n>")).alias("ord", "record")).where(F.trim("record") != "")
    text = F.regexp_replace(F.regexp_replace("record", r"^[^\n]*\n?", ""), r"\s+", "")
    return cut.select(key, F.regexp_extract("record", r"^\s*(\S+)", 1).alias(name), F.col("ord").cast("long").alias("ord"), text.alias(sequence))


def _prep(t: Tables, c: dict) -> Tables:
    out = {"combined": fasta.combined_proteome(t["proteins"])}
    if "profile_texts" in t:
        out["combined_profiles"] = t["profile_texts"].select("hmm", F.col("text").alias("profile"))
    return out


def _searched(t: Tables, name: str) -> DataFrame | None:
    """Raw hits by running the search, one unit a genome, against the combined profiles; None if it is not installed.

    The number of all proteins is passed on, so that e-values do not depend on how the work is dealt.
    """
    program = "hmmscan" if name == "scan" else "hmmsearch"
    if "combined_profiles" not in t or adapters.missing([program, "hmmpress"][: 2 if name == "scan" else 1]):
        return None
    profiles = t["combined_profiles"].agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("hmm", "profile"))), lambda x: x["profile"]), "").alias("profiles"))
    named = t["proteins"].withColumn("name", F.col("protein") if name == "scan" else F.concat("genome", F.lit("~"), "protein"))
    units = _as_fasta(named, ["genome"], "name", "sequence").join(F.broadcast(profiles), F.lit(True))  # one row of profiles
    if name == "scan":
        command = lambda d: adapters.profile_scan("all.hmm", "all.faa", "out.tbl")
    else:
        n = t["proteins"].count()
        command = lambda d: [program, "-Z", str(n), *adapters.profile_search(program, "all.hmm", "all.faa", "out.tbl")[1:]]
    made = _report(adapters.run_external(units, "genome", {"text": "all.faa", "profiles": "all.hmm"}, command, "out.tbl"), program)
    from ..sources.tables import parse_domains

    raw = parse_domains(made.select(F.col("genome").alias("file"), F.explode(F.split("output", "\n")).alias("value")))
    return hits.scan_hits(raw, F.col("file")) if name == "scan" else hits.search_hits(raw)


def _hmmer(t: Tables, c: dict) -> Tables:
    f = c["filtering"]
    out: Tables = {}
    for name in ("scan", "search"):
        if not c["hmmer"][f"run_{name}"]:
            continue
        raw = t[f"{name}_hits"] if f"{name}_hits" in t else _searched(t, name)
        if raw is not None:
            rows = hits.keep_profiles(raw, t.get("manifest"))
            out[f"{name}_filtered"] = hits.filter_hits(rows, t.get("thresholds"), f["global_min_score"], f["min_coverage"])
    if not out:
        warnings.warn("hmmer: no domain tables and no search program, so there are no hits", stacklevel=2)
        return out
    none = next(iter(out.values())).limit(0)
    best = hits.best_hits(hits.preferred(out.get("scan_filtered", none), out.get("search_filtered", none)), ("hmm", "evalue", "coverage"))
    if "taxonomy" in t:
        out = {n: taxonomy.with_lineage(rows, t["taxonomy"]) for n, rows in out.items()}
        best = taxonomy.with_lineage(best, t["taxonomy"])
    return out | {"best_hits": best}


def _filtered(t: Tables) -> DataFrame | None:
    scan, search = t.get("scan_filtered"), t.get("search_filtered")
    return hits.preferred(scan, search) if scan is not None and search is not None else scan if scan is not None else search


def _extract(t: Tables, c: dict) -> Tables:
    found = _filtered(t)
    if found is None:
        warnings.warn("extract: no hits, so there are no members", stacklevel=2)
        return {}
    top = hits.top_members(found, c["phylo"]["keep_all_hits"], ("protein", "evalue", "coverage"))
    return {"members": members.members(top, t["proteins"])}


def _space(rows: DataFrame, t: Tables, c: dict) -> Tables:
    """Components, layout, dispersion and clusters of ``rows(hmm, tip, vector)``."""
    e = c["embeddings"]
    fitted = embedspace.fit_pca(rows, e["pca_components"])
    points = embedspace.project(rows, fitted)
    pcs = embedspace.coordinates(points, e["pca_components"])
    out = {"pca_model": fitted, "pca": pcs, "layout": embedspace.layout_2d(rows)}
    if "clades" in t:
        out["dispersion"] = embedspace.dispersion(points, t["clades"])
    if e["cluster_embeddings"]:
        out["clade_assignment"] = embedspace.assignments(embedspace.cluster(rows, e["hdbscan_min_cluster_size"]), t.get("taxonomy"))
    out["plot"] = embedspace.plot_points(out["layout"], out.get("clade_assignment"), t.get("clades"))
    return out


def _embed(t: Tables, c: dict) -> Tables:
    e = c["embeddings"]
    if not e["enabled"]:
        return {}
    if "vectors" in t:
        vectors = t["vectors"]
    elif e["backend"] in embedspace.BACKENDS and "members" in t:
        vectors = embedspace.embed(t["members"], e)
    else:
        raise MissingInput("step embed is enabled and needs vectors, or members and a registered back end")
    vectors = vectors.where(~F.col("tip").startswith("ANC|"))  # ancestors join the combined space after phylo
    out = _space(members.large_enough(vectors), t, c) | {"family_vectors": vectors}
    if e["write_full_vectors"]:
        out["vectors_long"] = vectors.select("hmm", "tip", F.posexplode("vector").alias("dim", "value"))
    return out


def _combined_space(t: Tables, ancestors: DataFrame | None, c: dict) -> Tables:
    """The space of all members and their ancestors as one family, its clusters appended to those by family."""
    e = c["embeddings"]
    if not e["enabled"] or ancestors is None or "family_vectors" not in t:
        return {}
    label = F.lit("combined_with_ancestors")
    modern = t["family_vectors"].groupBy("tip").agg(F.min_by("vector", "hmm").alias("vector"))
    if "vectors" in t:
        old = t["vectors"].where(F.col("tip").startswith("ANC|")).select("tip", "vector")
    else:
        old = embedspace.embed(ancestors.select("hmm", "tip", "sequence"), e).select("tip", "vector")
    rows = members.large_enough(modern.unionByName(old).select(label.alias("hmm"), "tip", "vector"))
    out = {f"combined_{name}": table for name, table in _space(rows, t, c).items()}
    if "combined_clade_assignment" in out and "clade_assignment" in t:
        out["clade_assignment"] = t["clade_assignment"].unionByName(out["combined_clade_assignment"], allowMissingColumns=True)
    return out


def _aligned(t: Tables, c: dict) -> DataFrame | None:
    """(hmm, tip, ord, aligned) by running aligners, one unit a family; None if they are not installed."""
    p, threads = c["phylo"], max(1, min(4, c["resources"]["cpu"] // 2))
    by_profile = not p["mafft"] and not p["mafft_for_tree"]
    programs = ["hmmalign", "esl-reformat"] if by_profile else ["mafft"]
    if "members" not in t or adapters.missing(programs) or (by_profile and "combined_profiles" not in t):
        return None
    units = _as_fasta(t["members"].where(F.col("sequence") != ""), ["hmm"], "tip", "sequence")
    if by_profile:
        units = units.join(t["combined_profiles"], "hmm")
        made = adapters.run_external(units, "hmm", {"text": "all.faa", "profile": "one.hmm"}, lambda d: adapters.profile_align("one.hmm", "all.faa", not p["no_trim_hmmalign"]))
    else:
        made = adapters.run_external(units, "hmm", {"text": "all.faa"}, lambda d: adapters.align(p["mafft_mode"], "all.faa", threads))
    made = _report(made, programs[0])
    if not p["skip_clipkit"] and not adapters.missing(["clipkit"]):
        made = _report(adapters.run_external(made.withColumnRenamed("output", "text"), "hmm", {"text": "all.afa"}, lambda d: adapters.trim("all.afa", "cut.afa"), "cut.afa"), "clipkit")
    return _records(made)


def _trees(alignment: DataFrame, c: dict) -> DataFrame | None:
    """(hmm, newick) by running the tree program on families of three tips or more; None if it is not installed."""
    p, threads = c["phylo"], max(1, min(4, c["resources"]["cpu"] // 2))
    program = next((x for x in dict.fromkeys([p["iqtree_bin"], "iqtree", "iqtree2", "iqtree3"]) if not adapters.missing([x])), None)
    if program is None:
        return None
    units = _as_fasta(members.large_enough(alignment), ["hmm"], "tip", "aligned")
    made = adapters.run_external(units, "hmm", {"text": "in.afa"}, lambda d: adapters.tree(program, "in.afa", "out", p["iq_boot"], threads, not p["no_asr"]), "out.treefile")
    return _report(made, program).select("hmm", F.regexp_replace("output", r"^\s+|\s+$", "").alias("newick"))


def _phylo(t: Tables, c: dict) -> Tables:
    out: Tables = {}
    if "alignment" not in t and (made := _aligned(t, c)) is not None:
        out["alignment"] = made
    if "newick" in t:
        out["tree_nodes"] = trees.tree_nodes(t["newick"])
    elif "alignment" in out and (newick := _trees(out["alignment"], c)) is not None:
        out["newick"], out["tree_nodes"] = newick, trees.tree_nodes(newick)
    if "states" in t and not c["phylo"]["no_asr"]:
        out["ancestors"] = ancestral.ancestral_sequences(t["states"])
    if c["phylo"]["combined_tree"]:
        _need(t, "phylo", "members")
        out["combined_members"] = members.combined(t["members"])
    return out | _combined_space(t, out.get("ancestors"), c)


def _post(t: Tables, c: dict) -> Tables:
    p = c["post"]
    if not p["enabled"]:
        return {}
    out: Tables = {}
    if "taxonomy" in t and "proteins" in t:
        out["genome_taxonomy"] = taxonomy.genome_lineages(t["proteins"].select("genome"), t["taxonomy"])
    if p["compute_conservation"] or p["compute_kl"]:
        _need(t, "post", "alignment")
        rows = t["alignment"].select("hmm", "tip", "aligned")
        if p["compute_conservation"]:
            out["conservation"] = sites.conservation(sites.sites(rows), metric=p["conservation_metric"])
        if p["compute_kl"]:
            _need(t, "post", "clades")
            out["kl_divergence"] = sites.alignment_divergence(rows, t["clades"], sites.clade_pairs(t["clades"], p["kl_pairs"]))
    if "tree_nodes" in t and "clades" in t:
        clades = t["clades"]
        out["mrca_sanity"] = trees.common_ancestors(t["tree_nodes"], clades)
    return out


def _synteny(t: Tables, c: dict) -> Tables:
    s = c["synteny"]
    if not s["enabled"]:
        return {}
    _need(t, "synteny", "annotated")
    sources = [t[x] for x in ("scan_filtered", "search_filtered") if x in t]
    if not sources:
        raise MissingInput("step synteny is enabled and needs filtered hits")
    top = hits.representative_hits(hits.first_source_wins(sources, order=("bitscore", "evalue", "coverage")), s["dedup_by_genome"], s["max_hits_per_hmm"])
    fields = {"id_fields": tuple(s["protein_id_field"]), "label_fields": tuple(s["gene_label_field"])}
    found = None
    for kind, by_contig in (("genbank", True), ("gff", False)):
        if kind in t:
            rows = neighbourhood.neighbourhoods(top.join(t["annotated"].where(F.col("kind") == kind), "genome"), t[kind], s["window_genes"], by_contig, **fields)
            found = rows if found is None else neighbourhood.first_available(found, rows)
    drawn = neighbourhood.tracks(found)
    if s["include_tree"] and "tree_nodes" in t:
        drawn = _ordered_tracks(drawn, t["tree_nodes"])
    out = {"tracks": drawn}
    method = s["similarity"]["method"]
    program = s["similarity"]["mmseqs_bin"] if method.startswith("mmseqs") else s["similarity"]["diamond_bin"] if method == "diamond" else "blastp"
    if not adapters.missing([program]):
        # features without a translation of their own take that of the genome's protein of that name
        own = t["proteins"].select("genome", F.col("protein").alias("protein_id"), "sequence") if "proteins" in t else None
        full = found.join(own, ["genome", "protein_id"], "left").withColumn("translation", F.when(F.col("translation") != "", F.col("translation")).otherwise(F.col("sequence"))) if own is not None else found
        proteins = full.where(F.col("translation") != "").select("hmm", "uid", "translation", F.col("uid").alias("ord"))
        made = _report(adapters.run_external(_as_fasta(proteins, ["hmm"], "uid", "translation"), "hmm", {"text": "all.faa"}, lambda d: adapters.protein_search(method, "all.faa", s["similarity"])), program)
        out["links"] = neighbourhood.similarity_links(adapters.search_table(made), s["similarity"]["min_identity"], s["similarity"]["min_bitscore"])
    return out


def _ordered_tracks(drawn: DataFrame, nodes: DataFrame) -> DataFrame:
    """Tracks with the ``place`` of their genome in the family's tree."""
    leaves = trees.tips(nodes).select("hmm", genome_key(F.split("tip", r"\|")[0]).alias("key"), "leaf_ord")
    first = leaves.groupBy("hmm", "key").agg(F.min("leaf_ord").alias("leaf_ord"))
    groups = drawn.select("hmm", "genome").distinct().withColumns({"key": genome_key(F.col("genome")), "ord": F.col("genome")})
    met = groups.join(first, ["hmm", "key"], "left")
    placed = neighbourhood.in_tree_order(met.drop("leaf_ord"), met.where("leaf_ord is not null").select("hmm", "genome", "leaf_ord"))
    return drawn.join(placed.select("hmm", "genome", "place"), ["hmm", "genome"], "left")


def _codon(t: Tables, c: dict) -> Tables:
    k = c["codon"]
    if not k["enabled"]:
        return {}
    _need(t, "codon", "alignment", "cds")
    cleaned = codon.clean_alignment(t["alignment"])
    subset = codon.codon_subset(cleaned, codon.match_cds(t["alignment"].select("hmm", "tip"), t["cds"], k["cds_id_mode"]))
    out = {"codon_subset": subset}
    if not adapters.missing(k["pal2nal_cmd"].split()[:1]):
        both = cleaned.join(subset.select("hmm", "tip"), ["hmm", "tip"], "left_semi")
        units = _as_fasta(both, ["hmm"], "tip", "aligned").join(_as_fasta(subset, ["hmm"], "tip", "cds", out="cds"), "hmm")
        made = adapters.run_external(units, "hmm", {"text": "in.faa", "cds": "in.fna"}, lambda d: adapters.codon_alignment(k["pal2nal_cmd"], "in.faa", "in.fna"))
        out["codon_alignment"] = _report(made, "codon")
    return out


def _hyphy(t: Tables, c: dict) -> Tables:
    h = c["hyphy"]
    if not h["enabled"]:
        return {}
    _need(t, "hyphy", "codon_alignment", "newick")
    if adapters.missing([h["hyphy_bin"]]):
        raise MissingInput(f"step hyphy is enabled and needs the program {h['hyphy_bin']}")
    units = t["codon_alignment"].withColumnRenamed("output", "text").join(t["newick"], "hmm")
    done = []
    for test in dict.fromkeys(x.strip() for x in str(h["hyphy_tests"]).split(",") if x.strip()):
        command = lambda d, test=test: adapters.selection_test(h["hyphy_bin"], test, "in.fasta", "in.tree", "out.json")
        made = adapters.run_external(units, "hmm", {"text": "in.fasta", "newick": "in.tree"}, command, "out.json")
        done.append(_report(made, f"hyphy {test}").select("hmm", F.lit(test).alias("test"), "output"))
    return {"selection_tests": reduce(DataFrame.unionByName, done)} if done else {}


def _sequences(t: Tables) -> DataFrame:
    rows = t["members"].select("hmm", F.col("tip").alias("seq_id"), "sequence", "ord")
    if "ancestors" in t:
        rows = rows.unionByName(t["ancestors"].select("hmm", F.col("tip").alias("seq_id"), "sequence", F.lit(None).cast("long").alias("ord")))
    return rows.join(t["attention"], "seq_id", "left") if "attention" in t else rows


def _clusters(t: Tables) -> DataFrame | None:
    return t["clade_assignment"].select(F.col("tip").alias("seq_id"), F.col("cluster_id").cast("string").alias("clade_id"), "hmm").groupBy("seq_id").agg(F.max_by("clade_id", "hmm").alias("clade_id")) if "clade_assignment" in t else None


def _score_motifs(t: Tables, c: dict) -> Tables:
    m = c["motifs"]
    listed = m["motif_list"]
    listed = [x.strip() for x in listed.split(",") if x.strip()] if isinstance(listed, str) else listed
    if not m["enabled"] or not listed:
        return {}
    _need(t, "score_motifs", "members")
    return {"motif_attention_scores": motifs.score_motifs(_sequences(t), listed, _clusters(t), layers=m["attention_layers"])}


def _discover(t: Tables, c: dict) -> Tables:
    d = c["discover"]
    if not d["enabled"]:
        return {}
    _need(t, "discover_motifs", "members", "attention", "clade_assignment")
    rows = _sequences(t).join(_clusters(t), "seq_id")
    return {"discovered_motifs": motifs.discover_motifs(rows, str(d["standard_clade"]), str(d["novel_clade"]), d["kmer_size"], d["top_n_peaks"], layers=d["attention_layers"])}


RUN: dict[str, Callable[[Tables, dict], Tables]] = {
    "prep": _prep,
    "hmmer": _hmmer,
    "extract": _extract,
    "embed": _embed,
    "phylo": _phylo,
    "post": _post,
    "synteny": _synteny,
    "codon": _codon,
    "hyphy": _hyphy,
    "score_motifs": _score_motifs,
    "discover_motifs": _discover,
}


def settings_key(config: dict, inputs: str = "") -> str:
    """A key of all settings but those that say which steps to run, and of the inputs: with others, other results."""
    plain = {k: v for k, v in config.items() if k not in {"workflow", "resources"}}
    return hashlib.sha256((json.dumps(plain, sort_keys=True) + inputs).encode()).hexdigest()[:16]


def run_steps(spark: SparkSession, config: dict, inputs: Tables, folder: str | None = None, state: str = "", written: Callable[[str, DataFrame, dict], None] | None = None) -> Tables:
    """All tables after the steps in range. With a folder, each step's tables are written there and found again on a rerun.

    ``state`` stands for the contents of the inputs; ``written`` gets the name and rows of each table that a step has made.
    """
    w, tables = config["workflow"], dict(inputs)
    for step in STEPS:
        base = f"{folder}/{settings_key(config, state)}/{step}"
        if not in_range(step, w["start_at"], w["stop_after"]):
            if folder:
                tables |= _kept(spark, base) or {}
            continue
        made = None if not folder or w["force"] else _kept(spark, base)
        if made is None:
            made = RUN[step](tables, config)
            if folder:
                for name, table in made.items():
                    table.write.mode("overwrite").parquet(f"{base}/{name}")
                spark.createDataFrame([(n,) for n in made], "name string").write.mode("overwrite").json(f"{base}/_made")
                made = {n: spark.read.parquet(f"{base}/{n}") for n in made}
            for name, table in made.items() if written else ():
                written(name, table, config)
        tables |= made
    return tables


def _kept(spark: SparkSession, base: str) -> Tables | None:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/_made/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    names = [r["name"] for r in spark.read.schema("name string").json(f"{base}/_made").collect()]
    return {n: spark.read.parquet(f"{base}/{n}") for n in names}


def main(argv: list[str] | None = None) -> None:
    from . import inputs, outputs
    from .config import DEFAULTS, parser, resolve, unknown, validate, write_json

    args = parser().parse_args(argv)
    if args.dump_default_config:
        print(json.dumps(DEFAULTS, indent=2, sort_keys=True))
        return
    config = resolve(args)
    validate(config)
    if strange := unknown(config):
        warnings.warn(f"settings without a meaning here: {', '.join(strange)}", stacklevel=2)
    spark = SparkSession.builder.appName("brachis").getOrCreate()
    outdir = config["output"]["outdir"]
    write_json(config, f"{outdir}/summary/resolved_config.json")
    run_steps(spark, config, inputs.load(spark, config), f"{outdir}/tables", inputs.fingerprint(spark, config), outputs.write)


if __name__ == "__main__":
    main()
