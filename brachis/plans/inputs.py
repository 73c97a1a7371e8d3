"""The pipeline's input tables, read from where the settings and the output folder hold them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hits
from ..sources import fasta, features, files, tables

#: Folders of the output folder that hold what external programs and earlier runs left.
FOLDERS = {"scan": "hmmscan_tbl", "search": "hmmsearch_tbl", "bins": "fasta_per_hmm", "aligned": "alignments_hmm", "trimmed": "alignments_clipkit", "trees": "trees_iqtree", "codon": "codon_alignments", "summary": "summary", "embeddings": "embeddings", "synteny": "synteny", "post": "summary/post_scikitbio", "hyphy": "summary/hyphy"}


def listed(spark: SparkSession, path: str | None, ending: str = "") -> list[tuple[str, int, int]]:
    """(path, length, time) of a file, or of the files of a folder with this ending; none if there is no such path."""
    if not path:
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    found = [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in system.listStatus(where) if f.getPath().getName().endswith(ending)]
    return sorted(x for x in found if not x[0].rsplit("/", 1)[-1].startswith((".", "_")))


def place(config: dict, name: str) -> str:
    return f"{config['output']['outdir']}/{FOLDERS[name]}"


def paths(config: dict) -> dict[str, str | None]:
    """Every path that ``load`` may read."""
    i, s = config["inputs"], config["synteny"]
    given = {"faa_dir": i["faa_dir"], "hmm_input": i["hmm_input"], "cds_dir": i["cds_dir"], "gtdb_dir": i["gtdb_dir"], "taxonomy_file": i["taxonomy_file"], "vectors": i.get("vectors"), "attention": i.get("attention")}
    given |= {"manifest": config["workflow"]["hmm_manifest"], "scores": config["filtering"]["scores_tsv"], "clades": config["post"]["clades_tsv"], "gbk_dir": s["gbk_dir"], "gff_dir": s["gff_dir"]}
    return given | {k: place(config, k) for k in ("scan", "search", "aligned", "trimmed", "trees")}


def fingerprint(spark: SparkSession, config: dict) -> str:
    """A key of all input files' names, lengths and times, so that changed inputs are not answered from old tables."""
    state = [(name, listed(spark, path)) for name, path in sorted(paths(config).items())]
    return hashlib.sha256(repr(state).encode()).hexdigest()[:16]


def _annotated(spark: SparkSession, genomes: DataFrame, folder: str, middle: str, kind: str) -> DataFrame:
    chosen = files.annotation_files(genomes, files.list_files(spark, folder), middle)
    return chosen.select("genome", F.element_at(F.split("path", "/"), -1).alias("file"), F.lit(kind).alias("kind"))


def load(spark: SparkSession, config: dict) -> dict[str, DataFrame]:
    """The tables that there are: proteins, profiles, taxonomy, manifest, thresholds, clades, scan_hits, search_hits,
    alignment, newick, states, cds, genbank, gff, annotated, vectors, attention."""
    at = paths(config)
    there = {name for name, path in at.items() if listed(spark, path)}
    out: dict[str, DataFrame] = {"proteins": fasta.read_proteomes(spark, at["faa_dir"])}
    genomes = out["proteins"].select("genome").distinct()
    if "hmm_input" in there:
        out["profiles"] = tables.read_profile_names(spark, at["hmm_input"])
        out["profile_texts"] = tables.read_profile_texts(spark, at["hmm_input"])
    if {"gtdb_dir", "taxonomy_file"} & there:
        out["taxonomy"] = tables.read_taxonomy(spark, at["gtdb_dir"] if "gtdb_dir" in there else None, at["taxonomy_file"] if "taxonomy_file" in there else None)
    for name, path, read in (("manifest", "manifest", tables.read_manifest), ("thresholds", "scores", tables.read_thresholds), ("clades", "clades", tables.read_clades)):
        if at[path]:  # what is named has to be there
            out[name] = read(spark, at[path])
    if "scan" in there:
        out["scan_hits"] = hits.scan_hits(tables.read_domains(spark, at["scan"]), F.regexp_replace("file", r"\.tbl$", ""))
    if "search" in there:
        out["search_hits"] = hits.search_hits(tables.read_domains(spark, at["search"]))
    folders = [at[k] for k in ("trimmed", "aligned") if k in there]
    trees = bool(listed(spark, at["trees"], files.TREE))
    if folders:
        out["alignment"] = fasta.read_alignments(spark, folders, at["trees"] if trees else None)
    if trees:
        out["newick"] = fasta.read_trees(spark, at["trees"])
    if listed(spark, at["trees"], ".state"):
        out["states"] = tables.read_states(spark, f"{at['trees']}/*.state")
    if "cds_dir" in there:
        tips = out["alignment"].select(F.split("tip", r"\|")[0].alias("genome")).distinct() if "alignment" in out else genomes
        out["cds"] = fasta.read_cds(spark, at["cds_dir"], tips)
    annotated = []
    if "gbk_dir" in there:
        out["genbank"] = features.read_genbank(spark, f"{at['gbk_dir']}/*.gb*")
        annotated.append(_annotated(spark, genomes, at["gbk_dir"], ".gb", "genbank"))
    if "gff_dir" in there:
        out["gff"] = features.read_gff(spark, f"{at['gff_dir']}/*.gff*")
        annotated.append(_annotated(spark, genomes, at["gff_dir"], ".gff", "gff"))
    if annotated:
        out["annotated"] = annotated[0] if len(annotated) == 1 else annotated[0].unionByName(annotated[1])
    for name in ("vectors", "attention"):
        if name in there:
            out[name] = spark.read.parquet(at[name])
    return out

