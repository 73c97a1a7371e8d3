"""Configuration: defaults, files, command line and environment; the steps and their range."""

from __future__ import annotations

import argparse
import copy
import json
import os

#: The steps, in the order in which they run.
STEPS = ["prep", "hmmer", "extract", "embed", "phylo", "post", "synteny", "codon", "hyphy", "score_motifs", "discover_motifs"]

#: The default settings, by the names that users' files hold.
DEFAULTS = {
    "inputs": {"faa_dir": None, "hmm_input": None, "cds_dir": None, "gtdb_dir": None, "taxonomy_file": None},
    "output": {"outdir": None},
    "resources": {"cpu": 8},
    "workflow": {"start_at": None, "stop_after": None, "force": False, "hmm_manifest": None},
    "hmmer": {"run_scan": True, "run_search": True},
    "filtering": {"scores_tsv": None, "global_min_score": 25.0, "min_coverage": 0.5, "keep_tbl": False},
    "phylo": {"mafft": False, "also_mafft": False, "mafft_for_tree": False, "mafft_mode": "auto", "no_trim_hmmalign": False, "skip_clipkit": False, "no_asr": False, "iq_boot": 1000, "use_hmmsearch_alignment": False, "keep_all_hits": False, "combined_tree": False, "iqtree_bin": "iqtree"},
    "embeddings": {"enabled": False, "backend": "esm", "model": "esm2_t33_650M_UR50D", "device": "cuda", "batch_size": 8, "repr_layer": None, "pooling": "mean", "pca_components": 3, "write_full_vectors": False, "cluster_embeddings": True, "hdbscan_min_cluster_size": 5},
    "post": {"enabled": False, "compute_conservation": False, "conservation_metric": "inverse_shannon_uncertainty", "compute_kl": False, "clades_tsv": None, "kl_pairs": None},
    "synteny": {
        "enabled": False,
        "gbk_dir": None,
        "gff_dir": None,
        "genome_fasta_dir": None,
        "window_genes": 10,
        "max_hits_per_hmm": 50,
        "dedup_by_genome": True,
        "prefer_best_hit": True,
        "reference_mode": "per_hmm",
        "protein_id_field": ["ID", "protein_id", "locus_tag"],
        "gene_label_field": ["gene", "product", "Name", "locus_tag"],
        "strand_colors": False,
        "output_format": "pdf",
        "plot_height_per_track": 0.35,
        "plot_width": 14,
        "include_tree": True,
        "tree_source": "iqtree",
        "tree_tip_label_mode": "genome",
        "tree_order": "ladderize",
        "similarity": {"method": "diamond", "diamond_bin": "diamond", "mmseqs_bin": "mmseqs", "min_identity": 30, "min_bitscore": 50, "max_evalue": 1e-5, "max_targets": 2000},
    },
    "codon": {"enabled": False, "build_codon_alignments": False, "cds_id_mode": "after_last_pipe", "pal2nal_cmd": "pal2nal.pl"},
    "hyphy": {"enabled": False, "run_hyphy": False, "hyphy_bin": "hyphy", "hyphy_tests": "RELAX,aBSREL,MEME"},
    "motifs": {"enabled": False, "motif_list": [], "attention_layers": 4},
    "discover": {"enabled": False, "standard_clade": None, "novel_clade": None, "kmer_size": 5, "top_n_peaks": 20, "attention_layers": 4},
}
#: Settings of this library's own: tables that were made elsewhere (Parquet).
DEFAULTS["inputs"] |= {"vectors": None, "attention": None}
#: What only says how a drawing looks or is met in another way: accepted, without effect on any table.
NO_EFFECT = ("synteny.strand_colors", "synteny.output_format", "synteny.plot_height_per_track", "synteny.plot_width", "synteny.genome_fasta_dir", "synteny.prefer_best_hit", "synteny.reference_mode", "synteny.tree_source", "synteny.tree_tip_label_mode", "codon.build_codon_alignments", "hyphy.run_hyphy", "phylo.use_hmmsearch_alignment", "embeddings.pooling", "filtering.keep_tbl")
REQUIRED = (("inputs", "faa_dir"), ("inputs", "hmm_input"), ("output", "outdir"))


def merged(base: dict, update: dict) -> dict:
    """``base`` with ``update`` over it: two dicts are merged, anything else is replaced. Neither argument changes."""
    out = copy.deepcopy(base)
    for key, value in update.items():
        both = isinstance(value, dict) and isinstance(out.get(key), dict)
        out[key] = merged(out[key], value) if both else copy.deepcopy(value)
    return out


def load_json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def write_json(value: dict, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, sort_keys=True)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Comparative protein-family analysis on Spark")
    for flag in ("--config", "--faa_dir", "--hmm_dir", "--outdir", "--motifs", "--standard-clade", "--novel-clade"):
        p.add_argument(flag)
    p.add_argument("--cpu", type=int)
    for flag in ("--start_at", "--stop_after"):
        p.add_argument(flag, choices=STEPS)
    for flag in ("--force", "--combined", "--dump_default_config"):
        p.add_argument(flag, action="store_true")
    return p


def resolve(args: argparse.Namespace, environ: dict | None = None) -> dict:
    """Defaults, under the file named, under the command line; the scheduler's CPU count holds unless ``--cpu`` is given."""
    environ = os.environ if environ is None else environ
    own: dict = {}

    def put(section: str, key: str, value) -> None:
        if value not in (None, False):
            own.setdefault(section, {})[key] = value

    put("inputs", "faa_dir", args.faa_dir)
    put("inputs", "hmm_input", args.hmm_dir)
    put("output", "outdir", args.outdir)
    allotted = environ.get("SLURM_CPUS_PER_TASK", "")
    put("resources", "cpu", args.cpu or (int(allotted) if allotted.isdigit() else None))
    for key in ("start_at", "stop_after", "force"):
        put("workflow", key, getattr(args, key))
    put("phylo", "combined_tree", args.combined)
    if args.motifs:
        own["motifs"] = {"enabled": True, "motif_list": [m.strip() for m in args.motifs.split(",") if m.strip()]}
    if args.standard_clade is not None and args.novel_clade is not None:
        own["discover"] = {"enabled": True, "standard_clade": args.standard_clade, "novel_clade": args.novel_clade}
    return merged(merged(DEFAULTS, load_json(args.config) if args.config else {}), own)


def validate(config: dict) -> None:
    if missing := [f"{a}.{b}" for a, b in REQUIRED if not config.get(a, {}).get(b)]:
        raise SystemExit(f"missing settings: {', '.join(missing)}")


def unknown(config: dict, base: dict | None = None, prefix: str = "") -> list[str]:
    """Names of settings that have no meaning here."""
    base = DEFAULTS if base is None else base
    out = []
    for key, value in config.items():
        if key not in base:
            out.append(prefix + key)
        elif isinstance(base[key], dict) and isinstance(value, dict):
            out += unknown(value, base[key], f"{prefix}{key}.")
    return out


def in_range(step: str, start_at: str | None = None, stop_after: str | None = None) -> bool:
    """Whether a step lies between the two, both included."""
    at = STEPS.index(step)
    return (STEPS.index(start_at) if start_at else 0) <= at <= (STEPS.index(stop_after) if stop_after else len(STEPS) - 1)
