"""The pipeline's tables as the text files that users read. Each is a folder of parts, written by as many tasks as there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.fasta import write_fasta
from ..sources.tables import write_table
from .inputs import place

#: The folder and name of each table; those by family are folders of one folder a family.
TABLES = {
    "scan_filtered": ("summary", "hmmscan_hits.filtered.tsv"),
    "search_filtered": ("summary", "hmmsearch_hits.filtered.tsv"),
    "best_hits": ("summary", "best_hits.competitive.tsv"),
    "genome_taxonomy": ("summary", "genome_taxonomy.tsv"),
    "clade_assignment": ("summary", "clade_assignment.tsv"),
    "motif_attention_scores": ("summary", "motif_attention_scores.tsv"),
    "discovered_motifs": ("summary", "discovered_motifs.tsv"),
    "conservation": ("post", "conservation.tsv"),
    "kl_divergence": ("post", "kl_divergence.tsv"),
    "mrca_sanity": ("post", "mrca_sanity.tsv"),
    "pca": ("embeddings", "pca.tsv"),
    "layout": ("embeddings", "umap.tsv"),
    "dispersion": ("embeddings", "dispersion.tsv"),
    "plot": ("embeddings", "umap.points.tsv"),
    "combined_pca": ("embeddings", "combined_with_ancestors.pca.tsv"),
    "combined_layout": ("embeddings", "combined_with_ancestors.umap.tsv"),
    "combined_plot": ("embeddings", "combined_with_ancestors.points.tsv"),
    "vectors_long": ("embeddings", "vectors.tsv"),
    "tracks": ("synteny", "tracks.tsv"),
    "links": ("synteny", "links.tsv"),
}
FASTAS = {
    "combined": ("combined_proteomes.faa", "seq_id", "sequence", ["genome", "ord"], None),
    "members": ("fasta_per_hmm", "tip", "sequence", ["hmm", "genome", "ord"], "hmm"),
    "combined_members": ("fasta_per_hmm/combined_all_hits.faa", "tip", "sequence", ["hmm", "ord"], None),
    "ancestors": ("ancestral", "tip", "sequence", ["hmm", "node"], "hmm"),
    "codon_subset": ("codon_alignments", "tip", "cds", ["hmm", "ord"], "hmm"),
}
#: Texts that external programs made, one folder a unit: folder, and the columns that name a unit.
TEXTS = {"codon_alignment": ("codon", ["hmm"]), "selection_tests": ("hyphy", ["hmm", "test"])}


def flat(rows: DataFrame) -> DataFrame:
    """Arrays and maps as JSON text, as a table of text holds neither."""
    kinds = dict(rows.dtypes)
    return rows.select(*(F.to_json(c).alias(c) if kinds[c].startswith(("array", "map", "struct")) else F.col(c) for c in rows.columns))


def write(name: str, rows: DataFrame, config: dict) -> None:
    """Write a step's table where users look for it, if it is one of theirs; empty tables are not written."""
    outdir = config["output"]["outdir"]
    if name in TABLES:
        folder, file = TABLES[name]
        write_table(flat(rows), f"{place(config, folder)}/{file}")
    elif name in FASTAS and not rows.isEmpty():
        path, key, sequence, order, by = FASTAS[name]
        write_fasta(rows, f"{outdir}/{path}" if by is None else f"{outdir}/{path}/by_family", key, sequence, order, by)
    elif name == "pca_model":
        meta = rows.select("hmm", "n", "explained_variance_ratio", F.size("mean").alias("dims"))
        meta.write.mode("overwrite").json(f"{place(config, 'embeddings')}/pca.meta.json")
    elif name in TEXTS:
        folder, keys = TEXTS[name]
        made = rows.where(F.col("output").isNotNull()).select(F.concat_ws(".", *keys).alias("unit"), F.col("output").alias("value"))
        made.write.mode("overwrite").partitionBy("unit").text(f"{place(config, folder)}/{name}")
