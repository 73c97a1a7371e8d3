"""Which file belongs to which genome or family: ranked name patterns over a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import genome_key


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name) of the files in a folder by name, or of one file; their contents are unread."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name")).orderBy("name", "path")


def stem(name: Column) -> Column:
    """A file's name without its last ending."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def names_holding(keys: DataFrame, files: DataFrame, prefix: bool = False) -> DataFrame:
    """``keys(key, ...)`` joined with the ``files(path, name)`` whose name holds the key, or begins with it.

    Each name is cut into the pieces that are as long as some key, which meet the keys by equality; a name has at most 255
    characters, so neither side grows with the other.
    """
    sizes = keys.agg(F.array_sort(F.collect_set(F.length("key"))).alias("_sizes"))  # at most one a length of a name
    starts = F.array(F.lit(1)) if prefix else F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1)))
    cut = files.join(F.broadcast(sizes), F.lit(True)).select("path", "name", F.explode(starts).alias("_at"), "_sizes")
    cut = cut.select("path", "name", "_at", F.explode("_sizes").alias("_n")).where(F.col("_at") + F.col("_n") - 1 <= F.length("name"))
    pieces = cut.select("path", "name", F.substr("name", F.col("_at"), F.col("_n")).alias("key")).distinct()
    return keys.join(pieces, "key")


def _like(name: Column, *parts) -> Column:
    """Whether a name holds the parts in order, the first at its beginning, the last at its end (None: anything between)."""
    literal = F.concat(*(F.lit(".*") if p is None else F.concat(F.lit(r"\Q"), p, F.lit(r"\E")) for p in parts))
    return F.regexp_like(name, F.concat(F.lit("(?s)^"), literal, F.lit("$")))


def cds_files(genomes: DataFrame, files: DataFrame) -> DataFrame:
    """(genome, path): each genome's CDS file, by eight name patterns in order, the first name of the first that fits."""
    g, k = F.col("genome"), genome_key(F.col("genome"))
    end = F.lit
    #: The patterns, most specific first.
    patterns = [
        (g, None, end(".fna")),
        (g, None, end(".ffn")),
        (g, None, end(".cds"), None, end(".fna")),
        (k, None, end(".fna")),
        (k, None, end(".ffn")),
        (k, None, end(".cds"), None, end(".fna")),
        (None, g, None, end(".fna")),
        (None, k, None, end(".fna")),
    ]
    rank = F.coalesce(*(F.when(_like(F.col("name"), *p), F.lit(n)) for n, p in enumerate(patterns)))
    # every pattern holds the genome's key, so a name meets only the genomes whose key it contains
    met = names_holding(genomes.select("genome", genome_key(F.col("genome")).alias("key")).distinct(), files)
    return met.withColumn("rank", rank).where(F.col("rank").isNotNull()).groupBy("genome").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def annotation_files(genomes: DataFrame, files: DataFrame, middle: str) -> DataFrame:
    """(genome, path): the first file whose name begins with the genome's key and then holds ``middle`` (``.gb``, ``.gff``)."""
    key = genome_key(F.col("genome"))
    met = names_holding(genomes.select("genome", key.alias("key")).distinct(), files, prefix=True)
    met = met.where(F.contains(F.substr(F.col("name"), F.length("key") + 1), F.lit(middle)))
    return met.groupBy("genome").agg(F.min("path").alias("path"))


#: What alignments are called, best first, and trees.
ALIGNMENTS = (".clipkit.faa", ".mafft.fasta", ".afa")
TREE = ".treefile"


def _named(files: DataFrame, endings: tuple[str, ...]) -> DataFrame:
    """(hmm, path, name, rank) of the files with one of the endings."""
    rows = [F.when(F.col("name").endswith(e), F.struct(F.lit(n).alias("rank"), F.substr("name", F.lit(1), F.length("name") - len(e)).alias("hmm"))) for n, e in enumerate(endings)]
    return files.select("path", "name", F.coalesce(*rows).alias("f")).where(F.col("f").isNotNull()).select("f.hmm", "path", "name", "f.rank")


def alignment_files(files: DataFrame, trees: DataFrame | None = None, endings: tuple[str, ...] = ALIGNMENTS) -> DataFrame:
    """(hmm, path, name): each family's alignment, trimmed before untrimmed; with ``trees(path, name)`` of families that have one."""
    found = _named(files, endings)
    found = found.groupBy("hmm").agg(F.min(F.struct("rank", "path", "name")).alias("f")).select("hmm", "f.path", "f.name")
    return found if trees is None else found.join(_named(trees, (TREE,)).select("hmm"), "hmm", "left_semi")
