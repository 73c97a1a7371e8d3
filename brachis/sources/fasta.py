"""FASTA files in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identifiers import split_tip
from .files import ALIGNMENTS, TREE, alignment_files, cds_files, list_files, stem


def read_fasta(spark: SparkSession, path, pattern: str | None = None) -> DataFrame:
    """(file, seq_id, ord, sequence): one row a record of the files at ``path``; ``ord`` orders those of a file.

    The id is the first word after ``>``; sequence lines are put together. Text before the first header and empty files
    give nothing. An id that a file holds twice stands at its first place with its last sequence. Records are the unit of
    reading, so a large file is split among tasks.
    """
    reader = spark.read.option("lineSep", "\n>")
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    meta = F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    raw = reader.text(path).select(*meta, F.monotonically_increasing_id().alias("row"), "value")
    # places within a file from the counts of its blocks: one row a block, so no file is ever sorted by one task
    blocks = raw.groupBy("path", "block").agg(F.min("row").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = raw.join(blocks, ["path", "block"]).withColumn("ord", F.col("before") + F.col("row") - F.col("low"))
    # only the record at a file's beginning still has its own mark; what stands before the first mark has none
    first = F.col("ord") == 0
    body = F.when(first, F.regexp_replace("value", r"^\s*>", "")).otherwise(F.col("value"))
    sequence = F.regexp_replace(F.regexp_replace(body, r"^[^\n]*\n?", ""), r"\s+", "")
    records = placed.where(~first | F.ltrim("value").startswith(">")).select("file", "path", "ord", F.regexp_extract(body, r"^[ \t]*(\S+)", 1).alias("seq_id"), sequence.alias("sequence"))
    return last_wins(records.where(F.col("seq_id") != ""), ["path", "seq_id"], "ord", "sequence").select("file", "seq_id", "ord", "sequence")


def last_wins(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """One row a key: the last value in the given order, at the first one's place."""
    other = [c for c in rows.columns if c not in {*key, order, value}]
    return rows.groupBy(*key).agg(F.min(order).alias(order), F.max_by(value, order).alias(value), *(F.first(c).alias(c) for c in other))


def read_proteomes(spark: SparkSession, path: str) -> DataFrame:
    """(genome, protein, ord, sequence) of every ``.faa`` file; the genome is the file's name with its ending."""
    found = read_fasta(spark, path, "*.faa")
    return found.select(F.col("file").alias("genome"), F.col("seq_id").alias("protein"), "ord", "sequence")


def read_bins(spark: SparkSession, folder: str, manifest: DataFrame | None = None, left_out: tuple[str, ...] = ("combined_all_hits",)) -> DataFrame:
    """(hmm, tip, genome, protein, ord, sequence) of a folder of family FASTA files; the family is the file's name."""
    found = read_fasta(spark, folder, "*.faa").withColumn("hmm", stem(F.col("file"))).where(~F.col("hmm").isin(*left_out))
    genome, protein = split_tip(F.col("seq_id"))
    rows = found.select("hmm", F.col("seq_id").alias("tip"), genome.alias("genome"), protein.alias("protein"), "ord", "sequence")
    return rows if manifest is None else rows.join(manifest.select("hmm").distinct(), "hmm", "left_semi")


def read_alignments(spark: SparkSession, folders: list[str], trees: str | None = None) -> DataFrame:
    """(hmm, tip, ord, aligned) of each family's best alignment in the folders; with ``trees`` of families that have a tree there."""
    pattern = "*{" + ",".join(ALIGNMENTS) + "}"
    listed = list_files(spark, folders, pattern)
    chosen = alignment_files(listed, list_files(spark, trees, "*" + TREE) if trees else None)
    rows = read_fasta(spark, folders, pattern).join(chosen.select("hmm", F.col("name").alias("file")), "file")
    return rows.select("hmm", F.col("seq_id").alias("tip"), "ord", F.col("sequence").alias("aligned"))


def read_trees(spark: SparkSession, folder: str) -> DataFrame:
    """(hmm, newick) of a folder of tree files."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*" + TREE).text(folder)
    return files.select(F.regexp_replace("_metadata.file_name", r"\.treefile$", "").alias("hmm"), F.regexp_replace("value", r"^\s+|\s+$", "").alias("newick"))


def read_cds(spark: SparkSession, folder: str, genomes: DataFrame) -> DataFrame:
    """(genome, name, ord, sequence): the coding sequences of each genome's file."""
    chosen = cds_files(genomes, list_files(spark, folder))
    chosen = chosen.select("genome", F.element_at(F.split("path", "/"), -1).alias("file"))
    rows = read_fasta(spark, folder, "*.{fna,ffn}").join(chosen, "file")
    return rows.select("genome", F.col("seq_id").alias("name"), "ord", "sequence")


def fasta_record(name: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), sequence)


def write_fasta(rows: DataFrame, path: str, name: str = "seq_id", sequence: str = "sequence", order: list[str] | None = None, by: str | None = None) -> None:
    """Two-line records as text, in the given order, in one folder for each value of ``by``."""
    rows = rows.orderBy(*order) if order else rows
    out = rows.select(*([by] if by else []), fasta_record(F.col(name), F.col(sequence)).alias("value"))
    writer = out.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def combined_proteome(proteins: DataFrame) -> DataFrame:
    """(seq_id, sequence) of all proteomes under ``genome~protein``."""
    return proteins.select(F.concat("genome", F.lit("~"), "protein").alias("seq_id"), "sequence", "genome", "ord")
