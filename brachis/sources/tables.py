"""Text tables of hits, thresholds, names, lineages, clades, clusters and ancestral states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.identifiers import genome_key


def _lines(spark: SparkSession, path) -> DataFrame:
    """(path, file, at, value): the lines of the files, ``at`` ordering those of a file."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at")
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), at, "value")


def in_file_order(rows: DataFrame, path: str = "path", at: str = "at") -> DataFrame:
    """``rows`` with ``ord``: place from 0 of each row of a file among those that ``rows`` still has. A window holds the rows of one block of a file,
    which is bounded by the reader; blocks come after one another by their counts."""
    blocks = rows.groupBy(path, f"{at}.block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(path).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col(path).alias("_path"), F.col("block").alias("_block"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy("_path", "_block").orderBy(f"{at}.row"))
    met = rows.join(blocks, (F.col(path) == F.col("_path")) & (F.col(f"{at}.block") == F.col("_block")))
    return met.withColumn("ord", (F.col("_before") + here - 1).cast("long")).drop("_path", "_block", "_before")


def _words(value: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(value, r"\s+", " ")), " ")


def read_domains(spark: SparkSession, path) -> DataFrame:
    """Raw hits (and file) of profile-search domain tables.

    A ``#`` ends a line wherever it stands. Scores are those of the full sequence, bounds those of the domain, so that a
    protein with two domains of a profile has two rows of the same score. Lines too short or not numeric are dropped.
    """
    return parse_domains(_lines(spark, path).select("file", "value"))


def parse_domains(lines: DataFrame) -> DataFrame:
    """``read_domains`` of the lines ``value`` of a table; other columns are kept."""
    keep = [c for c in lines.columns if c != "value"]
    #: Zero-based columns of a domain table.
    places = {"target": 0, "tlen": 2, "query": 3, "qlen": 5, "evalue": 6, "bitscore": 7, "ali_from": 17, "ali_to": 18}
    words = lines.select(*keep, _words(F.substring_index("value", "#", 1)).alias("w")).where(F.size("w") > 18)
    kinds = {f.name: f.dataType.simpleString() for f in schemas.RAW_HITS}
    found = words.select(*keep, *(F.get("w", F.lit(k)).try_cast(kinds[n]).alias(n) for n, k in places.items()))
    return found.dropna(subset=[n for n in places if kinds[n] != "string"])


def read_thresholds(spark: SparkSession, path) -> DataFrame:
    """(hmm, min_score): two words a line, comments and blank lines skipped, the last line of a name counts."""
    rows = _lines(spark, path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#")).select("path", "at", _words(F.col("value")).alias("w"))
    rows = rows.where(F.size("w") >= 2).select(F.get("w", F.lit(0)).alias("hmm"), F.get("w", F.lit(1)).cast("double").alias("score"), F.struct("path", "at").alias("at"))
    return rows.groupBy("hmm").agg(F.max_by("score", "at").alias("min_score"))


def read_manifest(spark: SparkSession, path) -> DataFrame | None:
    """(hmm): the names to keep; no path means all and gives None."""
    if not path:
        return None
    name = F.trim("value")
    return spark.read.text(path).select(name.alias("hmm")).where((name != "") & ~name.startswith("#")).distinct()


def read_profile_names(spark: SparkSession, path) -> DataFrame:
    """(hmm, path): the name in each profile file's first NAME line."""
    rows = _lines(spark, path).where(F.col("value").startswith("NAME")).select("path", "at", _words(F.col("value")).alias("w")).where(F.size("w") >= 2)
    return rows.groupBy("path").agg(F.min_by(F.get("w", F.lit(1)), "at").alias("hmm")).select("hmm", "path")


def read_profile_texts(spark: SparkSession, path) -> DataFrame:
    """(hmm, text) of profile files; a file of several profiles is one text under the name of its first."""
    texts = spark.read.option("wholetext", True).option("pathGlobFilter", "*.hmm").text(path)
    name = F.regexp_extract("value", r"(?m)^NAME\s+(\S+)", 1)
    return texts.where(name != "").select(name.alias("hmm"), F.col("value").alias("text"))


def _tsv(spark: SparkSession, path, needed: list[str]) -> DataFrame | None:
    """A tab-separated table with a header, all strings; None if it lacks a needed column."""
    table = spark.read.csv(path, sep="\t", header=True)
    return table if set(needed) <= set(table.columns) else None


def read_taxonomy(spark: SparkSession, classifier_dir: str | None = None, own_file: str | None = None) -> DataFrame:
    """(genome_key, taxonomy) of classifier summaries and of an own table, which goes first.

    Within the summaries the last file by name, and in it the last line, counts. Tables without the columns are ignored.
    """
    parts = []
    if classifier_dir:
        table = _tsv(spark, f"{classifier_dir}/gtdbtk.*.summary.tsv", ["user_genome", "classification"])
        if table is not None:
            parts.append(table.select(F.col("user_genome").alias("g"), F.col("classification").alias("taxonomy"), F.lit(0).alias("rank"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")))
    if own_file:
        table = _tsv(spark, own_file, ["genome", "lineage"])
        if table is not None:
            parts.append(table.select(F.col("genome").alias("g"), F.col("lineage").alias("taxonomy"), F.lit(1).alias("rank"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")))
    if not parts:
        return spark.createDataFrame([], schemas.TAXONOMY)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = rows.where(F.col("g").isNotNull()).withColumn("genome_key", genome_key(F.col("g")))
    return rows.groupBy("genome_key").agg(F.max_by("taxonomy", F.struct("rank", "file", "row")).alias("taxonomy"))


def read_clades(spark: SparkSession, path) -> DataFrame:
    """(clade, tip, ord): rows in file order, repeated ones kept, rows with a null dropped."""
    table = _tsv(spark, path, ["clade_name", "tip"])
    if table is None:
        raise ValueError("a clades table needs the columns clade_name and tip")
    return table.select(F.col("clade_name").alias("clade"), "tip", F.monotonically_increasing_id().alias("ord")).dropna()


def read_clusters(spark: SparkSession, path) -> DataFrame:
    """(seq_id, clade_id) of a table of cluster assignments: key ``tip``, ``protein`` or ``seq_id``; the last row of a key counts."""
    table = spark.read.csv(path, sep="\t", header=True)
    key = next(c for c in ("tip", "protein", "seq_id") if c in table.columns)
    rows = table.select(F.col(key).alias("seq_id"), F.col("cluster_id").cast("string").alias("clade_id"), F.monotonically_increasing_id().alias("row"))
    return rows.groupBy("seq_id").agg(F.max_by("clade_id", "row").alias("clade_id"))


def read_hits(spark: SparkSession, path: str | None) -> DataFrame:
    """A hit table written before, or an empty one if there is none."""
    if path and spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        table = spark.read.csv(path, sep="\t", header=True, nullValue="")
        return table.select(*(F.col(f.name).cast(f.dataType) for f in schemas.HITS if f.name in table.columns), *(c for c in table.columns if c not in schemas.HITS.names))
    return spark.createDataFrame([], schemas.HITS)


def write_table(rows: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """Write as tab-separated text with a header; an empty table is not written if so asked. Returns whether it was."""
    if skip_empty and rows.isEmpty():
        return False
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", nullValue="")
    return True


def read_states(spark: SparkSession, path) -> DataFrame:
    """(hmm, node, site, state, ord) of ancestral state tables; hmm is the file's name up to its ending.

    Tabs part the fields, or white space where there is none; comments, short lines and lines without a number as site
    (such as the title) are skipped.
    """
    rows = _lines(spark, path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    fields = F.when(F.col("value").contains("\t"), F.split(F.trim("value"), "\t")).otherwise(_words(F.col("value")))
    rows = rows.select("path", "file", "at", fields.alias("w")).where(F.size("w") >= 3)
    site = F.trim(F.get("w", F.lit(1))).try_cast("int")
    rows = in_file_order(rows.withColumn("site", site).where(F.col("site").isNotNull()))
    return rows.select(F.regexp_replace("file", r"\.[^.]*$", "").alias("hmm"), F.get("w", F.lit(0)).alias("node"), "site", F.get("w", F.lit(2)).alias("state"), "ord")
