"""Registered queries of sources, sinks and the operators around them, with their SQL.

The supplied tables are written in the format that a source reads, in a folder that driver and executors share, and read
back by it; the SQL gives the rows that have to come out.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..functions import sequences as seq
from ..operators import codon, embedspace, hits, members, motifs, neighbourhood, sites, taxonomy, trees
from ..sources import fasta, features, files, tables

_own: list[str] = []


def _folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``; in local mode without it in a temporary one that goes with the driver."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="brachis-files-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = _own[0]
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(rows: DataFrame, *parts) -> str:
    """Write rows of text, one line each, to a new folder; returns it."""
    path = _folder(rows.sparkSession)
    rows.select(F.concat(*parts).alias("value")).write.text(path)
    return path


_text = lambda c: F.col(c).cast("string")


def fasta_records(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select(F.concat(F.lit("p|"), _text("p_partkey"), F.lit(" a description")).alias("seq_id"), F.upper(F.translate("p_name", " ", "")).alias("sequence"))
    path = _folder(spark)
    fasta.write_fasta(part, path)
    return fasta.read_fasta(spark, path).select("seq_id", "sequence")


def proteomes(spark, sf_dir):
    """Suppliers as proteins, one file a nation, put together as one proteome."""
    rows = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.concat(F.lit("s"), _text("s_suppkey")).alias("seq_id"), F.translate("s_name", "#0123456789", "").alias("sequence"))
    path = _folder(spark)
    fasta.write_fasta(rows, path, by="nation")
    found = fasta.read_fasta(spark, f"{path}/*").withColumn("nation", F.lit("n"))
    own = found.select(F.col("nation").alias("genome"), F.col("seq_id").alias("protein"), "ord", "sequence")
    return fasta.combined_proteome(own).select("seq_id", "sequence")


def _domain_file(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").where("l_quantity > 20")
    word = lambda *c: F.concat_ws("  ", *c)
    return _lines(
        rows,
        word(F.concat(F.lit("g"), _text("l_suppkey"), F.lit("~p"), _text("l_partkey")), F.lit("-"), F.lit("50"), F.concat("l_returnflag", "l_linestatus"), F.lit("-"), F.lit("40"), _text("l_discount"), _text("l_extendedprice"), F.lit("0 1 1 1 1 1 1 1 1"), F.lit("1"), _text("l_linenumber"), F.lit("# end")),
    )


def domain_table(spark, sf_dir):
    found = tables.read_domains(spark, _domain_file(spark, sf_dir))
    return found.groupBy("query", "tlen", "qlen", "ali_from", "ali_to").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("bitscore"), 2).alias("score"), F.round(F.sum("evalue"), 2).alias("evalues"))


def projected_hits(spark, sf_dir):
    """One domain table read as a scan's and as a search's."""
    raw = tables.read_domains(spark, _domain_file(spark, sf_dir))
    kinds = [("scan", hits.scan_hits(raw, F.lit("g"))), ("search", hits.search_hits(raw))]
    cut = [rows.groupBy(F.lit(name).alias("kind"), "genome", "coverage").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("protein", "hmm").alias("pairs")) for name, rows in kinds]
    return cut[0].unionByName(cut[1]).withColumn("coverage", F.round("coverage", 6))


def threshold_file(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation")
    text = F.when(F.col("n_nationkey") % 7 == 0, F.concat(F.lit("# "), F.col("n_name"))).otherwise(F.concat(F.lit("  r"), _text("n_regionkey"), F.lit(" \t"), _text("n_nationkey"), F.lit(" more")))
    return tables.read_thresholds(spark, _lines(rows.coalesce(1).orderBy("n_nationkey"), text))


def manifest_file(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer")
    return tables.read_manifest(spark, _lines(rows, F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("# "), "c_name")).otherwise(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))))


def profile_names(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation")
    path = _folder(spark)
    rows.select(F.col("n_nationkey").alias("k"), F.concat(F.lit("HMMER3/f\nNAME  "), F.translate("n_name", " ", "_"), F.lit("\nNAME  other\nLENG 3")).alias("value")).write.partitionBy("k").text(path)
    return tables.read_profile_names(spark, f"{path}/*").select("hmm")


def taxonomy_files(spark, sf_dir):
    """Classifier summaries of all suppliers and an own table of some, which goes first."""
    rows = _table(spark, sf_dir, "supplier")
    first, own = _folder(spark), _folder(spark)
    rows.select(F.concat("s_name", F.lit(".faa")).alias("user_genome"), F.concat(F.lit("d__"), _text("s_nationkey")).alias("classification"), F.lit(1).alias("x")).coalesce(1).write.csv(f"{first}/gtdbtk.bac.summary.tsv", sep="\t", header=True)
    rows.where("s_suppkey % 4 = 0").select(F.col("s_name").alias("genome"), F.lit("own").alias("lineage")).coalesce(1).write.csv(own, sep="\t", header=True)
    return tables.read_taxonomy(spark, first, own)


def clade_file(spark, sf_dir):
    path = _folder(spark)
    _table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("clade_name"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("tip"), F.lit("x").alias("note")).write.csv(path, sep="\t", header=True)
    return tables.read_clades(spark, path).select("clade", "tip")


def hit_file(spark, sf_dir):
    """Hits written as a table of text and read back."""
    path = _folder(spark)
    rows = _table(spark, sf_dir, "lineitem").select(_text("l_suppkey").alias("genome"), _text("l_partkey").alias("protein"), F.concat("l_returnflag", "l_linestatus").alias("hmm"), F.col("l_extendedprice").cast("double").alias("bitscore"), F.col("l_discount").cast("double").alias("evalue"), F.col("l_tax").cast("double").alias("coverage"), F.col("l_linenumber").alias("extra"))
    tables.write_table(rows, path)
    found = tables.read_hits(spark, path)
    return found.groupBy("hmm", "extra").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("bitscore"), 2).alias("score"), F.round(F.sum("coverage"), 2).alias("coverage"))


def cluster_file(spark, sf_dir):
    path = _folder(spark)
    _table(spark, sf_dir, "embeddings").select(F.concat(F.lit("t"), _text("vec_id")).alias("tip"), F.col("label").alias("cluster_id")).write.csv(path, sep="\t", header=True)
    return tables.read_clusters(spark, path)


def gff_features(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders")
    tab = F.lit("\t")
    line = F.concat(F.lit("c"), (F.col("o_custkey") % 3).cast("string"), tab, F.lit("x"), tab, F.when(F.col("o_orderkey") % 3 == 0, "gene").otherwise("CDS"), tab, _text("o_orderkey"), tab, (F.col("o_orderkey") + 9).cast("string"), tab, F.lit("."), tab, F.when(F.col("o_orderstatus") == "O", "+").otherwise("-"), tab, F.lit("0"), tab, F.concat(F.lit("ID=o"), _text("o_orderkey"), F.lit(";note;product="), F.col("o_orderpriority"), F.lit(";ID=z"), _text("o_orderkey")))
    found = features.read_gff(spark, _lines(rows, F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("#"), line)).otherwise(line)))
    return found.select("contig", "start", "end", "strand", ids.first_present(F.col("attributes"), ("ID", "protein_id")).alias("id"), ids.first_present(F.col("attributes"), ("gene", "product")).alias("label"))


def state_file(spark, sf_dir):
    rows = _table(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 10 == 0, F.lit("# Node\tSite\tState")).when(F.col("event_id") % 10 == 1, F.lit("Node\tSite\tState")).otherwise(F.concat(F.lit("N"), _text("user_id"), F.lit("\t"), (F.col("event_id") % 17).cast("string"), F.lit("\t"), F.substr("event_type", F.lit(1), F.lit(1)), F.lit("\t0.9")))
    return tables.read_states(spark, _lines(rows, line)).groupBy("node", "site", "state").agg(F.count(F.lit(1)).alias("n"))


def _names(spark, sf_dir):
    """A listing of file names: suppliers with one ending or another."""
    end = F.element_at(F.array(*map(F.lit, (".fna", ".ffn", ".cds.x.fna", ".gbff", ".gff3"))), (F.col("s_suppkey") % 5 + 1).cast("int"))
    name = F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lit("x_")).otherwise(F.lit("")), F.translate("s_name", "#", ""), end)
    return _table(spark, sf_dir, "supplier").select(F.concat(F.lit("/d/"), name).alias("path"), name.alias("name"))


def _genomes(spark, sf_dir):
    return _table(spark, sf_dir, "supplier").select(F.concat(F.translate("s_name", "#", ""), F.lit(".faa")).alias("genome"))


def cds_of_genomes(spark, sf_dir):
    return files.cds_files(_genomes(spark, sf_dir), _names(spark, sf_dir))


def annotation_of_genomes(spark, sf_dir):
    return files.annotation_files(_genomes(spark, sf_dir), _names(spark, sf_dir), ".g")


def alignment_of_families(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    name = F.concat(F.lit("f"), (F.col("p_partkey") % 50).cast("string"), F.element_at(F.array(*map(F.lit, (".afa", ".mafft.fasta", ".txt", ".clipkit.faa"))), (F.col("p_size") % 4 + 1).cast("int")))
    listed = part.select(F.concat(F.lit("/d/"), name).alias("path"), name.alias("name")).distinct()
    grown = part.where("p_size > 10").select(F.concat(F.lit("f"), (F.col("p_partkey") % 50).cast("string"), F.lit(".treefile")).alias("name")).distinct()
    return files.alignment_files(listed, grown.withColumn("path", F.col("name"))).select("hmm", "name")


def _newick(spark, sf_dir):
    """Nations under regions, larger regions in front, as a tree text."""
    nation = _table(spark, sf_dir, "nation").where("n_nationkey % 6 > 0")
    region = nation.groupBy("n_regionkey").agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(F.concat(F.translate("n_name", " ", "_"), F.lit(":1")))), ","), F.lit(")r"), F.first("n_regionkey").cast("string")).alias("t"))
    return region.agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("t")), ","), F.lit(")root;")).alias("newick")).select(F.lit("h").alias("hmm"), "newick")


def tree_tips(spark, sf_dir):
    return trees.tips(trees.tree_nodes(_newick(spark, sf_dir), ladderize=False)).select(F.col("tip"), F.col("leaf_ord").cast("long").alias("place"))


def ladder_order(spark, sf_dir):
    """Tips by ladder: the region that each stands in, smaller ones first."""
    nodes = trees.tree_nodes(_newick(spark, sf_dir))
    sized = nodes.where("is_tip").join(nodes.select(F.col("hmm").alias("h2"), F.col("node_id").alias("up"), F.col("name").alias("region")), F.col("parent_id") == F.col("up"))
    return sized.groupBy("region").agg(F.min("leaf_ord").cast("long").alias("first"), F.count(F.lit(1)).alias("n")).select("n", "first")


def common_ancestors(spark, sf_dir):
    clades = _table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 6 == 0, "gone").when(F.col("n_regionkey") == 4, "far").otherwise(F.concat(F.lit("c"), _text("n_regionkey"))).alias("clade"), F.translate("n_name", " ", "_").alias("tip"), F.col("n_nationkey").cast("long").alias("ord"))
    wide = _table(spark, sf_dir, "nation").where("n_regionkey < 2 AND n_nationkey % 6 > 0").select(F.lit("wide").alias("clade"), F.translate("n_name", " ", "_").alias("tip"), F.col("n_nationkey").cast("long").alias("ord"))
    return trees.common_ancestors(trees.tree_nodes(_newick(spark, sf_dir)), clades.unionByName(wide)).select("clade", "status", "detail", "mrca_name")


def tree_ordered(spark, sf_dir):
    groups = _table(spark, sf_dir, "supplier").where("s_suppkey <= 200").select(F.lit("h").alias("hmm"), _text("s_suppkey").alias("genome"), F.col("s_suppkey").alias("ord"))
    leaves = _table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(_text("s_suppkey").alias("genome"), (-F.col("s_suppkey")).alias("leaf_ord"))
    return neighbourhood.in_tree_order(groups, leaves).select("genome", F.col("place").cast("long").alias("place"))


def cds_matches(spark, sf_dir):
    """Parts as tips and coding sequences whose names differ by a suffix, hold the tip's, or are missing."""
    part = _table(spark, sf_dir, "part").where("p_partkey <= 300")
    key = F.concat(F.lit("q"), F.lpad(_text("p_partkey"), 4, "0"))
    tip = part.select(F.lit("h").alias("hmm"), F.concat(F.lit("g|"), key).alias("tip"))
    name = F.when(F.col("p_partkey") % 4 == 0, key).when(F.col("p_partkey") % 4 == 1, F.concat(key, F.lit("_cds"))).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("lcl_"), key, F.lit("_x")))
    cds = part.where("p_partkey % 4 < 3").select(F.lit("g").alias("genome"), name.alias("name"), F.col("p_partkey").alias("ord"), F.concat(F.lit("ATG"), F.lit("tga")).alias("sequence"))
    return codon.match_cds(tip, cds).select("tip", "cds_name", "rank", "cds")


def codon_subsets(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    alignment = part.select(F.col("p_brand").alias("hmm"), _text("p_partkey").alias("tip"), F.col("p_partkey").alias("ord"))
    matched = part.where("p_size > 25").select(F.col("p_brand").alias("hmm"), _text("p_partkey").alias("tip"), F.col("p_type").alias("cds"))
    return codon.codon_subset(alignment, matched, 40).select("hmm", "tip", "cds")


def kmers_at(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    at = seq.raw_position(F.col("p_size") * 10 % 500, F.length("p_name"))
    return part.select("p_partkey", at.cast("long").alias("place"), seq.kmer_at(F.col("p_name"), at, 5).alias("kmer"))


def kmer_table(spark, sf_dir):
    """k-mers at the fourth place of documents, quality as delta, summarised."""
    rows = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").where(F.length("text") >= 8)
    found = rows.select(F.substr("text", F.lit(4), F.lit(2)).alias("kmer"), F.length("text").alias("position"), F.col("quality").cast("double").alias("delta"), F.col("doc_id").alias("seq_id"), F.col("doc_id").alias("ord"), F.lit(0).alias("point"))
    return motifs.kmer_summary(found, 30).select("kmer", "n_sequences", F.round("mean_attention_delta", 6).alias("delta"), F.col("median_position").alias("med"), F.col("representative_seq_id").alias("rep"))


def first_members(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("hmm"), _text("l_suppkey").alias("tip"), F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("sequence"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return members.combined(rows).select("hmm", "tip", "sequence")


def members_and_ancestors(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    modern = nation.select(F.col("n_name").alias("tip"), F.lit("M").alias("sequence"), _text("n_regionkey").alias("hmm"))
    old = nation.where("n_nationkey % 2 = 0").select(F.when(F.col("n_nationkey") % 4 == 0, F.col("n_name")).otherwise(F.concat(F.lit("ANC|"), "n_name")).alias("tip"), F.lit("A").alias("sequence"), F.lit("anc").alias("hmm"))
    return members.with_ancestors(modern, old)


def assigned_counts(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select(F.concat(F.lit("f"), (F.col("vec_id") % 3).cast("string")).alias("hmm"), F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("cluster_id"))
    return embedspace.cluster_counts(rows)


def assignment_rows(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select(F.lit("f").alias("hmm"), F.concat(F.when(F.col("vec_id") % 9 == 0, F.lit("ANC|f_N")).otherwise(F.concat(F.lit("g"), (F.col("vec_id") % 7).cast("string"), F.lit("|p"))), _text("vec_id")).alias("tip"), F.col("label").alias("cluster_id"))
    lineages = spark.createDataFrame([(f"g{k}", f"d__{k}") for k in range(5)], "genome_key string, taxonomy string")
    more = embedspace.assignments(rows.where("cluster_id < 3").withColumn("hmm", F.lit("combined")))
    return embedspace.assignments(rows, lineages).unionByName(more, allowMissingColumns=True)


def plotted(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select(F.lit("f").alias("hmm"), F.concat(F.when(F.col("vec_id") % 9 == 0, "ANC|").otherwise("g|"), _text("vec_id")).alias("tip"), F.get("embedding", F.lit(0)).alias("UMAP1"), "vec_id", "label")
    clusters = rows.where("label > 2").select("hmm", "tip", F.col("label").alias("cluster_id"))
    clades = rows.where("vec_id % 2 = 0").select(F.lit("even").alias("clade"), "tip").unionByName(rows.where("vec_id % 3 = 0").select(F.lit("third").alias("clade"), "tip"))
    return embedspace.plot_points(rows.select("hmm", "tip", "UMAP1"), clusters, clades)


def genbank_features(spark, sf_dir):
    """Orders as coding sequences of GenBank records, one file a customer group, in parts of whole records by ranges of orders."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("k"), "o_orderpriority")
    orders = orders.repartitionByRange("k", "o_orderkey").withColumn("part", F.format_string("%08d", F.spark_partition_id()))
    record = Window.partitionBy("k", "part").orderBy("o_orderkey")
    begins, ends = F.row_number().over(record) == 1, F.lead(F.lit(False), 1, True).over(record)
    place = F.concat(_text("o_orderkey"), F.lit(".."), (F.col("o_orderkey") + 30).cast("string"))
    place = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("complement("), place, F.lit(")"))).otherwise(place)
    one = F.concat(F.lit("     CDS             "), place, F.lit('\n                     /locus_tag="o'), _text("o_orderkey"), F.lit('"\n                     /product="'), "o_orderpriority", F.lit('\n                     part"'))
    title = F.concat(F.lit("LOCUS       r"), _text("k"), F.lit("\nFEATURES             Location/Qualifiers\n     source          1..9\n"))
    rows = orders.withColumns({"begins": begins, "ends": ends}).sortWithinPartitions("k", "part", "o_orderkey")
    path = _folder(spark)
    rows.select("k", "part", F.concat(F.when(F.col("begins"), title).otherwise(""), one, F.when(F.col("ends"), "\nORIGIN\n//").otherwise("")).alias("value")).write.partitionBy("k", "part").text(path)
    found = features.read_genbank(spark, f"{path}/*/*", F.regexp_extract("path", "/(k=[^/]*)/[^/]*/[^/]*$", 1))
    return found.select("contig", F.col("ord").cast("long").alias("ord"), "start", "end", "strand", ids.first_present(F.col("attributes"), ("locus_tag",)).alias("id"), ids.first_present(F.col("attributes"), ("gene", "product")).alias("label"))


def pooled(spark, sf_dir):
    """Embeddings as sixteen tokens of four numbers, pooled without marks."""
    tokens = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice("embedding", i * 4 + 1, 4))
    mask = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: (i < F.col("vec_id") % 13 + 3).cast("int"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", embedspace.mean_pool(tokens, embedspace.special_mask(mask)).alias("v"))
    return rows.select("vec_id", F.posexplode("v").alias("j", "x")).select("vec_id", F.col("j").cast("long").alias("j"), F.round("x", 5).alias("x"))


def attention_profiles(spark, sf_dir):
    """Embeddings as an attention of eight tokens: what each of six residues receives, and what a motif of two does."""
    square = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8).cast("array<double>"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.array(F.array(square)).alias("a"))
    rows = rows.select("vec_id", motifs.profiles(F.col("a"), F.lit(6)).alias("p"), motifs.motif_scores(F.col("a"), F.array(F.lit(0), F.lit(3)), F.lit(2)).alias("s"))
    return rows.select("vec_id", F.round("s", 5).alias("score"), F.posexplode("p").alias("j", "x")).select("vec_id", "score", F.col("j").cast("long").alias("j"), F.round("x", 5).alias("x"))


def links_kept(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("identity"), (F.col("l_extendedprice") / 500).alias("bitscore"))
    return neighbourhood.similarity_links(rows).select("l_orderkey", "l_linenumber")


def source_of_hits(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return hits.preferred(rows.where("c_custkey < 0"), rows.where("c_mktsegment = 'BUILDING'")).unionByName(hits.preferred(rows.where("c_mktsegment = 'MACHINERY'"), rows))


def lineages_of_genomes(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.concat(F.lit("g"), (F.col("l_suppkey") % 40).cast("string"), F.lit(".faa.gz")).alias("genome"))
    known = _table(spark, sf_dir, "nation").select(F.concat(F.lit("g"), _text("n_nationkey")).alias("genome_key"), F.col("n_name").alias("taxonomy"))
    return taxonomy.genome_lineages(rows, known)


def pairs_asked(spark, sf_dir):
    return sites.clade_pairs(_table(spark, sf_dir, "nation").select(F.col("n_name").alias("clade"), F.col("n_nationkey").alias("ord")), "FRANCE:GERMANY, CHINA : background,")


def matching_features(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select("p_partkey", F.create_map(F.lit("ID"), F.array("p_brand", "p_type"), F.lit("locus_tag"), F.array(F.col("p_name"))).alias("a"))
    return rows.select("p_partkey", neighbourhood.matches(F.col("a"), F.lit("Brand#13")).alias("by_brand"), neighbourhood.matches(F.col("a"), F.lit("nothing"), ("ID", "gene")).alias("by_none"))


def rotated(spark, sf_dir):
    """All components of each label: their squares sum to the label's squared distances from its mean, and falling."""
    rows = _table(spark, sf_dir, "embeddings").select(_text("label").alias("hmm"), _text("vec_id").alias("tip"), F.col("embedding").alias("vector"))
    fitted = embedspace.fit_pca(rows, 64)
    points = embedspace.project(rows, fitted)
    square = F.aggregate("pc", F.lit(0.0), lambda acc, x: acc + x * x)
    first = F.aggregate(F.transform("pc", lambda x: x), F.lit(0.0), lambda acc, x: acc + x)
    sums = points.groupBy("hmm").agg(F.round(F.sum(square), 3).alias("spread"), (F.abs(F.sum(first)) < 1e-6).alias("centred"), F.count(F.lit(1)).alias("n"))
    share = F.col("explained_variance_ratio")
    falling = F.forall(F.sequence(F.lit(1), F.size(share) - 1), lambda i: F.get(share, i - 1) >= F.get(share, i))
    return sums.join(fitted.select("hmm", falling.alias("falling")), "hmm")


QUERIES = {
    "q30_fasta_records": fasta_records,
    "q31_proteomes": proteomes,
    "q32_domain_table": domain_table,
    "q33_projected_hits": projected_hits,
    "q34_threshold_file": threshold_file,
    "q35_manifest_file": manifest_file,
    "q36_profile_names": profile_names,
    "q37_taxonomy_files": taxonomy_files,
    "q38_clade_file": clade_file,
    "q39_hit_file": hit_file,
    "q40_cluster_file": cluster_file,
    "q41_gff_features": gff_features,
    "q42_state_file": state_file,
    "q43_cds_files": cds_of_genomes,
    "q44_annotation_files": annotation_of_genomes,
    "q45_alignment_files": alignment_of_families,
    "q46_tree_tips": tree_tips,
    "q47_ladder_order": ladder_order,
    "q48_common_ancestors": common_ancestors,
    "q49_tree_ordered": tree_ordered,
    "q50_cds_matches": cds_matches,
    "q51_codon_subsets": codon_subsets,
    "q52_kmers_at": kmers_at,
    "q53_kmer_summary": kmer_table,
    "q54_first_members": first_members,
    "q55_members_and_ancestors": members_and_ancestors,
    "q56_cluster_counts": assigned_counts,
    "q57_assignments": assignment_rows,
    "q58_mean_pool": pooled,
    "q59_attention": attention_profiles,
    "q60_similarity_links": links_kept,
    "q61_hit_source": source_of_hits,
    "q62_genome_lineages": lineages_of_genomes,
    "q63_pairs_asked": pairs_asked,
    "q64_feature_matches": matching_features,
    "q65_pca_spread": rotated,
    "q66_plot_points": plotted,
    "q67_genbank": genbank_features,
}

_FILES = "f AS (SELECT CASE WHEN s_suppkey%2=0 THEN 'x_' ELSE '' END || replace(s_name,'#','') || ['.fna','.ffn','.cds.x.fna','.gbff','.gff3'][s_suppkey%5+1] AS name FROM supplier), g AS (SELECT replace(s_name,'#','') AS k FROM supplier)"
_DOMAINS = "d AS (SELECT concat('g',l_suppkey,'~p',l_partkey) AS target, concat(l_returnflag,l_linestatus) AS query, l_linenumber AS ali_to, cast(l_extendedprice AS DOUBLE) AS score, cast(l_discount AS DOUBLE) AS ev FROM lineitem WHERE l_quantity>20)"
_TREE = "n AS (SELECT *, replace(n_name,' ','_') AS tip FROM nation WHERE n_nationkey%6>0)"

ORACLE_SQL = {
    "q30_fasta_records": "SELECT 'p|' || p_partkey AS seq_id, upper(replace(p_name,' ','')) AS sequence FROM part",
    "q31_proteomes": "SELECT 'n~s' || s_suppkey AS seq_id, regexp_replace(s_name,'[#0-9]','','g') AS sequence FROM supplier",
    "q32_domain_table": f"WITH {_DOMAINS} SELECT query, 50 AS tlen, 40 AS qlen, 1 AS ali_from, cast(ali_to AS INTEGER) AS ali_to, count(*) AS n, round(sum(score),2) AS score, round(sum(ev),2) AS evalues FROM d GROUP BY query, d.ali_to",
    "q33_projected_hits": f"WITH {_DOMAINS} SELECT 'scan' AS kind, 'g' AS genome, round(ali_to/40,6) AS coverage, count(*) AS n, count(DISTINCT query || target) AS pairs FROM d GROUP BY ali_to UNION ALL SELECT 'search', split_part(target,'~',1), round(ali_to/50,6), count(*), count(DISTINCT query || target) FROM d GROUP BY split_part(target,'~',1), ali_to",
    "q34_threshold_file": "SELECT 'r' || n_regionkey AS hmm, cast(max(n_nationkey) AS DOUBLE) AS min_score FROM nation WHERE n_nationkey%7<>0 GROUP BY n_regionkey",
    "q35_manifest_file": "SELECT DISTINCT c_mktsegment AS hmm FROM customer WHERE c_custkey%3=2",
    "q36_profile_names": "SELECT replace(n_name,' ','_') AS hmm FROM nation",
    "q37_taxonomy_files": "SELECT s_name AS genome_key, CASE WHEN s_suppkey%4=0 THEN 'own' ELSE 'd__' || s_nationkey END AS taxonomy FROM supplier",
    "q38_clade_file": "SELECT c_mktsegment AS clade, c_name AS tip FROM customer WHERE c_custkey%5>0",
    "q39_hit_file": "SELECT l_returnflag || l_linestatus AS hmm, cast(l_linenumber AS VARCHAR) AS extra, count(*) AS n, round(sum(cast(l_extendedprice AS DOUBLE)),2) AS score, round(sum(cast(l_tax AS DOUBLE)),2) AS coverage FROM lineitem GROUP BY l_returnflag || l_linestatus, l_linenumber",
    "q40_cluster_file": "SELECT 't' || vec_id AS seq_id, cast(label AS VARCHAR) AS clade_id FROM embeddings",
    "q41_gff_features": "SELECT 'c' || (o_custkey%3) AS contig, cast(o_orderkey AS INTEGER) AS start, cast(o_orderkey+9 AS INTEGER) AS \"end\", CASE WHEN o_orderstatus='O' THEN 1 ELSE -1 END AS strand, 'z' || o_orderkey AS id, o_orderpriority AS label FROM orders WHERE o_orderkey%3<>0 AND o_orderkey%11<>0",
    "q42_state_file": "SELECT 'N' || user_id AS node, cast(event_id%17 AS INTEGER) AS site, substr(event_type,1,1) AS state, count(*) AS n FROM events WHERE event_id%10>1 GROUP BY ALL",
    "q43_cds_files": f"WITH {_FILES}, m AS (SELECT k, name, CASE WHEN starts_with(name,k) AND ends_with(name,'.fna') THEN 3 WHEN starts_with(name,k) AND ends_with(name,'.ffn') THEN 4 WHEN ends_with(name,'.fna') THEN 7 END AS r FROM g JOIN f ON contains(name,k)) SELECT k || '.faa' AS genome, '/d/' || arg_min(name,(r,name)) AS path FROM m WHERE r IS NOT NULL GROUP BY k",
    "q44_annotation_files": f"WITH {_FILES} SELECT k || '.faa' AS genome, '/d/' || min(name) AS path FROM g JOIN f ON starts_with(name,k) AND contains(substr(name,length(k)+1),'.g') GROUP BY k",
    "q45_alignment_files": "WITH x AS (SELECT DISTINCT 'f' || (p_partkey%50) AS hmm, p_size%4 AS e FROM part), t AS (SELECT DISTINCT 'f' || (p_partkey%50) AS hmm FROM part WHERE p_size>10), r AS (SELECT hmm, min(CASE e WHEN 3 THEN 0 WHEN 1 THEN 1 WHEN 0 THEN 2 END) AS r FROM x WHERE e<>2 GROUP BY hmm) SELECT hmm, hmm || ['.clipkit.faa','.mafft.fasta','.afa'][r+1] AS name FROM r WHERE hmm IN (SELECT hmm FROM t)",
    "q46_tree_tips": f"WITH {_TREE}, s AS (SELECT n_regionkey AS r, '(' || string_agg(tip || ':1', ',' ORDER BY tip || ':1') || ')r' || n_regionkey AS t FROM n GROUP BY n_regionkey) SELECT n.tip, row_number() OVER (ORDER BY s.t, n.tip || ':1') - 1 AS place FROM n JOIN s ON n.n_regionkey=s.r",
    "q47_ladder_order": f"WITH {_TREE}, s AS (SELECT n_regionkey AS r, count(*) AS n, '(' || string_agg(tip || ':1', ',' ORDER BY tip || ':1') || ')r' || n_regionkey AS t FROM n GROUP BY n_regionkey) SELECT n, cast(coalesce(sum(n) OVER (ORDER BY n, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS first FROM s",
    "q48_common_ancestors": f"WITH {_TREE} SELECT DISTINCT CASE WHEN n_regionkey=4 THEN 'far' ELSE 'c' || n_regionkey END AS clade, 'ok' AS status, NULL::VARCHAR AS detail, CASE WHEN count(*) OVER (PARTITION BY n_regionkey)=1 THEN tip ELSE 'r' || n_regionkey END AS mrca_name FROM n UNION ALL SELECT 'wide','ok',NULL,'root' UNION ALL SELECT 'gone','missing_tips',string_agg(replace(n_name,' ','_'),',' ORDER BY n_nationkey),NULL FROM nation WHERE n_nationkey%6=0",
    "q49_tree_ordered": "SELECT cast(s_suppkey AS VARCHAR) AS genome, row_number() OVER (ORDER BY CASE WHEN s_suppkey%3=0 THEN -s_suppkey END NULLS LAST, s_suppkey) AS place FROM supplier WHERE s_suppkey<=200",
    "q50_cds_matches": "WITH p AS (SELECT p_partkey, 'q' || lpad(cast(p_partkey AS VARCHAR),4,'0') AS k FROM part WHERE p_partkey<=300 AND p_partkey%4<3) SELECT 'g|' || k AS tip, CASE p_partkey%4 WHEN 0 THEN k WHEN 1 THEN k || '_cds' ELSE 'lcl_' || k || '_x' END AS cds_name, CASE p_partkey%4 WHEN 0 THEN 0 WHEN 1 THEN 5 END AS rank, 'ATG' AS cds FROM p",
    "q51_codon_subsets": "WITH p AS (SELECT p_brand AS hmm, cast(p_partkey AS VARCHAR) AS tip, p_type AS cds, count(*) OVER (PARTITION BY p_brand) AS n FROM part WHERE p_size>25) SELECT hmm, tip, cds FROM p WHERE n>=40",
    "q52_kmers_at": "WITH x AS (SELECT p_partkey, p_name s, length(p_name) n, least(cast(floor((p_size*10%500)/500.0*length(p_name)) AS INTEGER), length(p_name)-1) AS place FROM part), y AS (SELECT *, least(n, greatest(0,place-2)+5) AS e FROM x) SELECT p_partkey, cast(place AS BIGINT) AS place, substr(s, greatest(0,e-5)+1, e-greatest(0,e-5)) AS kmer FROM y",
    "q53_kmer_summary": "SELECT substr(text,4,2) AS kmer, count(DISTINCT d.doc_id) AS n_sequences, round(avg(cast(quality AS DOUBLE)),6) AS delta, median(length(text)) AS med, arg_min(d.doc_id,(-quality,d.doc_id)) AS rep FROM documents d JOIN labels l ON d.doc_id=l.doc_id WHERE length(text)>=8 GROUP BY kmer ORDER BY avg(cast(quality AS DOUBLE)) DESC, kmer LIMIT 30",
    "q54_first_members": "SELECT l_returnflag || l_linestatus AS hmm, cast(l_suppkey AS VARCHAR) AS tip, l_orderkey || '-' || l_linenumber AS sequence FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_returnflag || l_linestatus, l_orderkey*10+l_linenumber)=1",
    "q55_members_and_ancestors": "SELECT n_name AS tip, CASE WHEN n_nationkey%4=0 THEN 'A' ELSE 'M' END AS sequence, CASE WHEN n_nationkey%4=0 THEN 'anc' ELSE cast(n_regionkey AS VARCHAR) END AS hmm FROM nation UNION ALL SELECT 'ANC|' || n_name, 'A', 'anc' FROM nation WHERE n_nationkey%4=2",
    "q56_cluster_counts": "SELECT 'f' || (vec_id%3) AS hmm, count(DISTINCT CASE WHEN label<>0 THEN label END) AS n_clusters, count(*) FILTER (WHERE label=0) AS n_noise FROM embeddings GROUP BY vec_id%3",
    "q57_assignments": "WITH e AS (SELECT *, CASE WHEN vec_id%9=0 THEN 'ANC|f_N' ELSE concat('g',vec_id%7,'|p') END || vec_id AS tip FROM embeddings), a AS (SELECT *, split_part(tip,'|',1) AS genome, substr(tip,strpos(tip,'|')+1) AS protein, CASE WHEN vec_id%9=0 THEN 'ancestral' ELSE 'modern' END AS type FROM e) SELECT 'f' AS hmm, tip, protein, genome, label AS cluster_id, CASE WHEN vec_id%9>0 AND vec_id%7<5 THEN 'd__' || (vec_id%7) ELSE 'Unknown' END AS taxonomy, type FROM a UNION ALL SELECT 'combined', tip, protein, genome, label, '', type FROM a WHERE label<3",
    "q58_mean_pool": "WITH e AS (SELECT vec_id, vec_id%13+3 AS n, cast(embedding AS DOUBLE[]) AS v FROM embeddings), x AS (SELECT vec_id, n, v, unnest(range(4)) AS j FROM e) SELECT vec_id, j, round(list_sum(list_transform(range(1,n-1), lambda i: v[i*4+j+1]))/(n-2),5) AS x FROM x",
    "q59_attention": "WITH e AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS v FROM embeddings), x AS (SELECT vec_id, v, unnest(range(6)) AS j FROM e) SELECT vec_id, round((list_sum(list_transform(range(8), lambda i: v[i*8+2]+v[i*8+3]))/8+list_sum(list_transform(range(8), lambda i: v[i*8+5]+v[i*8+6]))/8)/2,5) AS score, j, round(list_sum(list_transform(range(1,7), lambda i: v[i*8+j+2])),5) AS x FROM x",
    "q60_similarity_links": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity>=30 AND l_extendedprice/500>=50",
    "q61_hit_source": "SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment='BUILDING' THEN 'hmmsearch' ELSE 'hmmscan' END AS source FROM customer WHERE c_mktsegment IN ('BUILDING','MACHINERY')",
    "q62_genome_lineages": "SELECT DISTINCT concat('g',l_suppkey%40,'.faa.gz') AS genome, coalesce(n_name,'Unknown') AS taxonomy FROM lineitem LEFT JOIN nation ON n_nationkey=l_suppkey%40",
    "q63_pairs_asked": "SELECT * FROM (VALUES ('FRANCE','GERMANY'),('CHINA','background')) v(a,b)",
    "q64_feature_matches": "SELECT p_partkey, p_brand='Brand#13' AS by_brand, false AS by_none FROM part",
    "q66_plot_points": "WITH e AS (SELECT *, CASE WHEN vec_id%9=0 THEN 'ANC|' ELSE 'g|' END || vec_id AS tip FROM embeddings) SELECT 'f' AS hmm, tip, embedding[1] AS \"UMAP1\", CASE WHEN vec_id%9=0 THEN 'ancestral' ELSE 'modern' END AS type, CASE WHEN label>2 THEN label END AS cluster_id, CASE WHEN vec_id%6=0 THEN 'even,third' WHEN vec_id%2=0 THEN 'even' WHEN vec_id%3=0 THEN 'third' END AS clade FROM e",
    "q67_genbank": "SELECT 'r' || (o_custkey%5) AS contig, row_number() OVER (PARTITION BY o_custkey%5 ORDER BY o_orderkey)-1 AS ord, cast(o_orderkey-1 AS INTEGER) AS start, cast(o_orderkey+30 AS INTEGER) AS \"end\", CASE WHEN o_orderkey%2=0 THEN -1 ELSE 1 END AS strand, 'o' || o_orderkey AS id, o_orderpriority || ' part' AS label FROM orders",
    "q65_pca_spread": "WITH x AS (SELECT vec_id, label, unnest(range(64)) AS j, cast(unnest(embedding) AS DOUBLE) AS v FROM embeddings), m AS (SELECT label, j, avg(v) AS m FROM x GROUP BY label, j) SELECT cast(x.label AS VARCHAR) AS hmm, round(sum((v-m)*(v-m)),3) AS spread, true AS centred, count(DISTINCT vec_id) AS n, true AS falling FROM x JOIN m ON x.label=m.label AND x.j=m.j GROUP BY x.label",
}
