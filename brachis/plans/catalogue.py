"""The registered queries of the protein-family operators and their oracle SQL.

The supplied tables are not biological: adapters give them the shape that the operators expect (see README), and every
query goes through the operators themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..functions import sequences as seq
from ..operators import ancestral, codon, embedspace, hits, members, motifs, neighbourhood, sites, taxonomy
from . import catalogue_files

TIES = ("hmm", "ok", "ln", "sd", "evalue", "coverage")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a hit table: supplier as genome, part as protein, flags as profile."""
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("genome"),
        F.col("l_partkey").alias("protein"),
        F.concat("l_returnflag", "l_linestatus").alias("hmm"),
        (F.col("l_extendedprice") / 100).alias("bitscore"),
        F.col("l_discount").alias("evalue"),
        (F.col("l_quantity") / 50).alias("coverage"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_shipdate").alias("sd"),
    )


def _lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineages of suppliers, those of one region left out."""
    place = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region").where("r_name <> 'AFRICA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    both = _table(spark, sf_dir, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    return both.select(F.col("s_suppkey").alias("genome_key"), F.concat(F.lit("d__"), "r_name", F.lit(";p__"), "n_name").alias("taxonomy"))


def _alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's whole text as an alignment row."""
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("tip"), "lang", F.col("text").alias("aligned"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competitive best hits with lineage, in one plan."""
    best = hits.best_hits(hits.filter_hits(_hits(spark, sf_dir)), TIES)
    out = taxonomy.with_lineage(best, _lineages(spark, sf_dir), normalise=False)
    return out.select("genome", "protein", "hmm", "bitscore", "evalue", "coverage", F.round("delta_bitscore", 4).alias("delta_bitscore"), "taxonomy")


def best_hits(spark, sf_dir):
    best = hits.best_hits(hits.filter_hits(_hits(spark, sf_dir)), TIES)
    return best.select("genome", "protein", "hmm", "bitscore", F.round("delta_bitscore", 4).alias("delta_bitscore"))


def top_genome_profile(spark, sf_dir):
    return hits.top_members(_hits(spark, sf_dir), order=("protein", *TIES[1:])).select("genome", "hmm", "protein", "bitscore")


def threshold_default(spark, sf_dir):
    own = _table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("hmm"), (F.col("p_size") * 20).cast("double").alias("min_score"))
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("hmm"), (F.col("l_extendedprice") / 100).alias("bitscore"))
    return hits.filter_hits(rows, own, min_coverage=0).select("l_orderkey", "l_linenumber", F.col("hmm").alias("l_partkey"), "bitscore", "min_score_required")


def gene_window(spark, sf_dir):
    found = neighbourhood.ordinal_window(_table(spark, sf_dir, "events"), F.col("event_type") == "error", ["user_id"], ["ts", "event_id"], 2, F.col("event_id"))
    return found.select("focal", "event_id", "off", "is_focal")


def site_divergence(spark, sf_dir):
    alignment = _alignment(spark, sf_dir)
    clades = alignment.where(F.col("lang").isin("en", "de")).select(F.col("lang").alias("clade"), "tip")
    pairs = spark.createDataFrame([("en", "de")], "a string, b string")
    found = sites.alignment_divergence(alignment.drop("lang"), clades, pairs, by=())
    return found.select(F.col("site_1based").cast("long").alias("site"), F.round("kl_bits", 6).alias("kl_bits"), F.col("nA").alias("na"), F.col("nB").alias("nb"))


def site_conservation(spark, sf_dir):
    long = sites.sites(_alignment(spark, sf_dir).withColumnRenamed("lang", "hmm"))
    found = sites.conservation(long)
    return found.select("hmm", "scope", F.col("site_1based").cast("long").alias("site_1based"), F.round("conservation", 6).alias("conservation"))


def clade_dispersion(spark, sf_dir):
    points = _table(spark, sf_dir, "embeddings").select(F.lit("all").alias("hmm"), F.col("vec_id").alias("tip"), "label", F.col("embedding").alias("pc"))
    found = embedspace.dispersion(points, points.select(F.col("label").alias("clade"), "tip"))
    return found.select(F.col("clade").alias("label"), "n", F.round("mean_dist_to_centroid", 6).alias("mean_d"), F.round("median_dist_to_centroid", 6).alias("median_d"))


def motif_places(spark, sf_dir):
    found = _table(spark, sf_dir, "documents").select("doc_id", F.explode(seq.motif_positions(F.lower("text"), F.lit("th"))).alias("p"))
    return found.select("doc_id", F.col("p").cast("long").alias("start_pos"), (F.col("p") + 2).cast("long").alias("end_pos"))


def motif_rows(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.col("lang").alias("hmm"), F.col("doc_id").cast("string").alias("seq_id"), F.col("text").alias("sequence"))
    clusters = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("seq_id"), F.col("quality").cast("string").alias("clade_id"))
    found = motifs.score_motifs(docs, ["the", "ß"], clusters)
    return found.groupBy("hmm", "seq_id", "motif", "motif_present", "clade_id", "type").agg(F.count(F.lit(1)).alias("n_rows"), F.min("start_pos").cast("long").alias("first_start"), F.max("end_pos").cast("long").alias("last_end"))


def kmers(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), F.col("text").alias("sequence"))
    found = motifs.common_kmers(docs, 5, 50)
    return found.select("kmer", "n_sequences", F.round("mean_position", 6).alias("mean_p"), F.col("median_position").alias("med"), F.col("representative_seq_id").alias("rep"))


def lineage_default(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return taxonomy.with_lineage(rows, _lineages(spark, sf_dir), "l_suppkey", normalise=False)


def ordered_letters(spark, sf_dir):
    return ancestral.ordered_text(_table(spark, sf_dir, "conversations").select("conv_id", "turn", F.substr("role", F.lit(1), F.lit(1)).alias("s")), "conv_id", "turn", "s")


def ancestral_rows(spark, sf_dir):
    """Events as states: a user as node, the minute within ten as site, the first letter of the type as state."""
    states = _table(spark, sf_dir, "events").select(F.lit("f").alias("hmm"), F.col("user_id").cast("string").alias("node"), (F.col("event_id") % 17).cast("int").alias("site"), F.substr("event_type", F.lit(1), F.lit(1)).alias("state"), F.col("event_id").alias("ord"))
    return ancestral.ancestral_sequences(states, least=3)


def source_priority(spark, sf_dir):
    rows = _hits(spark, sf_dir)
    found = hits.first_source_wins([rows.where("coverage >= 0.5"), rows.where("bitscore >= 100")], order=(*TIES[1:], "bitscore"))
    return found.select("genome", "protein", "hmm", "src", "bitscore")


def prioritised_match(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    target = lambda c, like: part.where(F.col(c).like(like)).select(F.col(c).alias("name"))
    names = target("p_brand", "%3").unionByName(target("p_type", "E%")).unionByName(target("p_name", "s%"))
    rows = part.select(F.col("p_partkey").alias("id"), "p_brand", "p_type", "p_name")
    found = codon.first_match(rows, F.array("p_brand", "p_type", "p_name"), names, ["id"])
    return found.select("id", "found", F.col("rank").alias("rk"))


def representatives(spark, sf_dir):
    found = hits.representative_hits(_hits(spark, sf_dir), max_hits=20, order=("genome", "protein", *TIES[1:]))
    return found.select("hmm", "genome", "protein", "bitscore")


def family_members(spark, sf_dir):
    proteins = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("protein"), F.col("p_name").alias("sequence"), F.col("p_partkey").alias("ord"))
    rows = _hits(spark, sf_dir).select(F.col("genome").cast("string").alias("genome"), "protein", "hmm")
    genomes = _table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("genome"))
    own = rows.select("genome", "protein").distinct().join(proteins, "protein").join(genomes, "genome")
    return members.members(rows, own).select("hmm", "tip", "genome", "protein", "sequence")


def large_families(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("hmm"))
    return members.large_enough(rows, "hmm", 12)


def manifest_semi(spark, sf_dir):
    manifest = _table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("hmm"))
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("hmm"))
    return hits.keep_profiles(rows, manifest)


def genome_keys(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    ending = F.element_at(F.array(*map(F.lit, (".faa", ".faa.gz", ".cds.fna", ".GZ", ".gz.faa", "", ".fa.fasta.gz"))), (F.col("p_partkey") % 7 + 1).cast("int"))
    return part.select("p_partkey", ids.genome_key(F.concat("p_name", ending)).alias("genome_key"))


def split_ids(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat_ws("~", "p_brand", "p_type", "p_name"))
    genome, protein = ids.split_combined(name)
    tip = F.replace(name, F.lit("~"), F.lit("|"))
    return _table(spark, sf_dir, "part").select("p_partkey", genome.alias("genome"), protein.alias("protein"), ids.cds_id(tip).alias("after_last"), ids.cds_id(tip, "strip_pipe").alias("after_first"))


def cleaned(spark, sf_dir):
    text = F.concat(F.translate("p_name", " ", "*"), F.lit("-X.**--"))
    cds = F.concat("p_type", F.element_at(F.array(F.lit("taa"), F.lit("TAG"), F.lit("TAAC")), (F.col("p_partkey") % 3 + 1).cast("int")))
    return _table(spark, sf_dir, "part").select("p_partkey", seq.for_embedding(text).alias("embed"), seq.for_motifs(text).alias("motif"), seq.for_discovery(text).alias("discover"), seq.strip_protein_stop(text).alias("protein"), seq.trim_cds_stop(cds).alias("cds"))


def mean_profiles(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("profile"))
    found = motifs.mean_profile(rows, ["label"], points=100)
    return found.select("label", F.col("i").cast("long").alias("i"), F.round("value", 6).alias("value"))


def clade_pair_list(spark, sf_dir):
    clades = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("clade"), F.col("n_regionkey").alias("tip"), F.col("n_nationkey").cast("long").alias("ord"))
    return sites.clade_pairs(clades)


def tips_missing(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("tip"))
    clades = _table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("clade"), F.col("c_custkey").alias("tip"), F.col("c_custkey").alias("ord"))
    found = sites.missing_tips(clades, orders)
    return found.select("clade", "n_missing", F.array_join(F.transform("missing", lambda t: t.cast("string")), ",").alias("missing"))


def track_extent(spark, sf_dir):
    """A customer's orders as a track: each order a feature."""
    day = F.datediff("o_orderdate", F.lit("1990-01-01"))
    rows = _table(spark, sf_dir, "orders").select(F.lit("h").alias("hmm"), F.col("o_custkey").alias("genome"), F.lit(0).alias("focal"), "o_orderkey", day.alias("start"), (day + 30).alias("end"), F.lit(1).alias("strand"), (F.col("o_orderstatus") == "O").alias("is_focal"))
    return neighbourhood.tracks(rows).select("genome", "o_orderkey", F.col("rel_start").cast("long").alias("rel_start"), F.col("rel_end").cast("long").alias("rel_end"), F.col("track_size").cast("long").alias("track_size"), "colour")


def family_pca(spark, sf_dir):
    """Principal components by label: hmm, tip, genome, protein, PC1..PC3."""
    rows = _table(spark, sf_dir, "embeddings").select(F.concat(F.lit("f"), F.col("label").cast("string")).alias("hmm"), F.concat(F.lit("g|"), F.col("vec_id").cast("string")).alias("tip"), F.col("embedding").alias("vector"))
    fitted = embedspace.fit_pca(rows)
    return embedspace.coordinates(embedspace.project(rows, fitted), 3)


def family_clusters(spark, sf_dir):
    """Density clusters by label, with their table of assignments."""
    rows = _table(spark, sf_dir, "embeddings").select(F.concat(F.lit("f"), F.col("label").cast("string")).alias("hmm"), F.concat(F.lit("g|"), F.col("vec_id").cast("string")).alias("tip"), F.col("embedding").alias("vector"))
    return embedspace.assignments(embedspace.cluster(rows))


def discovered_motifs(spark, sf_dir):
    """k-mers at the peaks of quality 1 over quality 0, embeddings standing for attention profiles."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("seq_id"), F.col("doc_id").alias("ord"), F.col("text").alias("sequence"), "doc_id")
    both = docs.join(_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("clade_id")), "doc_id")
    both = both.join(_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("profile")), "doc_id")
    return motifs.discover_motifs(both, "0", "1")


_HITS = "h AS (SELECT l_suppkey genome, l_partkey protein, concat(l_returnflag,l_linestatus) hmm, l_extendedprice/100 bitscore, l_discount evalue, l_quantity/50 coverage, l_orderkey ok, l_linenumber ln, l_shipdate sd FROM lineitem)"
_LINEAGE = "SELECT s_suppkey k, concat('d__',r_name,';p__',n_name) lin FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey WHERE r_name<>'AFRICA'"
_BEST = f"WITH {_HITS}, r AS (SELECT *, row_number() OVER w rn, lead(bitscore) OVER w nx FROM h WHERE coverage>=0.5 AND bitscore>=25 WINDOW w AS (PARTITION BY genome,protein ORDER BY bitscore DESC, hmm, ok, ln, sd, evalue, coverage))"
_SITES = """al AS (SELECT unnest(string_split('A,C,D,E,F,G,H,I,K,L,M,N,P,Q,R,S,T,V,W,Y',',')) a),
x AS (SELECT doc_id, lang, upper(substr(text,s,1)) aa, s site FROM (SELECT doc_id,lang,text,unnest(range(1,length(text)+1)) s FROM documents))"""

QUERIES = {
    "flagship": flagship,
    "q1_best_hits": best_hits,
    "q2_top_genome_profile": top_genome_profile,
    "q3_threshold_default": threshold_default,
    "q4_gene_window": gene_window,
    "q5_site_divergence": site_divergence,
    "q6_clade_dispersion": clade_dispersion,
    "q7_motif_places": motif_places,
    "q8_kmers": kmers,
    "q9_lineage_default": lineage_default,
    "q10_ordered_letters": ordered_letters,
    "q11_source_priority": source_priority,
    "q12_prioritised_match": prioritised_match,
    "q13_site_conservation": site_conservation,
    "q14_representatives": representatives,
    "q15_family_members": family_members,
    "q16_large_families": large_families,
    "q17_manifest_semi": manifest_semi,
    "q18_genome_keys": genome_keys,
    "q19_split_ids": split_ids,
    "q20_cleaned": cleaned,
    "q21_mean_profiles": mean_profiles,
    "q22_clade_pairs": clade_pair_list,
    "q23_tips_missing": tips_missing,
    "q24_track_extent": track_extent,
    "q25_motif_rows": motif_rows,
    "q26_ancestral_rows": ancestral_rows,
    "q27_family_pca": family_pca,
    "q28_family_clusters": family_clusters,
    "q29_discovered_motifs": discovered_motifs,
}

#: q27 to q29 are iterative; tests hold them against plain numpy.
ORACLE_SQL: dict[str, str] = {
    "flagship": f"{_BEST} SELECT genome,protein,hmm,bitscore,evalue,coverage,round(bitscore-coalesce(nx,0),4) delta_bitscore, coalesce(lin,'Unknown') taxonomy FROM r LEFT JOIN ({_LINEAGE}) t ON genome=k WHERE rn=1",
    "q1_best_hits": f"{_BEST} SELECT genome,protein,hmm,bitscore,round(bitscore-coalesce(nx,0),4) delta_bitscore FROM r WHERE rn=1",
    "q2_top_genome_profile": f"WITH {_HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY genome,hmm ORDER BY bitscore DESC, protein, ok, ln, sd, evalue, coverage) rn FROM h) SELECT genome,hmm,protein,bitscore FROM r WHERE rn=1",
    "q3_threshold_default": "WITH t AS (SELECT p_partkey k, cast(p_size*20 AS double) thr FROM part WHERE p_size>25) SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice/100 bitscore, coalesce(thr,25.0) min_score_required FROM lineitem LEFT JOIN t ON l_partkey=k WHERE l_extendedprice/100>=coalesce(thr,25.0)",
    "q4_gene_window": "WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts,event_id) i FROM events), f AS (SELECT user_id u, i fi, event_id fid FROM e WHERE event_type='error') SELECT f.fid focal, e.event_id, e.i-f.fi off, (e.i=f.fi) is_focal FROM f JOIN e ON e.user_id=f.u AND e.i BETWEEN f.fi-2 AND f.fi+2",
    "q5_site_divergence": f"""WITH {_SITES}, cnt AS (SELECT lang, site, aa, count(*) n FROM x WHERE aa IN (SELECT a FROM al) GROUP BY lang,site,aa), st AS (SELECT DISTINCT site FROM x),
g AS (SELECT st.site, al.a, coalesce(p.n,0) pn, coalesce(q.n,0) qn FROM st CROSS JOIN al LEFT JOIN cnt p ON p.site=st.site AND p.aa=al.a AND p.lang='en' LEFT JOIN cnt q ON q.site=st.site AND q.aa=al.a AND q.lang='de'),
t AS (SELECT *, sum(pn) OVER (PARTITION BY site) pt, sum(qn) OVER (PARTITION BY site) qt FROM g)
SELECT site, round(sum((pn+1e-6)/(pt+2e-5)*log2(((pn+1e-6)/(pt+2e-5))/((qn+1e-6)/(qt+2e-5)))),6) kl_bits, cast(max(pt) as bigint) na, cast(max(qt) as bigint) nb FROM t GROUP BY site""",
    "q6_clade_dispersion": """WITH x AS (SELECT vec_id,label,unnest(range(len(embedding))) j,cast(unnest(embedding) as double) v FROM embeddings), ce AS (SELECT label,j,avg(v) m FROM x GROUP BY label,j), dd AS (SELECT x.label,x.vec_id,sqrt(sum((v-m)*(v-m))) d FROM x JOIN ce ON x.label=ce.label AND x.j=ce.j GROUP BY x.label,x.vec_id)
SELECT label, count(*) n, round(avg(d),6) mean_d, round(median(d),6) median_d FROM dd GROUP BY label HAVING count(*)>=3""",
    "q7_motif_places": "SELECT doc_id, i-1 start_pos, i+1 end_pos FROM (SELECT doc_id, lower(text) s, unnest(range(1,greatest(length(text),1)+1)) i FROM documents) WHERE substr(s,i,2)='th'",
    "q8_kmers": "SELECT k kmer, count(distinct doc_id) n_sequences, round(avg(cast(p as double)),6) mean_p, median(p) med, min(doc_id) rep FROM (SELECT doc_id,p,substr(text,p,5) k FROM (SELECT doc_id,text,unnest(range(1,length(text)-3)) p FROM documents)) GROUP BY k ORDER BY n_sequences DESC,kmer LIMIT 50",
    "q9_lineage_default": f"SELECT l.l_orderkey,l.l_linenumber,l.l_suppkey,l.l_partkey,coalesce(t.lin,'Unknown') taxonomy FROM lineitem l LEFT JOIN ({_LINEAGE}) t ON l.l_suppkey=t.k",
    "q10_ordered_letters": "SELECT conv_id, string_agg(substr(role,1,1),'' ORDER BY turn) seq FROM conversations GROUP BY conv_id",
    "q11_source_priority": f"WITH {_HITS}, u AS (SELECT 0 src,* FROM h WHERE coverage>=0.5 UNION ALL SELECT 1 src,* FROM h WHERE bitscore>=100), r AS (SELECT *,row_number() OVER (PARTITION BY genome,protein,hmm ORDER BY src,ok,ln,sd,evalue,coverage,bitscore) rn FROM u) SELECT genome,protein,hmm,src,bitscore FROM r WHERE rn=1",
    "q12_prioritised_match": "WITH c AS (SELECT p_partkey id,0 rk,p_brand k FROM part UNION ALL SELECT p_partkey,1,p_type FROM part UNION ALL SELECT p_partkey,2,p_name FROM part), tgt AS (SELECT DISTINCT p_brand k FROM part WHERE p_brand LIKE '%3' UNION SELECT DISTINCT p_type FROM part WHERE p_type LIKE 'E%' UNION SELECT DISTINCT p_name FROM part WHERE p_name LIKE 's%'), m AS (SELECT id,rk,c.k, row_number() OVER (PARTITION BY id ORDER BY rk) rn FROM c JOIN tgt ON c.k=tgt.k) SELECT id,k found,rk FROM m WHERE rn=1",
    "q13_site_conservation": f"WITH {_SITES}, c AS (SELECT lang, site, aa, count(*) n FROM x WHERE aa IN (SELECT a FROM al) GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY lang, site) s FROM c), st AS (SELECT DISTINCT lang, site FROM x), e AS (SELECT lang, site, 1 + sum(n/s*ln(n/s))/ln(20) v FROM t GROUP BY lang, site) SELECT st.lang hmm, 'global' scope, st.site site_1based, round(v,6) conservation FROM st LEFT JOIN e ON e.lang=st.lang AND e.site=st.site",
    "q14_representatives": f"WITH {_HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY genome,hmm ORDER BY bitscore DESC, genome, protein, ok, ln, sd, evalue, coverage) rn FROM h), s AS (SELECT *, row_number() OVER (PARTITION BY hmm ORDER BY bitscore DESC, genome, protein, ok, ln, sd, evalue, coverage) k FROM r WHERE rn=1) SELECT hmm,genome,protein,bitscore FROM s WHERE k<=20",
    "q15_family_members": f"WITH {_HITS} SELECT DISTINCT hmm, concat(genome,'|',protein) tip, cast(genome as varchar) genome, protein, p_name sequence FROM h JOIN part ON p_partkey=protein JOIN supplier ON s_suppkey=genome WHERE s_acctbal>0",
    "q16_large_families": "WITH c AS (SELECT c_custkey, concat(c_mktsegment,'-',c_nationkey) hmm FROM customer) SELECT * FROM c WHERE hmm IN (SELECT hmm FROM c GROUP BY hmm HAVING count(*)>=12)",
    "q17_manifest_semi": "SELECT c_custkey, c_nationkey hmm FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey=1)",
    "q18_genome_keys": "SELECT p_partkey, regexp_replace(regexp_replace(p_name || ['.faa','.faa.gz','.cds.fna','.GZ','.gz.faa','','.fa.fasta.gz'][p_partkey%7+1], '(?i)\\.gz$', ''), '(?i)(\\.(faa|fna|fa|fasta|ffn|cds))+$', '') genome_key FROM part",
    "q19_split_ids": "WITH n AS (SELECT p_partkey, CASE WHEN p_partkey%3=0 THEN p_brand ELSE concat_ws('~',p_brand,p_type,p_name) END s FROM part) SELECT p_partkey, CASE WHEN contains(s,'~') THEN split_part(s,'~',1) ELSE 'Unknown' END genome, CASE WHEN contains(s,'~') THEN substr(s,strpos(s,'~')+1) ELSE s END protein, split_part(s,'~',-1) after_last, CASE WHEN contains(s,'~') THEN replace(substr(s,strpos(s,'~')+1),'~','|') ELSE s END after_first FROM n",
    "q20_cleaned": "WITH t AS (SELECT p_partkey, replace(p_name,' ','*') || '-X.**--' s, p_type || ['taa','TAG','TAAC'][p_partkey%3+1] c FROM part) SELECT p_partkey, translate(s,' *.','') embed, translate(s,'*-X','') motif, translate(s,'*-','') discover, replace(rtrim(rtrim(rtrim(s,'-'),'*'),'-'),'*','') protein, regexp_replace(replace(c,' ',''),'(?i)(TAA|TAG|TGA)$','') cds FROM t",
    "q21_mean_profiles": "WITH g AS (SELECT label, unnest(range(100)) i, cast(embedding AS double[]) e FROM embeddings), p AS (SELECT label, i, e, i*(len(e)-1)/99.0::double x FROM g), q AS (SELECT label, i, e, x, cast(floor(x) as bigint) lo FROM p) SELECT label, i, round(avg(e[lo+1] + (e[least(lo+2,len(e))]-e[lo+1])*(x-lo)),6) AS value FROM q GROUP BY label, i",
    "q22_clade_pairs": "SELECT x.n_name a, y.n_name b FROM nation x JOIN nation y ON x.n_nationkey<y.n_nationkey",
    "q23_tips_missing": "WITH m AS (SELECT c_mktsegment clade, c_custkey t FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice>250000)) SELECT clade, count(*) n_missing, array_to_string(list(t ORDER BY t)[1:10],',') missing FROM m GROUP BY clade",
    "q24_track_extent": "WITH o AS (SELECT *, date_diff('day', DATE '1990-01-01', cast(o_orderdate AS date)) s FROM orders), w AS (SELECT *, min(s) OVER (PARTITION BY o_custkey) lo, max(s+30) OVER (PARTITION BY o_custkey) hi FROM o) SELECT o_custkey genome, o_orderkey, s-lo rel_start, s+30-lo rel_end, hi-lo+1 track_size, CASE WHEN o_orderstatus='O' THEN 'tomato' ELSE 'skyblue' END colour FROM w",
    "q25_motif_rows": "WITH d AS (SELECT lang hmm, cast(doc_id as varchar) seq_id, doc_id, translate(text,'*-X','') s FROM documents), m AS (SELECT * FROM d, (VALUES ('the'),('ß')) v(motif) WHERE length(s)>=10), p AS (SELECT *, list_filter(range(0, greatest(length(s)-length(motif)+1,0)), lambda i: substr(s,i+1,length(motif))=motif) pos FROM m) SELECT hmm, seq_id, motif, len(pos)>0 motif_present, coalesce(cast(quality as varchar),'') clade_id, 'modern' AS type, cast(greatest(len(pos),1) as bigint) n_rows, coalesce(list_min(pos),-1) first_start, coalesce(list_max(pos)+length(motif),-1) last_end FROM p LEFT JOIN labels ON labels.doc_id=p.doc_id",
    "q26_ancestral_rows": "WITH e AS (SELECT user_id u, event_id%17 site, arg_max(substr(event_type,1,1), event_id) st FROM events GROUP BY ALL), l AS (SELECT u, max(site) last FROM e WHERE site>=1 GROUP BY u), g AS (SELECT u, unnest(range(1,last+1)) site FROM l), s AS (SELECT g.u, string_agg(coalesce(st,'X'),'' ORDER BY g.site) q FROM g LEFT JOIN e ON e.u=g.u AND e.site=g.site GROUP BY g.u) SELECT 'f' hmm, cast(u as varchar) node, concat('ANC|f_',u) tip, q sequence FROM s WHERE length(translate(q,'-X',''))>=3",
}

QUERIES |= catalogue_files.QUERIES
ORACLE_SQL |= catalogue_files.ORACLE_SQL
