import pytest
from pyspark.sql import functions as F

from brachis.plans import catalogue_files
from brachis.sources import fasta, features, files, tables
from tests.oracle import compare

GFF = "##gff-version 3\nc1\tsrc\tCDS\t100\t200\t.\t+\t0\tID=prot1;locus_tag=L1;product=first\nc1\tsrc\tgene\t100\t200\t.\t+\t0\tID=gene1\nc1\tsrc\tCDS\t300\t400\t.\t-\t0\tID=prot2;locus_tag=L2;ID=prot2b\nc2\tsrc\tCDS\t10\t90\t.\t+\t0\tID=prot3;note=a=b\nshort\tline\n"
GENBANK = """LOCUS       CTG1   900 bp
VERSION     CTG1.1
FEATURES             Location/Qualifiers
     CDS             10..90
                     /locus_tag="A1"
                     /protein_id="p1"
                     /translation="MKV
                     LLA"
     gene            10..90
     CDS             complement(100..190)
                     /locus_tag="A2"
                     /product="two
                     words"
     CDS             join(200..240,250..300)
                     /locus_tag="A3"
ORIGIN
        1 acgt
//
"""


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_read_fasta(spark, tmp_path):
    write(tmp_path, "a.faa", "junk\n>s1 first one\nMK\n\nVL\n>s2\nAA\n>s1 again\nGG\n>s3\n")
    write(tmp_path, "b.faa", ">t1\nMSKGEELFT")
    write(tmp_path, "empty.faa", "")
    rows = fasta.read_fasta(spark, str(tmp_path), "*.faa").orderBy("file", "ord").collect()
    assert [(r.file, r.seq_id, r.sequence) for r in rows] == [("a.faa", "s1", "GG"), ("a.faa", "s2", "AA"), ("a.faa", "s3", ""), ("b.faa", "t1", "MSKGEELFT")]
    one = fasta.read_proteomes(spark, str(tmp_path)).where("genome = 'b.faa'").first()
    assert (one.protein, one.sequence) == ("t1", "MSKGEELFT")


def test_fasta_order_over_splits(spark, tmp_path):
    text = "".join(f">s{k} x\nMK{'A' * (k % 50)}\nVL\n" for k in range(3000))
    write(tmp_path, "big.faa", text)
    write(tmp_path, "small.faa", ">t\nM\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = fasta.read_fasta(spark, str(tmp_path), "*.faa").where("file = 'big.faa'").orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.seq_id, r.sequence) for r in rows] == [(f"s{k}", f"MK{'A' * (k % 50)}VL") for k in range(3000)]


def test_fasta_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("seq1", "MSKGEELFT", 0), ("seq2", "MVSKGEELFT", 1)], "seq_id string, sequence string, ord long")
    fasta.write_fasta(rows, str(tmp_path / "out"), order=["ord"])
    back = fasta.read_fasta(spark, str(tmp_path / "out"), "part-*").select("seq_id", "sequence").collect()
    assert sorted(map(tuple, back)) == [("seq1", "MSKGEELFT"), ("seq2", "MVSKGEELFT")]


def test_read_domains(spark, tmp_path):
    line = "famA - 100 prot1 - 200 1e-10 55.5 0.1 1 2 1e-9 1e-9 50.1 0.1 1 90 {} {} 5 99 0.9 some text # tail\n"
    path = write(tmp_path, "g.domtblout", "# title\n" + line.format(11, 110) + line.format(120, 160) + "bad line\n")
    rows = tables.read_domains(spark, path).orderBy("ali_from").collect()
    assert [tuple(r)[1:] for r in rows] == [("famA", 100, "prot1", 200, 1e-10, 55.5, 11, 110), ("famA", 100, "prot1", 200, 1e-10, 55.5, 120, 160)]


def test_thresholds_manifest_names(spark, tmp_path):
    path = write(tmp_path, "t.tsv", "# c\nA 10\nB\t20 more\nA 30\nalone\n\n")
    assert dict(map(tuple, tables.read_thresholds(spark, path).collect())) == {"A": 30.0, "B": 20.0}
    path = write(tmp_path, "m.txt", "# comment\nHMM_A\n HMM_B \n\nHMM_A\n")
    assert {r.hmm for r in tables.read_manifest(spark, path).collect()} == {"HMM_A", "HMM_B"}
    assert tables.read_manifest(spark, None) is None
    (tmp_path / "p").mkdir()
    write(tmp_path / "p", "x.hmm", "HMMER3\nNAME  famX\nNAME other\n")
    assert [r.hmm for r in tables.read_profile_names(spark, str(tmp_path / "p")).collect()] == ["famX"]


def test_read_taxonomy(spark, tmp_path):
    write(tmp_path, "gtdbtk.bac.summary.tsv", "user_genome\tclassification\ngenomeA.faa\tTaxA\ngenomeB\tTaxB\n")
    own = write(tmp_path, "own.tsv", "genome\tlineage\ngenomeB.fna\tMine\n")
    assert dict(map(tuple, tables.read_taxonomy(spark, str(tmp_path)).collect())) == {"genomeA": "TaxA", "genomeB": "TaxB"}
    assert dict(map(tuple, tables.read_taxonomy(spark, str(tmp_path), own).collect())) == {"genomeA": "TaxA", "genomeB": "Mine"}
    assert tables.read_taxonomy(spark).count() == 0
    wrong = write(tmp_path, "wrong.tsv", "a\tb\n1\t2\n")
    assert tables.read_taxonomy(spark, None, wrong).count() == 0


def test_read_clades_and_states(spark, tmp_path):
    path = write(tmp_path, "c.tsv", "clade_name\ttip\nx\tt1\nx\tt1\ny\t\n")
    assert [(r.clade, r.tip) for r in tables.read_clades(spark, path).orderBy("ord").collect()] == [("x", "t1"), ("x", "t1")]
    with pytest.raises(ValueError):
        tables.read_clades(spark, write(tmp_path, "d.tsv", "a\tb\n1\t2\n"))
    path = write(tmp_path, "famA.state", "# c\nNode\tSite\tState\tp_A\nN1\t1\tM\t0.9\nN1\t3\tK\t0.9\nN2 1 L 0.1\nshort\n")
    assert sorted(map(tuple, tables.read_states(spark, path).select("hmm", "node", "site", "state").collect())) == [("famA", "N1", 1, "M"), ("famA", "N1", 3, "K"), ("famA", "N2", 1, "L")]


def test_hit_table_round_trip(spark, tmp_path):
    path = str(tmp_path / "hits")
    assert tables.read_hits(spark, path).count() == 0
    rows = spark.createDataFrame([("g", "p", "h", 1.5, 0.1, 0.9)], "genome string, protein string, hmm string, bitscore double, evalue double, coverage double")
    assert not tables.write_table(rows.limit(0), path)
    assert tables.write_table(rows, path)
    assert tuple(tables.read_hits(spark, path).first()) == ("g", "p", "h", 1.5, 0.1, 0.9)


def test_read_gff(spark, tmp_path):
    rows = features.read_gff(spark, write(tmp_path, "g.gff", GFF)).orderBy("ord").collect()
    assert [(r.contig, r.start, r.end, r.strand) for r in rows] == [("c1", 100, 200, 1), ("c1", 300, 400, -1), ("c2", 10, 90, 1)]
    assert rows[1].attributes["ID"] == ["prot2b"] and rows[2].attributes["note"] == ["a=b"]


def test_read_genbank(spark, tmp_path):
    write(tmp_path, "g.gbk", GENBANK)
    rows = features.read_genbank(spark, str(tmp_path / "g.gbk")).orderBy("ord").collect()
    assert [(r.contig, r.start, r.end, r.strand) for r in rows] == [("CTG1.1", 9, 90, 1), ("CTG1.1", 99, 190, -1), ("CTG1.1", 199, 300, 1)]
    assert rows[0].attributes["translation"] == ["MKVLLA"] and rows[1].attributes["product"] == ["two words"]


def test_genbank_over_splits(spark, tmp_path):
    cds = lambda k: f'     CDS             complement({k + 1}..{k + 9},\n                     {k + 20}..{k + 30})\n                     /locus_tag="L{k}"\n     gene            1..2\n                     /note="é\n                     /no=key"\n'
    sequence = "".join(f"{k * 60 + 1:>9} {'acgt' * 15}\n" for k in range(30))
    record = lambda r: f"LOCUS       C{r}\nVERSION     C{r}.{r}\nSOURCE      x\n  ORGANISM  y\nFEATURES             Location/Qualifiers\n{''.join(map(cds, range(20)))}ORIGIN\n{sequence}//\n"
    text = "".join(map(record, range(5)))
    write(tmp_path, "a big.gbk", text)
    write(tmp_path, "cut.gbk", text[:900])
    write(tmp_path, "empty.gbk", "")
    (tmp_path / "junk.gbk").write_bytes(bytes(range(256)) * 9)
    wanted = [(f, k, *x) for f, t in (("a big.gbk", text), ("cut.gbk", text[:900])) for k, x in enumerate(features.parse_genbank(t))]
    assert wanted[99][:3] == ("a big.gbk", 99, "C4.4")
    for size in ("1500", "20000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            read = features.read_genbank(spark, f"{tmp_path}/*.gb*")
            assert sorted(map(tuple, read.collect())) == wanted
            assert read.where("file = 'a big.gbk'").select(F.spark_partition_id()).distinct().count() > 1  # one file, several tasks
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_genbank_query_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue_files, "_folder", lambda _: str(tmp_path / "g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compare(spark, "/root/testdata/sf0.001", "q67_genbank", catalogue_files.QUERIES["q67_genbank"], catalogue_files.ORACLE_SQL["q67_genbank"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = [p.read_text() for p in tmp_path.glob("g/k=*/**/part-*")]
    assert len(texts) > 5  # a group is not one task's text
    assert all(t.startswith("LOCUS") and t.endswith("ORIGIN\n//\n") for t in texts)


def test_cds_and_annotation_files(spark, tmp_path):
    names = ["g1.fna", "g1.ffn", "x_g2.fna", "g3.cds.part.fna", "g3.gbff", "g3.gff3"]
    listed = spark.createDataFrame([(f"/d/{n}", n) for n in names], "path string, name string")
    genomes = spark.createDataFrame([("g1.faa",), ("g2.faa",), ("g3.faa",), ("g4",)], "genome string")
    assert dict(map(tuple, files.cds_files(genomes, listed).collect())) == {"g1.faa": "/d/g1.fna", "g2.faa": "/d/x_g2.fna", "g3.faa": "/d/g3.cds.part.fna"}
    assert dict(map(tuple, files.annotation_files(genomes, listed, ".gb").collect())) == {"g3.faa": "/d/g3.gbff"}
    both = spark.createDataFrame([("/a/f.afa", "f.afa"), ("/a/f.clipkit.faa", "f.clipkit.faa"), ("/a/h.mafft.fasta", "h.mafft.fasta")], "path string, name string")
    assert {r.hmm: r.path for r in files.alignment_files(both).collect()} == {"f": "/a/f.clipkit.faa", "h": "/a/h.mafft.fasta"}
    grown = spark.createDataFrame([("/t/h.treefile", "h.treefile")], "path string, name string")
    assert [r.hmm for r in files.alignment_files(both, grown).collect()] == ["h"]
