import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from brachis.llm import langid, mixing, packing, simhash
from tests.llm.test_mixing import water_fill
from tests.llm.test_packing import best_fit_decreasing, plain
from tests.llm.test_simhash import brute, groups

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    named, unique, mixed, packed = kept
    # all of the prose has a language
    assert len(named) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    prints = {r.doc_id: brute(r.text) for r in named}
    assert sorted(r.doc_id for r in unique) == sorted(set(groups(prints, 2).values()))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = {}, {}
    for r in unique:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
    for s, target in water_fill(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.EPOCHS).items():
        assert abs(taken[s] - target) <= max(size(r.text) for r in unique if r.source == s)
    lengths = []
    for r in mixed:
        n = len(plain(r.text)) + 1
        lengths += [min(packing.CAPACITY, n - s) for s in range(0, n, packing.CAPACITY)]
    assert sorted(r.length for r in packed) == sorted(lengths)
    assert len({r.sequence_id for r in packed}) == best_fit_decreasing(lengths, packing.CAPACITY)


def test_nulls_junk_copies_and_clashing_columns(spark, tmp_path):
    """Every stage on nulls in any column, junk, repeated ids and rows, and columns named as the operators' own are."""
    rng = random.Random(4)
    good = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").limit(60).collect()
    junk = ["".join(rng.choice("абвгдежз  ") for _ in range(200)), "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(80)), "\x01\x02a\x07" * 40, "12 34 -- !!", "", None]
    rows = [tuple(r) for r in good] + [(9000 + k, t, None, "src1") for k, t in enumerate(junk)]
    one, two = good[0], good[1]
    rows += [(None, one.text, None, None), (two.doc_id, two.text, two.lang, two.source), (two.doc_id, "Unlike " + good[2].text[::-1], None, None)]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema)
    for c in ("size", "h", "fp", "root", "tie", "mark", "rank", "copies", "_row", "length", "component_id", "score"):
        docs = docs.withColumn(c, F.lit("clash"))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert name == "packing" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    named, unique, mixed, packed = kept
    texts = [r.text for r in named]
    assert not set(junk) & set(texts) and {r.text for r in good} <= set(texts)
    prints = {t: brute(t) for t in texts}
    label = groups({t: p for t, p in prints.items()}, 2)
    assert len(unique) == len({label[r.text] for r in unique}) == len({label[t] for t in texts})
    assert {r.text for r in mixed} <= {r.text for r in unique} and all(r.size == "clash" for r in mixed)
    assert sum(r.length for r in packed) == sum(len(plain(r.text)) + 1 for r in mixed)


def test_every_stage_survives_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "mixing", "packing"]
    assert all(callable(x) for x in (langid.keep_identified, simhash.drop_near_duplicates, mixing.mixed_rows, packing.pack))
