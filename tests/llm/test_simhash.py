import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from brachis.llm import simhash


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= radius:
                    root[a] = root[b] = min(root[a], root[b])
    return root


def test_fingerprints_match_brute_force(words):
    texts = ["", None, " \t\n", "One", "one TWO", "a b c", "É A b c\x0bd", words(500, 1), "x " * 3000, "\n lead", "trail \n"]
    assert simhash.simhash_batch(pa.array(texts, pa.string())).tolist() == [brute(t) for t in texts]


def test_components(spark, words):
    base = words(400, 2)
    docs = [(10, base), (4, base), (7, base + " tail"), (3, words(50, 3)), (2, None), (1, ""), (None, base), (4, base), (20, words(60, 4))]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    prints = {k: brute(t) for k, t in docs if k is not None}
    want = groups(prints, 2)
    got = simhash.simhash_components(rows).collect()
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is not None:
            assert (r.fp & (2**64 - 1), r.component_id) == (prints[r.doc_id], want[r.doc_id])
        else:
            assert r.component_id == 4
    kept = simhash.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.simhash_components(rows.limit(0)).count() == 0


def test_near_links_find_every_group(spark):
    """All tilings, with and without cut tiles, against all pairs."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = set(centres.tolist()) | {0, 2**64 - 1, 1, 3, 7}
    for c in centres[:6].tolist():
        for _ in range(20):
            c ^= 1 << int(rng.integers(64))
            values.add(c)
    prints = {v: v for v in values}
    want = groups(prints, 2)
    from brachis.llm.components import connected_components

    fps = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    for blocks, tile in ((1, 16), (2, 16_384), (4, 3), (4, 16_384), (8, 2)):
        links = simhash.near_links(fps, 2, blocks, tile)
        found = {r.node & (2**64 - 1): r.component for r in connected_components(links).collect()}
        label = {v: found.get(v, v - 2**64 if v >= 2**63 else v) for v in values}
        same = {}
        for v, root in want.items():
            assert same.setdefault(root, label[v]) == label[v]
        assert len(set(same.values())) == len(same)


def test_no_unlike_document_is_lost(spark, words):
    """Repeated and null ids, equal and unlike texts: one row of each component stays, whatever its id."""
    texts = [words(40, k) for k in range(6)]
    rows = [(5, texts[0]), (5, texts[1]), (9, texts[2]), (None, texts[3]), (None, texts[4]), (9, texts[2]), (None, texts[3]), (3, texts[1]), (5, texts[5]), (5, texts[5])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit(1)).withColumn("root", F.lit("clash")).repartition(4)
    kept = simhash.drop_near_duplicates(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted([(5, texts[0]), (3, texts[1]), (9, texts[2]), (-1, texts[3]), (-1, texts[4]), (5, texts[5])])
