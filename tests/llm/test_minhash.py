import hashlib
import itertools
import re
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from brachis.llm import minhash


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(words):
    base = words(600, 1)
    changed = base.split()
    for k in range(0, 600, 60):
        changed[k] = "other"
    return [(5, base), (3, base), (9, " ".join(changed)), (1, None), (2, ""), (40, "é 日本 one two"), (41, "é 日本 one two three FOUR"), (8, words(5000, 2)), (7, words(300, 3)), (None, words(30, 4)), (6, "A b C d E"), (11, "a B c D e")]


def test_signatures(words):
    texts = [t for _, t in corpus(words)]
    alone = np.concatenate([minhash.minhash_batch(pa.array([t], pa.string())) for t in texts])
    together = minhash.minhash_batch(pa.array(texts, pa.string()))
    assert (alone == together).all()
    assert (together[0] == together[1]).all() and (together[10] == together[11]).all()
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert abs((together[i] == together[j]).mean() - jaccard(shingles(a), shingles(b))) < 0.2, (i, j)


def test_fingerprints_by_plain_numbers():
    """The definition, one number at a time."""
    full = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & full
        x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & full
        return x ^ (x >> 33)

    base = 0x9E3779B97F4A7C15
    rng = np.random.default_rng(42)
    a = (rng.integers(0, 1 << 31, 128, dtype=np.uint32) * np.uint32(2) + np.uint32(1)).tolist()
    b = rng.integers(0, 1 << 32, 128, dtype=np.uint32).tolist()
    for text in ("One two three four five six SEVEN", "é 日本", "a\tb\nc d  e f", " ", "x " * 50 + "end"):
        sets = shingles(text)
        low = [0xFFFFFFFF] * 128
        for words_of in sets:
            hashes = [mix((sum((byte + 1) * pow(base, i, 1 << 64) for i, byte in enumerate(w.encode())) + len(w.encode())) & full) for w in words_of]
            x = mix(sum(h * (base + 2 * k * k + 2 * k) for k, h in enumerate(hashes)) & full) >> 32
            low = [min(m, (x * p + q) & 0xFFFFFFFF) for m, p, q in zip(low, a, b)]
        want = [(m * 0x85EBCA6B & 0xFFFFFFFF) >> 16 for m in low]
        assert minhash.minhash_batch(pa.array([text]))[0].tolist() == want


def test_ids_of_any_type_and_repeated_ones(spark, words):
    """Every row has the next one of its own order, whatever the blocks; equal ids stand by the hash of their texts."""
    for kind, ids in (("string", [f"id{k % 7}" for k in range(60)]), ("long", [k % 3 for k in range(60)]), ("decimal(20,0)", [None if k % 5 == 0 else Decimal(k) for k in range(60)])):
        rows = [(i, words(3 + k % 17, k)) for k, i in enumerate(ids)] + [(ids[0], words(3, 0))] * 2
        docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
        hashed = [(r.doc_id, r.text, r.h) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
        order = sorted(sorted(hashed, key=lambda r: r[2]), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
        order = [r for _, group in itertools.groupby(order, key=lambda r: r[0]) for r in sorted(group, key=lambda r: r[2])]
        want = []
        for k, (_, text, _) in enumerate(order):
            after = order[(k + 1) % len(order)][1]
            n = len(text)
            want.append(hashlib.sha256((text[: n - n // 3] + after[: n // 3]).encode()).hexdigest())
        assert sorted(r.edited_sha256 for r in minhash.edited_fingerprints(docs).collect()) == sorted(want)


def test_edited_fingerprints(spark, words):
    rows = corpus(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash")).withColumn("guest", F.lit(True))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for df in (docs, docs.repartition(5)):
        got = {r.doc_id: r for r in minhash.edited_fingerprints(df).collect()}
        assert len(got) == len(rows)
        for k, (doc_id, text) in enumerate(order):
            text, after = text or "", order[(k + 1) % len(order)][1] or ""
            n = len(text)
            edited = text[: n - n // 3] + after[: n // 3]
            r = got[doc_id]
            assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
            pair = minhash.minhash_batch(pa.array([text, edited, after]))
            assert r.fingerprint == pair[0].astype(">u2").tobytes().hex() and r.edited_fingerprint == pair[1].astype(">u2").tobytes().hex()
            assert (r.near_edited, r.near_next) == ((pair[0] == pair[1]).mean(), (pair[0] == pair[2]).mean())
    assert minhash.edited_fingerprints(docs.limit(0)).count() == 0


def test_single_document_follows_itself(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    r = minhash.edited_fingerprints(docs).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1.0


def test_near_duplicates(spark, words, monkeypatch):
    rows = corpus(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = {k: shingles(t) for k, t in rows if k is not None}
    want = {k: min(j for j in known if jaccard(known[j], known[k]) >= 0.8) for k in known}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    for tile, few in ((1, 300_000), (4096, 0)):
        monkeypatch.setattr(minhash, "BROADCAST_ENDS", few)
        got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs, sub_tile=tile).collect()}
        assert got == want


def test_query_carries_the_classes(spark, words):
    """Chains at 0.75, 0.875 and 0.875 are one class; repeated and null ids, empty texts and clashing columns."""
    base = [f"c{k}" for k in range(304)]
    edit = lambda slots: " ".join("x" + w if k in slots else w for k, w in enumerate(base))
    a, b, c = edit({10, 30, 50, 70}), edit({200, 220, 240, 260}), edit(set())
    rows = [(30, a), (20, b), (10, c), (10, words(50, 7)), (None, a), (None, words(60, 8)), (5, None), (6, ""), (7, words(50, 7))]
    assert jaccard(shingles(a), shingles(b)) < 0.8 <= min(jaccard(shingles(a), shingles(c)), jaccard(shingles(b), shingles(c)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tie", F.lit("clash")).withColumn("mark", F.lit(1)).withColumn("node", F.lit(1)).repartition(3)
    got = minhash.edited_fingerprints(docs, classes=minhash.document_classes(docs)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.class_id) for r in got), key=repr) == sorted([(30, len(a), 10), (20, len(b), 10), (10, len(c), 10), (10, len(words(50, 7)), 7), (None, len(a), 10), (None, len(words(60, 8)), None), (5, 0, 5), (6, 0, 5), (7, len(words(50, 7)), 7)], key=repr)
    empty = docs.limit(0)
    assert minhash.edited_fingerprints(empty, classes=minhash.document_classes(empty)).count() == 0


def test_pairs_inside_boilerplate_groups(spark, words, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(600)]

    def edited(slots, tag):
        out = list(base)
        for s in slots:
            out[5 * s + 2] = f"{tag}-{s}"
        return " ".join(out)

    rows = [(k, edited(rng.choice(120, 8, replace=False), k)) for k in range(200)]
    pairs = []
    for k in range(40):  # eight edits each, three of them common: 0.845 to each other, about 0.77 to all others
        slots = rng.choice(120, 13, replace=False)
        for side, own in ((0, slots[:8]), (1, np.concatenate([slots[:3], slots[8:]]))):
            rows.append((1000 + 2 * k + side, edited(own, f"p{k}")))
        pairs.append((1000 + 2 * k, 1001 + 2 * k))
    known = {k: shingles(t) for k, t in rows}
    assert all(jaccard(known[a], known[b]) >= 0.8 for a, b in pairs)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert [(a, b) for a, b in pairs if got[a] != got[b]] == []
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs, sub_tile=40).collect()} == got
    monkeypatch.setattr(minhash, "KEY_SAMPLE", 1)  # every bucket of over 14 nodes is dealt by hash
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs, sub_tile=7).collect()} == got
    group = {k: k for k in known}
    for a in known:
        for b in known:
            if a < b and jaccard(known[a], known[b]) >= 0.8 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert all(group[a] == group[got[a]] for a in known)  # nothing is joined without such links
