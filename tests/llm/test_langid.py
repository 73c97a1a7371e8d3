import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from brachis.llm import langid

STEMS = {"xx": ["lor", "em", "ips", "um", "dol"], "yy": ["kra", "zek", "vlo", "tny", "ske"], "zz": ["été", "ña", "über", "çe", "ou"]}


def corpus():
    rng = random.Random(0)
    rows = []
    for k in range(240):
        lang = ("xx", "yy", "zz")[k % 3]
        text = " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60)))
        rows.append((k, text, lang))
    return rows


def in_test(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def brute_bits(text, training, order):
    """Code length by walking down the contexts of a plain dictionary tree."""
    tree, fold = {}, lambda t: bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
    for t in training:
        raw = b"\n" * order + fold(t)
        for i in range(order, len(raw)):
            for k in range(order + 1):
                node = tree.setdefault(raw[i - k : i], {})
                node[raw[i]] = node.get(raw[i], 0) + 1
    raw, total = b"\n" * order + fold(text), 0.0
    for i in range(order, len(raw)):
        p = 1.0
        for k in range(order, -1, -1):
            node = tree.get(raw[i - k : i])
            if not node:
                continue
            n, d = sum(node.values()), len(node)
            if raw[i] in node:
                p *= node[raw[i]] / (n + d)
                break
            p *= d / (n + d)
        else:
            p /= 256
        total -= math.log2(p)
    return total


def test_code_lengths_match_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = ["", "a", "Lorem dolum", "été über ß 日本", "123 !?", rows[0][1] * 3]
    for order in (1, 2, 4):
        model = langid.learn(table, order=order)
        assert model["langs"] == ["xx", "yy", "zz"]
        bits, length, letter = langid.score_batch(pa.array(texts), model)
        assert length.tolist() == [len(t.encode()) for t in texts]
        assert letter.tolist() == [False, True, True, True, False, True]
        for j, lang in enumerate(model["langs"]):
            training = [t for k, t, x in rows if x == lang and not in_test(k)]
            assert np.allclose(bits[:, j], [brute_bits(t, training, order) for t in texts], rtol=1e-5, atol=1e-3)


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    odd = [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 ,.", "zz"), (None, rows[0][1], None), (1003, "日本語", None), (0, rows[0][1], "xx")]
    table = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    model = langid.learn(table)
    got = langid.predict(table.select("doc_id", "text", F.col("lang").alias("truth"), langid.held_out(F.col("doc_id")).alias("out")), model).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert r.out == (r.doc_id is not None and in_test(r.doc_id))
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    test = [r for r in got if r.out and r.doc_id < 1000]
    assert len(test) > 30 and np.mean([r.truth == r.lang_pred for r in test]) > 0.97
    assert langid.predict(table.limit(0), model).count() == 0


def test_learns_nothing_from_the_held_out(spark):
    rows = corpus()
    poisoned = [(k, t, {"xx": "yy", "yy": "zz", "zz": "xx"}[lang] if in_test(k) else lang) for k, t, lang in rows]
    schema = "doc_id long, text string, lang string"
    a, b = (langid.learn(spark.createDataFrame(x, schema)) for x in (rows, poisoned))
    assert all((x[k] == y[k]).all() for x, y in zip(a["levels"], b["levels"], strict=True) for k in x)


def test_places():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 3000):
        keys = np.unique(rng.integers(0, 1 << 40, n))
        found = langid._Places(keys)
        asked = np.concatenate([keys, rng.integers(0, 1 << 40, 500), [0]])
        want = {x: k for k, x in enumerate(keys.tolist())}
        assert found(asked).tolist() == [want.get(x, -1) for x in asked.tolist()]


def test_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    monkeypatch.setattr(langid, "SAMPLE_ALL", 8)
    table = spark.createDataFrame([r for r in corpus() if r[2] != "yy" or r[0] % 2], "doc_id long, text string, lang string")
    assert {r["lang"]: r["count"] for r in langid.sample(table).groupBy("lang").count().collect()} == {"xx": 4, "zz": 4}


def test_sample_is_bounded(spark):
    table = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    sizes = {r["lang"]: r["count"] for r in langid.sample(table, 10).groupBy("lang").count().collect()}
    assert sizes == {"xx": 10, "yy": 10, "zz": 10}
    again = table.unionByName(table.where("lang = 'xx'").withColumn("doc_id", F.lit(0).cast("long"))).unionByName(table.where("doc_id = 3").crossJoin(spark.range(50)).drop("id"))
    assert max(r["count"] for r in langid.sample(again, 10).groupBy("lang").count().collect()) == 10


def test_without_languages(spark):
    table = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[3:5] for r in langid.predict(table, langid.learn(table)).collect()] == [("und", 0.0)]
    assert langid.keep_identified(table).count() == 0


def test_keep_identified(spark):
    rng = random.Random(3)
    junk = ["".join(rng.choice("абвгдежз  ") for _ in range(200)), "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(80)), "".join(rng.choice("!@#$%^&*()QZXJ<>") for _ in range(300)), "\x01\x02a\x07" * 40]
    rows = corpus() + [(1000, None, "xx"), (1001, "#### 12 ++", "yy")] + [(1002 + k, t, None) for k, t in enumerate(junk)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(3))
    kept = langid.keep_identified(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(240))
