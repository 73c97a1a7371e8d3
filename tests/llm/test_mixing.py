import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brachis.llm import mixing


def water_fill(sizes, weights, share, epochs):
    """Clamp and deal again until nothing is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > epochs * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.fixture
def docs(spark, words):
    rows = [(k, words(5 + k * 7 % 90, k), ("a", "b", "é", None, "B", "a", "a", "z")[k % 8]) for k in range(400)]
    rows += [(900, None, "a"), (901, " \t ", "b"), (902, None, "nothing"), (903, words(4000, 903), "z"), (5, words(40, 5), "a"), (None, "two words", "a")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash")).withColumn("whole", F.lit(1))


def test_mix(docs):
    rows, table = docs
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = water_fill(sizes, (3, 1, 2), 1.5, 2)
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((k or -1, size(t)) for k, t, _ in rows)
    for s, words_taken in taken.items():
        assert abs(words_taken - want[s]) <= largest[s]
    again = mixing.mix(table.repartition(7)).collect()
    key = lambda r: (r.doc_id or -1, r["size"], r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))
    copies = sum(r.copies for r in got)
    out = mixing.mixed_rows(table)
    assert out.columns == table.columns and out.count() == copies


def test_other_shares(docs):
    _, table = docs
    for share, epochs in ((0.2, 1), (3.0, 5)):
        got = mixing.mix(table, share=share, epochs=epochs).collect()
        total = sum(r["size"] for r in got)
        assert sum(r.taken for r in got) == pytest.approx(share * total, rel=0.25)
        assert all(r.taken <= epochs * r["size"] for r in got)


@pytest.mark.parametrize("same_text", [True, False])
def test_repeated_ids_meet_the_target(spark, words, same_text):
    """Rows of one id, equal or not, are drawn one by one."""
    rows = [(7 if k < 900 else k, words(12, 0 if same_text else k), "a") for k in range(1000)] + [(None, words(12, 1), "b")] * 300
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(table, share=0.7, epochs=1).collect()
    for s in ("a", "b"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 12 / 2 + 1e-6
        assert all(0 <= r.taken <= r["size"] for r in own)
    assert mixing.mixed_rows(table, share=0.7, epochs=1).count() == sum(r.copies for r in got)


def test_empty(docs):
    assert mixing.mix(docs[1].limit(0)).count() == 0
    assert mixing.mixed_rows(docs[1].limit(0)).count() == 0


def test_ranked(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = mixing.ranked(rows, "x", per_task=100).collect()
    assert all(r["rank"] == r.x for r in got) and len(got) == 1000
