import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brachis.llm import packing, tokens

ODD = ["", None, "Hello, World! it's 3.14", "été naïve é x́,", "a b c", "日本語テキスト mixed", "<|endoftext|> x<|startoftext|>y", "\x1cctrl\x00 \x85n", "!!'s 's'll ALL'S", "ΑΣ ΣΑΣ. İstanbul", "co-op/and,or...", "word" * 400, "12345 a1b2", "̸ , ̸≠", " \t\r\n ", "don't.Stop"]


def plain(text):
    return Tokenizer.from_file(tokens.tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(words):
    texts = [*ODD, words(3000, 1), *ODD[::-1], words(50, 2).upper()]
    ids, at = tokens.WordEncoder(tokens.tokenizer_path())(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == plain(t), repr(t)


def test_fuzzed_strings():
    """Control, combining, case-changing and composing characters beside punctuation, digits and special tokens."""
    letters = [*"abzABZ09.,'!-_~`\"<|>", "'s", "'ll", "<|endoftext|>", " ", "\n", "\t", "\x00", "\x1c", "\x1f", "\x7f", "\x85", "\xa0"]
    letters += [*"éÉßẞΣςŉǰǄﬁÅК日本한가ะ😀½²٣ᾳꭰᎠ×÷ªºƻǀ", "e\u0301", "\u0301", "\u0338", "\u0130", "\u0131", "\u212a", "\u212b", "\u200d", "\ufeff", "\u3000", "\u0345", "\xad"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(8000)]
    encode, whole = tokens.WordEncoder(tokens.tokenizer_path()), Tokenizer.from_file(tokens.tokenizer_path())
    for lo in range(0, len(texts), 500):
        some = texts[lo : lo + 500]
        ids, at = encode(pa.array(some, pa.string()))
        for k, x in enumerate(whole.encode_batch(some, add_special_tokens=False)):
            assert ids[at[k] : at[k + 1]].tolist() == x.ids, repr(some[k])


def test_full_caches_change_nothing(monkeypatch, words):
    monkeypatch.setattr(tokens, "PARTS", 30)
    encode = tokens.WordEncoder(tokens.tokenizer_path())
    for seed in range(4):
        texts = [words(60, seed), *ODD]
        ids, at = encode(pa.array(texts, pa.string()))
        assert all(ids[at[k] : at[k + 1]].tolist() == plain(t) for k, t in enumerate(texts))


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(3))
def test_rounds_are_near_sequential_best_fit(spark, seed):
    rng = random.Random(seed)
    capacity = 64
    lengths = [[rng.choice((rng.randrange(1, 65), rng.randrange(1, 20), 33, 64)) for _ in range(400)], [rng.randrange(15, 30) for _ in range(300)], [64, 1, 1, 32, 32]][seed]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    placed, opened = packing.place_pieces(spark, histogram, capacity, per_task=20)
    used, ranks = {}, {}
    for r in placed.collect():
        ranks.setdefault(r.length, []).extend(range(r.at, r.at + r.n))
        used.setdefault(r.sequence_id, []).extend((r.offset + k * r.length, r.length) for k in range(r.n))
    assert {n: sorted(x) for n, x in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    least = best_fit_decreasing(lengths, capacity)
    assert len(used) <= least + max(1, least // 50) and set(used) <= set(range(opened))


def test_sweep_carries_over_partitions():
    lengths, upto = np.array([9, 5, 2]), np.array([0, 1, 3, 10])
    free = np.array([10, 10, 6, 5, 4, 1])
    want, before, lead = packing.sweep(free, lengths, upto)
    assert want.tolist() == [1, 1, 1, 1, 2, 0]
    assert (before + lead).tolist() == [0, 1, 2, 3, 4, 10]
    head = packing.sweep(free[:3], lengths, upto)
    tail = packing.sweep(free[3:], lengths, upto, int(head[1][-1] + head[0][-1]), int(head[2][-1]))
    assert (tail[1] + tail[2]).tolist() == (before + lead)[3:].tolist()


def test_pack(spark, words):
    rows = [(k, words(10 + k * 13 % 120, k)) for k in range(150)] + [(500 + k, t) for k, t in enumerate(ODD)] + [(900, words(3000, 9)), (900, words(3000, 9)), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("rank", F.lit(1))
    capacity = 256
    got = packing.pack(docs, capacity).collect()
    want = []
    for k, t in rows:
        ids = [*plain(t), 1]
        want += [(k, p, s, len(ids[s : s + capacity]), zlib.crc32(np.array(ids[s : s + capacity], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), capacity))]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    least = best_fit_decreasing([r.length for r in got], capacity)
    assert len(sequences) <= least + 1 <= math.ceil(1.05 * sum(r.length for r in got) / capacity)
    assert packing.pack(docs.limit(0), capacity).count() == 0
