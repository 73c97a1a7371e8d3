import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brachis.llm import attribution


def spans(text):
    import public_tokenizers

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False)
    return found.offsets


def test_rules():
    lengths, edges = np.array([3, 2, 5, 1]), np.array([0, 4, 4, 8, 11])
    # token spans 0-3, 3-5, 5-10, 10-11 over sections 0-4, 4-4, 4-8, 8-11
    assert [x.tolist() for x in attribution.attribute(lengths, edges, "start")] == [[2, 0, 1, 1], [1, 0, 1, 0]]
    assert [x.tolist() for x in attribution.attribute(lengths, edges, "end")] == [[1, 0, 1, 2], [0, 0, 1, 1]]
    assert [x.tolist() for x in attribution.attribute(lengths, edges, "most")] == [[2, 0, 1, 1], [1, 0, 1, 0]]


def test_sections_match_offsets(spark, words):
    texts = {1: "one two\n\nthree  \n four", 2: words(200, 1).replace("w1", "\n"), 3: "", 4: None, 5: "no break", 6: "\n", 7: "é日本\nß ñ\n", 8: words(8000, 2).replace("w7", "\n")}
    docs = spark.createDataFrame([*texts.items(), (None, "a\nb"), (5, "no break")], "doc_id long, text string").withColumn("section", F.lit("clash"))
    got = attribution.section_tokens(docs).collect()
    assert len([r for r in got if r.doc_id == 5]) == 2 and len([r for r in got if r.doc_id is None]) == 2
    for doc_id, text in texts.items():
        text = text or ""
        begins = [0, *(i + 1 for i, c in enumerate(text[:-1]) if c == "\n")]
        own = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.section)[: len(begins)]
        assert [r.start for r in own] == begins and [r.end for r in own] == [*begins[1:], len(text)]
        if text.isascii():
            found = spans(text)
            want = [sum(b <= s < e for s, _ in found) for b, e in zip(begins, [*begins[1:], len(text)], strict=True)]
            assert [r.n_tokens for r in own] == want
        else:
            assert sum(r.n_tokens for r in own) == len(spans(text))
    assert attribution.section_tokens(docs.limit(0)).count() == 0


def test_fields(spark):
    docs = spark.createDataFrame([(1, "Title here", None, "body of the text")], "doc_id long, a string, b string, c string")
    got = attribution.field_tokens(docs, ["a", "b", "c"]).orderBy("section").collect()
    assert [(r.start, r.end) for r in got] == [(0, 11), (11, 12), (12, 28)]
    assert sum(r.n_tokens for r in got) == len(spans("Title here\n\nbody of the text"))


def by_hand(text, rule):
    """Token by token over the bytes of the text: n_tokens and n_crossing of each line."""
    encoding, _ = attribution._encoding(attribution.ranks_path())
    raw = text.encode()
    edges = [0, *(i + 1 for i, c in enumerate(raw[:-1]) if c == 0x0A), len(raw)]
    of = lambda place: max((k for k in range(len(edges) - 1) if edges[k] <= place), default=0)
    counts, crossing, at = [0] * (len(edges) - 1), [0] * (len(edges) - 1), 0
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        owners = [of(k) for k in range(at, at + size)]
        best = max(sorted(set(owners)), key=owners.count)
        owner = {"start": owners[0], "end": owners[-1], "most": best}[rule]
        counts[owner] += 1
        crossing[owner] += owners[0] != owners[-1]
        at += size
    assert at == len(raw)
    return counts, crossing


def test_rules_against_every_byte(spark, words):
    texts = {1: "a\n\n\n\nb\n\n", 2: "é日本\n\nß ñ\n \n  x", 3: "\n" * 40 + "end", 4: words(300, 3).replace("w1", "\n\n "), 5: "😀\n\t\n\t\n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    crossed = 0
    for rule in attribution.RULES:
        got = attribution.section_tokens(docs, rule).collect()
        for doc_id, text in texts.items():
            own = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.section)
            assert ([r.n_tokens for r in own], [r.n_crossing for r in own]) == by_hand(text, rule), (rule, doc_id)
            crossed += sum(r.n_crossing for r in own)
    assert crossed > 10


def test_one_long_line(spark, words):
    text = words(60_000, 4)
    rows = attribution.section_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.start, r.end, r.n_tokens, r.n_crossing) for r in rows] == [(0, len(text), len(spans(text)), 0)]
