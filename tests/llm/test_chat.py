import hashlib

from pyspark.sql import functions as F

from brachis.llm import chat, queries
from tests.oracle import compare


def rendered(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_pairs_share_their_prompt(spark):
    talks = {
        1: [("user", "hi"), ("assistant", "yo"), ("user", "more")],
        2: [("user", "hi"), ("assistant", "yo"), ("user", "less"), ("assistant", "ok")],
        3: [("user", "hi"), ("assistant", "yo")],
        4: [("user", "hi"), ("assistant", "yo")],
        5: [("", "")],
    }
    rows = [(c, k, r or None, t or None) for c, turns in talks.items() for k, (r, t) in enumerate(turns)] + [(None, 0, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash")).repartition(3)
    conversations = chat.conversations_of(turns)
    pairs = spark.createDataFrame([(0, 1, 2), (1, 3, 4), (2, 1, 3), (3, 5, 1), (4, 2, None)], "pair_id long, chosen_id long, rejected_id long").withColumn("derived", F.lit(False))
    got = {r.pair_id: r for r in chat.format_preferences(conversations, pairs).collect()}
    shared = {0: 2, 1: 2, 2: 2, 3: 0, 4: 0}
    for k, (a, b) in {0: (1, 2), 1: (3, 4), 2: (1, 3), 3: (5, 1), 4: (2, None)}.items():
        n, r = shared[k], got[k]
        assert (r.prompt_turns, r.prompt, r.chosen) == (n, rendered(talks[a][:n]), rendered(talks[a][n:]))
        assert r.rejected == (rendered(talks[b][n:]) if b else None)
        for text, mask, own in ((r.chosen, r.chosen_mask, talks[a][n:]), (r.rejected, r.rejected_mask, talks[b][n:] if b else [])):
            if text is None:
                assert mask is None
                continue
            at, learned = 0, ""
            for part in filter(None, mask.split(",")):
                size, on = map(int, part.split(":"))
                learned += text[at : at + size] if on else ""
                at += size
            assert at == len(text) and learned == "".join(t + "<|end|>\n" for r_, t in own if r_ == "assistant")


def test_partners_begin_alike(spark):
    rows = [(c, k, "user", f"{c % 3 if k == 0 else c}") for c in range(12) for k in range(2)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.preferences(turns).collect()
    assert len(got) == 6 and all(r.prompt_turns == 1 and r.chosen_id < r.rejected_id for r in got)
    assert chat.preferences(turns.limit(0)).count() == 0


def by_hand(talks):
    """Pairs of ids and rejected turns, one by one."""
    groups = {}
    for c in sorted(talks):
        groups.setdefault(talks[c][0], []).append(c)
    key = lambda c: hashlib.md5("\x1f".join(talks[c][0]).encode()).hexdigest()
    out, alone = {}, []
    for ids in groups.values():
        out |= {a: (b, talks[b], False) for a, b in zip(ids[::2], ids[1::2])}
        alone += ids[len(ids) // 2 * 2 :]
    replies = {c: max((k for k, t in enumerate(talks[c]) if t[0] == "assistant"), default=None) for c in alone}
    givers = sorted((c for c in alone if replies[c] is not None), key=lambda c: (key(c), c))
    for c in alone:
        z = givers[(givers.index(c) + 1) % len(givers)] if c in givers and len(givers) > 1 else None
        out[c] = (z, talks[c][: replies[c]] + [talks[z][replies[z]]] if z is not None else None, z is not None)
    return out


def test_pairs_against_brute_force(spark):
    sizes = [1, 2, 3, 5, 2, 1, 7, 4, 1, 6, 3, 2, 1, 1]
    groups = [g for g, n in enumerate(sizes) for _ in range(n)]
    talks = {}
    for c, g in enumerate(groups):
        c = (c * 23) % 39
        talks[c] = [("user", f"start {g}"), *((("assistant", "user")[k % 2], f"é {c % 4} {k} " + "long " * (50_000 if c == 7 else 1)) for k in range((c + g) % 5))]
    rows = [(c, k, r, t) for c, turns in talks.items() for k, (r, t) in enumerate(turns)]
    rows += [r for r in rows if r[0] == 11]  # repeated rows are repeated turns
    talks[11] = [t for t in talks[11] for _ in range(2)]
    got = chat.preferences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    want = by_hand(talks)
    assert sorted(r.pair_id for r in got) == list(range(len(want)))
    assert {r.chosen_id: (r.rejected_id, r.derived) for r in got} == {c: (z, d) for c, (z, _, d) in want.items()}
    for r in got:
        own, other = talks[r.chosen_id], want[r.chosen_id][1]
        n = next((k for k, (a, b) in enumerate(zip(own, other)) if a != b), min(len(own), len(other))) if other else 0
        assert (r.prompt_turns, r.prompt, r.chosen, r.rejected) == (n, rendered(own[:n]), rendered(own[n:]), rendered(other[n:]) if other else None)
    assert sum(r.prompt_turns > 0 for r in got) > len(got) / 2


def test_most_supplied_pairs_share_a_prompt(spark):
    got = queries.op1_chat_format(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.prompt_turns > 0 for r in got) > len(got) / 2


def test_query_equals_oracle(spark):
    assert compare(spark, "/root/testdata/sf0.001", "op1", queries.op1_chat_format, queries.ORACLE_SQL["op1_chat_format"]) > 0
