import re

from pyspark.sql import functions as F

from brachis.llm import licenses, queries
from tests.oracle import compare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, places, base, more, best = WORD.findall(low), [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    for paragraph in re.split(r"\n[ \t\r]*\n", low):
        w = WORD.findall(paragraph)
        block = {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        for label, template in licenses.TEMPLATES:
            wanted = set(licenses.template_shingles(template))
            part = len(wanted & block) / len(wanted)
            if part >= licenses.THRESHOLD:
                more.add(label)
                best = max(best, part)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else best)


TEXTS = [
    "CC BY CC by. all rights\nreserved",
    None,
    "",
    " ,. ",
    "x\nReleased under MIT license the y\n",
    "cc by",
    "Åcc by Kcc-by",
    "released under the license",  # 4 of 5 words
    "released the license",
    "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files",
    "Released\nunder the MIT\n License",
    "Released under the\n \t\nMIT License",
    "intro\n\nPermission is hereby granted, free of charge,\nto any person obtaining a copy of this software\nand associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so.\n\nEnd",
    "general  public,license all rights reserved general public license",
]


def test_scan_matches_brute_force(spark, words):
    rows = list(enumerate([*TEXTS, words(20_000, 1) + "\nAll rights reserved."])) + [(0, TEXTS[0]), (None, TEXTS[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("labels", F.lit(0))
    got = licenses.scan(docs).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((k, *brute(t))) for k, t in rows)
    assert licenses.scan(docs.limit(0)).count() == 0


NEAR_MISSES = {
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa",
    "Released under the ISC license": "",
    "We walked under the bridge; the license for the car was released": "",
    "Licensed under the Apache License, Version 1.0": "",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License": "",
    # "General Public License" is a base phrase, so gpl stays
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1": "gpl,lgpl",
    "it under the terms of the\nGNU Affero General Public License as published by\nthe Free Software Foundation, either version 3": "agpl,gpl",
    "you can redistribute it and/or modify it under the terms of the GNU Whole Public License as published by the Free Software Foundation": "",
}


def test_near_misses(spark):
    docs = spark.createDataFrame(list(enumerate(NEAR_MISSES)), "doc_id int, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert [got[k] for k in range(len(got))] == list(NEAR_MISSES.values())


def test_templates_of_other_labels_do_not_match():
    for a, x in licenses.TEMPLATES:
        for b, y in licenses.TEMPLATES:
            if a != b:
                mine, other = set(licenses.template_shingles(x)), set(licenses.template_shingles(y))
                assert len(mine & other) / len(mine) < 0.8, (a, b)


def test_every_match_holds_a_trigger():
    sets = [(licenses.template_shingles(t), -(-len(licenses.template_shingles(t)) * 8 // 10)) for _, t in licenses.TEMPLATES]
    words = licenses.triggers(sets)
    assert len(words) < 12
    for shingles, need in sets:
        assert sum(not any(w in x for w in words) for x in shingles) < need


def test_own_phrases(spark):
    docs = spark.createDataFrame([(1, "a a a b. A c++ (c) a"), (2, None)], "doc_id int, text string")
    got = licenses.scan(docs, phrases={"a a": "twice", "c++": "plus", "(c) a": "copy"}).orderBy("doc_id").first()
    assert (got.n_base, got.first_word, got.last_word, got.base_labels) == (5, 0, 6, "copy,plus,twice")


def test_main_path_is_native(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_query_equals_oracle(spark):
    assert compare(spark, "/root/testdata/sf0.001", "op10", queries.op10_license_scan, queries.ORACLE_SQL["op10_license_scan"]) == 200
