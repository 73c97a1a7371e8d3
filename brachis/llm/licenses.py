"""License scans by exact phrases and by an exact set-similarity join with license templates; DataFrame functions only.

Base: places where the words of a phrase stand consecutively in the whole text. Method: every paragraph of a text (what
stands between blank lines) is a block, so a license wrapped over lines is one. Blocks and templates are sets of shingles
of five consecutive words, which tell licenses apart that share most of their words; a template matches a block that holds
at least ``threshold`` of its shingles. One pass over the texts keeps, of each block, the shingles that any template has,
if there are enough of them for the least demanding one; blocks without any of a few trigger words, one of which every
match must hold, are not cut into shingles. Frequencies over all blocks order the shingles, rarest first. By that order the
join applies

* the prefix filter: a block and a template sharing ``need`` shingles share one of the first size - need + 1 of each,
* the length filter: a block with fewer than ``need`` such shingles cannot match,
* the positional filter: what stands after the shared shingle on either side bounds how many more can be shared,

and each candidate that is left is verified. The templates are fixed, so their prefix table has a proven bound and is
broadcast; blocks are never compared with each other and nothing but blocks with candidates is shuffled.

Defined results: a null text is empty; a text without words has n_words 0 and no labels; absent places are null; no label
is an empty string; score is the largest containment of a matching template, 1 with a base label, else 0; places of a
phrase may overlap. Repeated rows and null ids are scanned as rows of their own. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage_table

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase and label of the base scan.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label and text of the templates, notices and opening paragraphs of the licenses themselves.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    # of these the part that tells them apart: the whole paragraphs share nine tenths of their shingles
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
THRESHOLD = 0.8
SHINGLE = 5
#: What ends a paragraph.
BLANK = r"\n[ \t\r]*\n"


def template_words(text: str) -> list[str]:
    """Words of a template in order, as the scan sees them (templates are ASCII)."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def template_shingles(text: str, size: int = SHINGLE) -> list[str]:
    """Distinct shingles of a template, in order; a shorter one is one shingle."""
    words = template_words(text)
    return list(dict.fromkeys(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))) if words else []


def triggers(sets: list[tuple[list[str], int]]) -> list[str]:
    """Words of which every block holds one that has ``need`` shingles of one of the ``sets(shingles, need)``: for each set so
    many shingles have one of the words that fewer than ``need`` have none. Long words and those of many sets come first."""
    chosen: list[str] = []
    held = lambda x: any(w in x for w in chosen)
    words = sorted({w for shingles, _ in sets for x in shingles for w in x.split()})
    while short := [[x for x in shingles if not held(x)] for shingles, need in sets if sum(not held(x) for x in shingles) >= need]:
        gain = lambda w: sum(min(1.0, sum(w in x for x in rest) / len(rest)) for rest in short) * min(len(w), 8)
        chosen.append(max(words, key=lambda w: (gain(w), w)))
    return chosen


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: tuple = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``."""
    phrases = PHRASES if phrases is None else phrases
    sets = [(label, words, math.ceil(threshold * len(words) - 1e-9)) for label, words in ((x, template_shingles(t)) for x, t in templates) if words]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    least = min((need for *_, need in sets), default=1)

    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    one = docs.select(F.col(id_col).alias("doc_id"), text.alias("low"))
    one = one.select("doc_id", "low", F.concat(F.lit(" "), F.trim(F.regexp_replace("low", GAP, " ")), F.lit(" ")).alias("norm"))
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    base = []
    for k, phrase in enumerate(phrases):
        own = " ".join(template_words(phrase))
        there = F.col("norm").contains(f" {own} ")
        base += [
            F.when(there, F.regexp_count("norm", F.lit(rf"(?= \Q{own}\E )"))).otherwise(0).alias(f"n{k}"),
            F.when(there, spaces(F.substring_index("norm", f" {own} ", 1))).alias(f"first{k}"),
            F.when(there, spaces(F.regexp_extract("norm", rf"(?s)^(.*) \Q{own}\E ", 1))).alias(f"last{k}"),
        ]
    called = triggers([(words, need) for _, words, need in sets])
    hears = lambda c: reduce(operator.or_, (c.contains(w) for w in called), F.lit(False))
    words_of = lambda block: F.filter(F.split(block, GAP), lambda w: w != "")
    shingles_of = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(SHINGLE)), " "))
    table = F.array(*map(F.lit, vocabulary))
    # words are put into an array first: inside the next lambda they are a value, not an expression for each shingle
    paragraphs = F.transform(F.filter(F.split("low", BLANK), hears), words_of)
    cut = F.transform(paragraphs, lambda words: F.array_intersect(shingles_of(words), table))
    blocks = F.when(hears(F.col("low")), F.filter(cut, lambda x: F.size(x) >= least)).otherwise(F.array().cast("array<array<string>>"))
    seen = one.select("doc_id", F.monotonically_increasing_id().alias("row"), F.when(F.col("norm") == "  ", 0).otherwise(spaces(F.col("norm")) - 1).cast("long").alias("n_words"), *base, blocks.alias("blocks"))
    seen = stage_table(seen, "license-scan")

    block = seen.where(F.size("blocks") > 0).select("row", F.posexplode("blocks").alias("block", "words"))
    # one count a template shingle: bounded by the templates
    count = {r["word"]: r["count"] for r in block.select(F.explode("words").alias("word")).groupBy("word").count().collect()}
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    prefix = []
    for t, (label, words, need) in enumerate(sets):
        own = sorted(words, key=place.get)
        prefix += [(w, t, label, at, len(own), need, own) for at, w in enumerate(own[: len(own) - need + 1])]
    prefix_table = docs.sparkSession.createDataFrame(prefix, "word string, template int, label string, at_t int, size_t int, need int, own array<string>")

    ordered = block.select("row", "block", F.array_intersect(F.array(*map(F.lit, order)), "words").alias("words"))
    first = ordered.select("row", "block", "words", F.size("words").alias("size_b"), F.posexplode(F.slice("words", F.lit(1), F.size("words") - least + 1)).alias("at_b", "word"))
    hit = first.join(F.broadcast(prefix_table), "word")
    hit = hit.where((F.col("size_b") >= F.col("need")) & (1 + F.least(F.col("size_t") - F.col("at_t"), F.col("size_b") - F.col("at_b")) - 1 >= F.col("need")))
    hit = hit.withColumn("shared", F.size(F.array_intersect("words", "own"))).where(F.col("shared") >= F.col("need"))
    found = hit.groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("size_t")).alias("part"))

    own = F.array_compact(F.array(*(F.when(F.col(f"n{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values()))))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    some = lambda kind, pick: pick(*(F.col(f"{kind}{k}") for k in range(len(phrases)))) if len(phrases) > 1 else F.col(f"{kind}0")
    out = seen.drop("blocks").join(found, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        sum((F.col(f"n{k}") for k in range(len(phrases))), F.lit(0)).cast("long").alias("n_base"),
        some("first", F.least).cast("long").alias("first_word"),
        some("last", F.greatest).cast("long").alias("last_word"),
        joined(own).alias("base_labels"),
        joined(F.concat(own, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size(own) > 0, 1.0).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"),
    )
