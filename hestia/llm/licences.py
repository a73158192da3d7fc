"""Licence notices by an exact set-similarity join of text blocks with templates.

A block is a line of a text and, for notices wrapped over lines, any stretch
of the whole text's words that is at most 1 / ``THRESHOLD`` times as long as
the template; a block and a template are sets of word pairs.
A template matches where at least ``THRESHOLD`` of its n pairs are in the
block: an overlap of need = ceil(THRESHOLD n). Pairs are ordered by how often
they occur in the blocks of all documents, rarest first. A match must share
one of the first n - need + 1 pairs of the template (prefix), the block must
hold need pairs that occur in templates (length), and behind the shared pair
both must have enough pairs left to reach need (position). Candidates are then
counted exactly. Stretches are formed only around places of a prefix pair.
Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.llm.common import checkpointed
from hestia.llm.contamination import shingles, words

THRESHOLD = 0.8
# Label and phrase, and label and usual wording of the notice.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc", "licensed under cc by nc"),
]
#: Other wordings of Creative Commons notices; "licensed under cc by" is in all short ones.
CC_TEMPLATES = [
    ("cc", "licensed under cc by"),
    ("cc", "licensed under a creative commons attribution"),
    ("cc", "licensed under the creative commons attribution"),
    ("cc", "available under the creative commons attribution"),
    ("cc", "released under cc0"),
    ("cc", "licensed under cc0"),
    ("cc", "creative commons zero"),
    ("cc", "cc0 1 0 universal"),
]
# Label and sentences of the standard licence texts and notices.
STANDARD = [
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("mpl", "mozilla public license"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", "eclipse public license"),
    ("boost", "boost software license"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Label and first word of the SPDX short identifiers of a family; a tag names its family ("GPL-2.0-only": gpl).
SPDX = [("mit", "mit"), ("apache", "apache"), ("gpl", "gpl"), ("lgpl", "lgpl"), ("agpl", "agpl"), ("bsd", "bsd"), ("isc", "isc"), ("mpl", "mpl"), ("epl", "epl"), ("boost", "bsl"), ("zlib", "zlib"), ("unlicense", "unlicense"), ("cc", "cc"), ("cc", "cc0")]
SPDX_TEMPLATES = [(label, f"spdx license identifier {word}") for label, word in SPDX]
#: All of them. Templates of five words or fewer, tags among them, must stand whole: less than all of their pairs is below the threshold.
ALL_TEMPLATES = TEMPLATES + CC_TEMPLATES + STANDARD + SPDX_TEMPLATES


def places(w: Column, phrase: str) -> Column:
    """Word numbers at which the phrase's words stand one after another."""
    parts = phrase.split()
    at = F.sequence(F.lit(0), F.size(w) - len(parts))

    def here(i: Column) -> Column:
        out = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            out = out & (F.get(w, i + k) == p)
        return out

    can = (F.size(w) >= len(parts)) & F.array_contains(w, parts[-1])
    return F.when(can, F.filter(at, here)).otherwise(F.array().cast("array<int>"))


def template_pairs(df: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, label, pairs, n_words): the distinct word pairs of each template, and its length."""
    rows = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(templates)], "template int, label string, text string")
    return rows.select("template", "label", F.array_distinct(shingles(words(F.col("text")), 2)).alias("pairs"), F.size(words(F.col("text"))).alias("n_words"))


def matching_blocks(blocks: DataFrame, templates: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """(keys, label, containment) for every block (keys, pairs) and template that meet the threshold.

    ``pairs`` of the blocks hold pairs of templates only, each once.
    """
    often = blocks.select(F.explode("pairs").alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    # As many rows as the templates have pairs at most.
    order = {r.p: (r.n, r.p) for r in often.collect()}
    known = [t.asDict() for t in templates.collect()]
    rank = {p: i for i, p in enumerate(sorted({p for t in known for p in t["pairs"]}, key=lambda p: order.get(p, (0, p))))}
    ranks = F.create_map(*[F.lit(x).cast(kind) for p, i in rank.items() for x, kind in ((p, "long"), (i, "int"))])
    rows = []
    for t in known:
        mine = sorted(rank[p] for p in t["pairs"])
        need = math.ceil(threshold * len(mine) - 1e-9)
        rows += [(t["template"], t["label"], mine, need, p, i) for i, p in enumerate(mine[: len(mine) - need + 1])]
    prefix = blocks.sparkSession.createDataFrame(rows, "template int, label string, t array<int>, need int, p int, t_at int")
    ordered = blocks.select(*keys, F.array_sort(F.transform("pairs", lambda p: ranks[p])).alias("b"))
    shared = ordered.select(*keys, "b", F.posexplode("b").alias("b_at", "p")).join(F.broadcast(prefix), "p")
    left = 1 + F.least(F.size("t") - F.col("t_at"), F.size("b") - F.col("b_at")) - 1
    both = F.size(F.array_intersect("b", "t"))
    return (
        shared.where((F.size("b") >= F.col("need")) & (left >= F.col("need")))
        .withColumn("both", both)
        .where(F.col("both") >= F.col("need"))
        .select(*keys, "label", (F.col("both") / F.size("t")).alias("containment"))
        .distinct()
    )


def matching_stretches(hits: DataFrame, templates: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """(keys, label, containment) for every template and document (keys, hits) with a stretch of words that meets the threshold.

    ``hits`` holds (at, p) of the pairs that occur in templates, by place. A
    stretch has at most as many words as the template has, divided by the threshold.
    """
    # As many rows as the templates have pairs at most.
    often = {r.p: r.n for r in hits.select(F.explode("hits.p").alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}
    rows, widest = [], 0
    for t in templates.collect():
        mine = sorted(t.pairs, key=lambda p: (often.get(p, 0), p))
        need = math.ceil(threshold * len(mine) - 1e-9)
        # Pairs in a stretch: one fewer than its words.
        width = max(need, math.ceil(t.n_words / threshold - 1e-9) - 1)
        widest = max(widest, width)
        rows += [(t.template, t.label, mine, need, width, p) for p in mine[: len(mine) - need + 1]]
    prefix = hits.sparkSession.createDataFrame(rows, "template int, label string, t array<long>, need int, width int, p long")
    first = F.array(*[F.lit(p).cast("long") for p in sorted({r[5] for r in rows})])
    # Places next to a prefix pair only, so that a row doesn't grow with the text.
    near = lambda x, i: F.struct(x["p"].alias("p"), x["at"].alias("at"), F.slice("hits", F.greatest(i + 2 - widest, F.lit(1)), 2 * widest - 1).alias("near"))
    around = F.transform(F.filter(F.transform("hits", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda y: F.array_contains(first, y["x"]["p"])), lambda y: near(y["x"], y["i"]))
    found = hits.select(*keys, F.explode(around).alias("c")).select(*keys, "c.*").join(F.broadcast(prefix), "p")
    mine = F.filter("near", lambda x: F.array_contains("t", x["p"]) & (F.abs(x["at"] - F.col("at")) < F.col("width")))
    held = lambda b: F.size(F.array_distinct(F.transform(F.filter("mine", lambda x: (x["at"] >= b) & (x["at"] < b + F.col("width"))), lambda x: x["p"])))
    both = F.array_max(F.transform(F.filter("mine", lambda x: x["at"] <= F.col("at")), lambda x: held(x["at"])))
    return (
        found.withColumn("mine", mine)
        .where(F.size(F.array_distinct("mine.p")) >= F.col("need"))
        .withColumn("both", both)
        .where(F.col("both") >= F.col("need"))
        .select(*keys, "label", (F.col("both") / F.size("t")).alias("containment"))
        .distinct()
    )


def licences(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, templates: list[tuple[str, str]] = TEMPLATES, wrapped: bool = False
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of ``docs``.

    ``score`` is 1 where a phrase stands, else the highest containment that
    meets the threshold, else 0. Blocks are lines, with ``wrapped`` also
    stretches of words across lines. A null text counts as empty (no words, no
    labels, score 0). Rows with a null id or a repeated one are told apart by their
    text; equal rows are returned each. An empty table gives an empty one;
    other columns are not read.
    """
    key = ["__id", "__text"]
    known = checkpointed(template_pairs(docs, templates))
    vocabulary = sorted({p for t in known.collect() for p in t.pairs})
    lines = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    lines = lines.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-1)).alias("__id"),
        F.xxhash64("text").alias("__text"),
        F.transform(F.split("text", "\n"), words).alias("lines"),
    ).withColumn("w", F.flatten("lines"))
    found = lines.select(
        "doc_id",
        *key,
        F.size("w").cast("long").alias("n_words"),
        F.array(*[F.struct(F.lit(label).alias("label"), places(F.col("w"), phrase).alias("at")) for label, phrase in PHRASES]).alias("base"),
        F.filter(F.transform("lines", lambda x: F.array_distinct(F.filter(shingles(x, 2), lambda p: p.isin(vocabulary)))), lambda x: F.size(x) > 0).alias("blocks"),
        *([F.filter(F.transform(shingles(F.col("w"), 2), lambda p, i: F.struct(p.alias("p"), i.alias("at"))), lambda x: x["p"].isin(vocabulary)).alias("hits")] if wrapped else []),
    )
    found = checkpointed(found)
    blocks = found.select(*key, F.explode("blocks").alias("pairs"))
    matched = matching_blocks(blocks, known, key, threshold)
    if wrapped:
        matched = matched.unionAll(matching_stretches(found.select(*key, "hits"), known, key, threshold))
    matched = matched.groupBy(*key).agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    at = F.flatten(F.transform("base", lambda x: x["at"]))
    base = F.transform(F.filter("base", lambda x: F.size(x["at"]) > 0), lambda x: x["label"])
    none = F.array().cast("array<string>")
    listed = lambda x: F.concat_ws(",", F.array_sort(F.array_distinct(x)))
    return found.join(matched, key, "left").select(
        "doc_id",
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, F.coalesce("more", none))).alias("labels"),
        F.when(F.size(at) > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
