"""Licence scan: passages compared with licence templates by the Dice coefficient over word bigrams.

A passage is a line, a paragraph of several lines, or a window of a template's length within one of them. Passage and template are lower-cased and everything but letters
and digits becomes one space. With a and b distinct bigrams, of which c are common, the coefficient is 2c / (a + b).
It can reach t only if a lies between b * t / (2 - t) and b * (2 - t) / t: these size bounds go into the join,
which otherwise matches equal bigrams, so only passages that share a bigram with a template of fitting size are
looked at. Built-in functions only; only matching bigrams are shuffled, added up per passage. Windows are laid where a
bigram has its place in the template, of so many of the template's bigrams that one is found in all that can reach t.
A window that is for the most part a line or paragraph found for its licence, or a better window, is not counted again.

Null and empty texts, and passages of one word, match nothing. A passage that a text, or texts with the same id,
hold several times counts once. A passage belongs to its best template, ties to the one listed first. Siblings differ in
few words, so a template counts only if the passage has the words that tell its licence (``DISTINGUISHING``).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.held import held
from lakemart.session import new_table_path

THRESHOLD = 0.8
BROADCAST_WORDS = 200_000  # templates up to this size are sent to every executor; larger ones are shuffled

# Licence and wording of its notices. The wording is the licences' own.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    (
        "CC-BY-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    (
        "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
)

# What tells a licence from its siblings: a template that has such a pair of words is named only if the passage has it.
DISTINGUISHING: dict[str, tuple[str, ...]] = {
    "MIT": ("mit license",),
    "Apache-2.0": ("apache license", "version 2", "2 0"),
    "GPL-2.0": ("gnu general", "version 2"),
    "GPL-3.0": ("gnu general", "version 3"),
    "LGPL-2.1": ("gnu lesser", "version 2", "2 1"),
    "LGPL-3.0": ("gnu lesser", "version 3"),
    "AGPL-3.0": ("gnu affero", "version 3"),
    "MPL-2.0": ("mozilla public", "2 0"),
    "CC-BY-4.0": ("by 4", "attribution 4", "4 0"),
    "CC-BY-SA-4.0": ("by sa", "sa 4", "attribution sharealike", "sharealike 4", "4 0"),
    "CC-BY-NC-4.0": ("by nc", "nc 4", "attribution noncommercial", "noncommercial 4", "4 0"),
    "CC-BY-ND-4.0": ("by nd", "nd 4", "attribution noderivatives", "noderivatives 4", "4 0"),
    "CC-BY-NC-SA-4.0": ("by nc", "nc sa", "attribution noncommercial", "noncommercial sharealike", "4 0"),
    "CC-BY-NC-ND-4.0": ("by nc", "nc nd", "attribution noncommercial", "noncommercial noderivatives", "4 0"),
}


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _pair(words: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))


def _bigrams(words: Column) -> Column:
    """Distinct pairs of neighbours; ``words`` has two or more."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: _pair(words, i))
    return F.array_distinct(pairs)


def _passages(text: Column) -> Column:
    """Lines, and paragraphs of more than one line."""
    paragraphs = F.filter(F.split(text, "\n[ \t\r]*\n"), lambda p: p.contains("\n"))
    return F.array_distinct(F.concat(F.split(text, "\n"), paragraphs))


def scan(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every passage that reaches the threshold: id, passage, its best template (number and licence) and ``dice``."""
    rows = [(n, licence, text, [*DISTINGUISHING.get(licence, ())]) for n, (licence, text) in enumerate(templates)]
    names = "template int, licence string, wording string, named array<string>"
    listed = documents.sparkSession.createDataFrame(rows, names)
    words = F.col("words")
    few, many = threshold / (2 - threshold), (2 - threshold) / threshold
    parts = held(listed, words=_words(F.col("wording"))).where(F.size(words) > 1)
    parts = held(parts, bigrams=_bigrams(words)).withColumn("b", F.size("bigrams"))
    parts = parts.withColumn("named", F.array_intersect("named", "bigrams"))
    sizes = parts.agg(F.min("b"), F.max("b")).first()
    anchors, longest = _anchors(parts, threshold)
    small = sum(len(text.split()) for _, text in templates) <= BROADCAST_WORDS
    light = F.broadcast if small else (lambda df: df)

    passages = documents.select(F.col(id_column).alias("id"), F.explode(_passages(F.col(text_column))).alias("passage"))
    passages = held(passages.where(F.length("passage") > 2), words=_words(F.col("passage")))
    # repeated words make bigrams fewer, so only the lower bound holds for words
    passages = passages.where(F.size(words) - 1 >= F.lit(few * (sizes[0] or 1)))
    telling = sorted({max(bigram.split(" "), key=len) for bigram, *_ in anchors})
    # read twice below, and little is left
    passages = passages.where(F.arrays_overlap(words, F.array(*map(F.lit, telling)).cast("array<string>")))
    path = new_table_path(documents.sparkSession, "licence_passages")
    passages.write.parquet(path)
    passages = documents.sparkSession.read.parquet(path)

    whole = held(passages, bigrams=_bigrams(words)).drop("words").withColumn("a", F.size("bigrams"))
    whole = whole.where(F.col("a").between(few * (sizes[0] or 1), many * (sizes[1] or 0)))
    found = whole.select("id", "passage", "a", F.explode("bigrams").alias("bigram"))
    fits = (F.col("a") >= F.col("b") * few) & (F.col("a") <= F.col("b") * many)
    pairs = light(parts.select("template", "licence", "b", "named", F.explode("bigrams").alias("bigram")))
    common = found.join(pairs, (found["bigram"] == pairs["bigram"]) & fits).groupBy(
        "id", "passage", "template", "licence", "a", "b"
    )
    dice = 2 * F.col("c") / (F.col("a") + F.col("b"))
    # as a set: rows that repeat an id may hold the same passage
    shared = F.collect_set(found["bigram"])
    scored = common.agg(F.size(shared).alias("c"), F.size(F.array_except(F.first("named"), shared)).alias("unnamed"))
    scored = scored.withColumn("dice", dice).where((F.col("dice") >= threshold) & (F.col("unnamed") == 0))
    best = scored.groupBy("id", "passage").agg(
        F.max(F.struct("dice", (-F.col("template")).alias("first"), "licence")).alias("best")
    )

    # windows of a template's size, laid so that a bigram that only this and few others have falls on its place
    near = F.slice("words", F.greatest(F.col("at") - longest, F.lit(0)) + 1, 2 * longest)
    spots = F.filter(F.sequence(F.lit(0), F.size(words) - 2), lambda i: _pair(words, i).isin([x for x, *_ in anchors]))
    spots = passages.select("id", "words", F.explode(spots).alias("at"))
    spots = spots.select(
        "id", "at", F.size(words).alias("n"), _pair(words, F.col("at")).alias("bigram"), near.alias("near")
    )
    listed = documents.sparkSession.createDataFrame(anchors, "bigram string, template int, offset int, size int")
    listed = light(listed.join(parts.drop("words", "wording").withColumnRenamed("bigrams", "of_template"), "template"))
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("n") - F.col("size"))).alias("start")
    laid = spots.join(listed, "bigram").where("n > size").select("*", start)
    begin = F.col("start") - F.greatest(F.col("at") - longest, F.lit(0)) + 1
    laid = held(laid.drop("bigram"), words=F.slice("near", begin, F.col("size")))
    laid = held(laid.drop("near"), bigrams=_bigrams(words))
    laid = held(laid, a=F.size("bigrams"), common=F.array_intersect("bigrams", "of_template"))
    laid = laid.withColumn("c", F.size("common")).withColumn("dice", dice)
    laid = laid.where((F.col("dice") >= threshold) & (F.size(F.array_except("named", "common")) == 0))
    text = F.array_join("words", " ").alias("passage")
    rank = F.struct("dice", (-F.col("template")).alias("first"), "licence")
    laid = laid.select("id", text, "licence", rank.alias("best")).groupBy("id", "passage", "licence")
    laid = laid.agg(F.max("best").alias("best")).drop("licence")

    def entry(inside: bool) -> Column:
        fields = [F.col(f"best.{c}").alias(c) for c in ("dice", "first", "licence")]
        bigrams = F.when(F.size(_words(F.col("passage"))) > 1, _bigrams(_words(F.col("passage"))))
        return F.struct(F.lit(not inside).alias("whole"), *fields, F.col("passage"), bigrams.alias("bigrams"))

    every = best.select("id", entry(False).alias("e")).unionByName(laid.select("id", entry(True).alias("e")))
    every = every.groupBy("id").agg(F.sort_array(F.collect_set("e"), asc=False).alias("all"))

    def same(x: Column, y: Column) -> Column:
        """Three quarters of a shifted window are common; two wordings of one line have less."""
        common = F.size(F.array_intersect(x["bigrams"], y["bigrams"]))
        return (x["licence"] == y["licence"]) & (4 * common > 3 * F.least(F.size(x["bigrams"]), F.size(y["bigrams"])))

    # what a passage or a better window has already is not counted again
    taken = F.aggregate(
        F.filter("all", lambda x: ~x["whole"]),
        F.filter("all", lambda x: x["whole"]),
        lambda kept, x: F.when(F.exists(kept, lambda y: same(x, y)), kept).otherwise(F.concat(kept, F.array(x))),
    )
    result = every.select("id", F.inline(taken))
    return result.select(
        F.col("id").alias(id_column),
        "passage",
        (-F.col("first")).alias("template"),
        "licence",
        "dice",
    )


def _anchors(parts: DataFrame, threshold: float) -> tuple[list[tuple[str, int, int, int]], int]:
    """Bigrams of which a likeness at the threshold has one, with template, place and the template's words; the longest.

    Of b bigrams at least b * t / (2 - t) must be common, so all but so many and one more will do: the longest ones.
    """
    out, longest = [], 1
    for row in parts.select("template", "words", "bigrams").collect():
        b = len(row["bigrams"])
        count = b - max(ceil(threshold * b / (2 - threshold) - 1e-9), 1) + 1
        chosen = set(sorted(row["bigrams"], key=lambda x: (-len(x), x))[:count])
        pairs = [f"{x} {y}" for x, y in zip(row["words"], row["words"][1:])]
        out += [(x, row["template"], n, len(row["words"])) for n, x in enumerate(pairs) if x in chosen]
        longest = max(longest, len(row["words"]))
    return out, longest


def scan_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The passages of ``scan`` in DuckDB's SQL, as table ``best``."""
    quoted = ", ".join(
        f"({n}, '{licence}', '{text.replace(chr(39), chr(39) * 2)}')" for n, (licence, text) in enumerate(templates)
    )
    few, many = threshold / (2 - threshold), (2 - threshold) / threshold

    def bigrams(text: str) -> str:
        words = rf"string_split(trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
        return f"list_distinct(list_transform(list_zip({words}[:-2], {words}[2:]), lambda z: z[1] || ' ' || z[2]))"

    return f"""
WITH templates(template, licence, wording) AS (VALUES {quoted}),
parts AS (SELECT template, licence, {bigrams("wording")} AS bigrams FROM templates),
sized AS (SELECT template, licence, len(bigrams) AS b, unnest(bigrams) AS bigram FROM parts),
passages AS (
    SELECT DISTINCT doc_id, unnest(list_concat(string_split(text, chr(10)), list_filter(
        regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: contains(p, chr(10))))) AS passage
    FROM documents WHERE text IS NOT NULL
),
found AS (SELECT doc_id, passage, len(x) AS a, unnest(x) AS bigram FROM (
    SELECT doc_id, passage, {bigrams("passage")} AS x FROM passages)),
scored AS (
    SELECT doc_id, passage, template, licence, 2 * count(*) / (a + b) AS dice
    FROM found JOIN sized USING (bigram) WHERE a >= b * {few!r} AND a <= b * {many!r}
    GROUP BY doc_id, passage, template, licence, a, b
),
best AS (
    SELECT * FROM scored WHERE dice >= {threshold!r}
    QUALIFY row_number() OVER (PARTITION BY doc_id, passage ORDER BY dice DESC, template) = 1
)"""
