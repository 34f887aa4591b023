"""Licence notices: normalised text units against templates by the Dice coefficient of their word bigrams.

A unit is a line of a document or the whole document. Text and templates are lower-cased, everything but letters and digits
becomes a blank. Dice is 2 * common / (size of one + size of the other) over sets of bigrams, so a unit of a bigrams can reach
a threshold t with a template of b bigrams only if b * t / (2 - t) <= a <= b * (2 - t) / t; all others are dropped by their
size. Such a unit also shares at least t / (2 - t) of the template's bigrams, so texts with none of a few long ones are passed
by before they are cut into words. Only DataFrame functions are used.

Notices that cross line ends or stand inside longer text are found by `passages`: its units are windows of a template's length
in words, wherever one of the template's rare bigrams lies where it does in the template.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
SEPARATOR = r"[^a-z0-9\x{80}-\x{10ffff}]"
#: Short notices as they stand in files and documents; pass others for other needs.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

#: For windows of words, which also find openings and closings of whole licence texts.
PASSAGES = TEMPLATES | {
    "apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND "
        "DISTRIBUTION"
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"
    ),
    "gpl-3.0-text": (
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted "
        "to copy and distribute verbatim copies of this license document, but changing it is not allowed."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit-licensed": "Licensed under the MIT License.",
    "mit-text": (
        TEMPLATES["mit-grant"] + " The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE."
    ),
}


def normal_words(text: str) -> list[str]:
    """The words of a template, as `words` makes them of a column."""
    return [w for w in re.split(r"[^a-z0-9\u0080-\U0010ffff]+", text.lower()) if w]


def bigrams_of(words: list[str]) -> set[str]:
    """Pairs of neighbouring words; a single word is its own."""
    return {" ".join(p) for p in zip(words, words[1:])} if len(words) > 1 else set(words)


def anchors(grams: set[str], share: float) -> list[str]:
    """Bigrams of which any matching unit has one: it shares at least `share` of the template's, so it cannot miss all of
    one more than the rest. The longest are the rarest in other text."""
    need = math.ceil(share * len(grams) - 1e-9)
    return sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - need + 1]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), f"{SEPARATOR}+"), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per unit and template with a Dice coefficient of at least `threshold`: doc_id, unit ("line" or "document"),
    line_no (from 0; null for whole documents), license, common, n_unit, n_template and dice.

    Null and empty texts, and units without words, match nothing. Repeated rows give repeated matches; null ids stay null; an
    empty table gives no rows; a unit may match several templates, ties included. Other columns are not read. Templates are a
    parameter of the job: they are broadcast, and few by nature.
    """
    spark: SparkSession = docs.sparkSession
    wanted = {name: bigrams_of(normal_words(text)) for name, text in (TEMPLATES if templates is None else templates).items()}
    wanted = {name: grams for name, grams in wanted.items() if grams}
    known = spark.createDataFrame(
        [(name, sorted(grams), len(grams)) for name, grams in sorted(wanted.items())], "license string, __grams array<string>, n_template int"
    )
    share = threshold / (2 - threshold)
    least = min((share * len(g) for g in wanted.values()), default=1.0)
    most = max((len(g) / share for g in wanted.values()), default=0.0)
    hints = sorted({a for g in wanted.values() for a in anchors(g, share)})
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    normal = F.regexp_replace(F.lower(text), f"{SEPARATOR}+", " ")
    # within an array the normal text is made once, not once for each hint
    hinted = F.exists(F.array(normal), lambda n: reduce(lambda x, y: x | y, (F.contains(n, F.lit(h)) for h in hints), F.lit(False)))
    rows = docs.where(hinted).select(F.col(id_column).alias("doc_id"), text.alias("__all"))
    lines = F.transform(F.split("__all", "\n"), lambda line, k: F.struct(k.alias("line_no"), line.alias("__text")))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("line_no"), F.col("__all").alias("__text")))
    both = F.when(F.contains("__all", F.lit("\n")), F.concat(lines, whole)).otherwise(lines)
    units = rows.select("doc_id", F.inline(both))
    words = units.select("doc_id", "line_no", _words(F.col("__text")).alias("__words")).where(F.size("__words") >= F.lit(least))
    sized = words.select("doc_id", "line_no", _bigrams(F.col("__words")).alias("__unit")).withColumn("n_unit", F.size("__unit"))
    near = sized.where(F.col("n_unit").between(F.lit(least), F.lit(most)))
    fits = (F.col("n_unit") >= F.lit(share) * F.col("n_template")) & (F.col("n_unit") * F.lit(share) <= F.col("n_template"))
    pairs = near.join(F.broadcast(known), fits)
    common = F.size(F.array_intersect("__unit", "__grams"))
    scored = pairs.withColumn("common", common).where(F.lit(2.0) * F.col("common") >= F.lit(threshold) * (F.col("n_unit") + F.col("n_template")))
    return scored.select(
        "doc_id",
        F.when(F.col("line_no").isNull(), "document").otherwise("line").alias("unit"),
        "line_no", "license", "common", "n_unit", "n_template",
        (F.lit(2.0) * F.col("common") / (F.col("n_unit") + F.col("n_template"))).alias("dice"),
    )


def passages(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per window and template with a Dice coefficient of at least `threshold`: doc_id, first_word (from 0), n_words,
    license, common, n_unit, n_template and dice.

    Windows have as many words as the template, fewer at the ends of a text, and lie so that an anchor of the template (see
    `anchors`) is where it is in the template. So an unchanged notice is one row wherever it stands and however it is wrapped; a
    changed one may give a row for each shift. Nulls, repeated rows and empty tables are as in `scan`.
    """
    spark: SparkSession = docs.sparkSession
    bodies = {name: normal_words(text) for name, text in (PASSAGES if templates is None else templates).items()}
    bodies = {name: words for name, words in bodies.items() if words}
    grams = {name: bigrams_of(words) for name, words in bodies.items()}
    known = spark.createDataFrame([(n, sorted(g), len(g)) for n, g in sorted(grams.items())], "license string, __grams array<string>, n_template int")
    share = threshold / (2 - threshold)
    places: dict[str, list[tuple[str, int, int]]] = {}
    for name, words in sorted(bodies.items()):
        pairs = [" ".join(p) for p in zip(words, words[1:])] or words
        rare = set(anchors(grams[name], share))
        for k, gram in enumerate(pairs):
            if gram in rare:
                places.setdefault(gram, []).append((name, k, len(words)))
    single = {name: words[0] for name, words in bodies.items() if len(words) == 1}
    hints = sorted(places)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    normal = F.regexp_replace(F.lower(text), f"{SEPARATOR}+", " ")
    hinted = F.exists(F.array(normal), lambda n: reduce(lambda x, y: x | y, (F.contains(n, F.lit(h)) for h in hints), F.lit(False)))
    rows = docs.where(hinted).select(F.col(id_column).alias("doc_id"), _words(text).alias("__words"))
    kind = "array<struct<license: string, at: int, n: int>>"
    known_at = [(F.lit(h), F.array(*(F.struct(F.lit(n).alias("license"), F.lit(k).alias("at"), F.lit(m).alias("n")) for n, k, m in found)).cast(kind)) for h, found in sorted(places.items())]
    if not known_at:
        known_at = [(F.lit(""), F.array().cast(kind))]
    table = F.create_map(*(x for pair in known_at for x in pair))
    words = F.col("__words")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    wanted = F.array(*(F.lit(h) for h in hints)) if hints else F.array().cast("array<string>")
    # a single word is its own bigram, so that templates of one word have places too
    units = pairs if not single else F.concat(pairs, words)
    numbered = F.transform(units, lambda g, k: F.struct(g.alias("g"), F.pmod(k, F.size(words)).alias("k")))
    hits = F.filter(numbered, lambda x: F.array_contains(wanted, x["g"]))
    starts = F.flatten(
        F.transform(hits, lambda x: F.transform(F.element_at(table, x["g"]), lambda p: F.struct(p["license"].alias("license"), (x["k"] - p["at"]).alias("start"), p["n"].alias("n"))))
    )
    # ends are cut off at the text's, so that two places may give one window
    bounds = F.transform(
        starts,
        lambda p: F.struct(
            p["license"].alias("license"), F.greatest(p["start"], F.lit(0)).alias("first_word"),
            F.least(p["start"] + p["n"], F.size(words)).alias("end"),
        ),
    )
    windows = F.transform(
        F.array_distinct(bounds),
        lambda p: p.withField("__window", F.slice(words, p["first_word"] + 1, p["end"] - p["first_word"])),
    )
    found = rows.select("doc_id", F.inline(windows))
    sized = found.select("doc_id", "license", "first_word", F.size("__window").alias("n_words"), _bigrams(F.col("__window")).alias("__unit"))
    joined = sized.withColumn("n_unit", F.size("__unit")).join(F.broadcast(known), "license")
    scored = joined.withColumn("common", F.size(F.array_intersect("__unit", "__grams")))
    kept = scored.where(F.lit(2.0) * F.col("common") >= F.lit(threshold) * (F.col("n_unit") + F.col("n_template")))
    dice = F.lit(2.0) * F.col("common") / (F.col("n_unit") + F.col("n_template"))
    return kept.select("doc_id", "first_word", "n_words", "license", "common", "n_unit", "n_template", dice.alias("dice"))
