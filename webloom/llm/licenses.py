"""Licence scan: Dice coefficient over word bigrams against licence templates, in DataFrame functions only.

A text is scanned in units: each line, each paragraph of several lines (between blank lines), and the whole of a text.
A unit is normalised (every run of characters other than ASCII letters and digits is a space, then lower case) and
reduced to its distinct word bigrams. A unit with a bigrams can reach the Dice coefficient t with a template of b only
if b * t / (2 - t) <= a <= b * (2 - t) / t, so these bounds prune templates first: units too short or long for
any template go before their bigrams are exploded, and the join with the template bigrams carries the bounds.
What remains is counted per (unit, template).

The templates are a fixed table of a few kilobytes, broadcast. Units are counted within their document, so nothing is
keyed by a licence; the one shuffle holds matched bigrams only, partially aggregated.

Defined cases: null or empty text and units of one word match nothing. Rows without doc_id are left out; of rows that
repeat a doc_id the one with the largest text counts. A unit that ties between templates is reported for each.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.tables import one_row_per_id

MIN_DICE = 0.8

# Licence names and the notices they are recognised by.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
     " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
     " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
     " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
     " for the specific language governing permissions and limitations under the License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
     " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
     " to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
     " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Licensed under the BSD License."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
     " provided that the following conditions are met:"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
     " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
     " option) any later version."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
     " MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
]


def template_bigrams(templates: list[tuple[str, str]] = TEMPLATES) -> list[tuple[int, str, int, str, str]]:
    """(template, license, size, first, second): the distinct bigrams of each template."""
    out = []
    for k, (name, notice) in enumerate(templates):
        words = re.sub(r"[^A-Za-z0-9]+", " ", notice).lower().split()
        grams = sorted(set(zip(words, words[1:])))
        out += [(k, name, len(grams), a, b) for a, b in grams]
    return out


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, at, w) of (doc_id, text): the units of each text and their words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    paragraphs = F.filter(F.split(text, r"\n[ \t\r]*\n", -1), lambda p: p.contains("\n"))
    cut = docs.select("doc_id", F.explode(F.concat(
        F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(F.lit("line").alias("kind"), i.alias("at"), x.alias("unit"))),
        F.transform(paragraphs, lambda x, i: F.struct(F.lit("paragraph").alias("kind"), i.alias("at"), x.alias("unit"))),
        F.when(text.rlike(r"\n[ \t\r]*\n"), F.array(F.struct(F.lit("text").alias("kind"), F.lit(0).alias("at"), text.alias("unit"))))
        .otherwise(F.array().cast("array<struct<kind:string,at:int,unit:string>>")),
    )).alias("u"))
    plain = F.lower(F.trim(F.regexp_replace("u.unit", "[^A-Za-z0-9]+", " ")))
    return cut.select("doc_id", "u.kind", "u.at", F.split(plain, " ", -1).alias("w"))


def licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, min_dice: float = MIN_DICE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, dice, n_units): the licences found in each document, best coefficient and matched units."""
    spark = docs.sparkSession
    grams = template_bigrams(templates)
    table = spark.createDataFrame(grams, "template int, license string, b int, first string, second string").select(
        "template", "license", "b", F.xxhash64("first", "second").alias("gram"))
    least, most = min_dice / (2 - min_dice), (2 - min_dice) / min_dice
    sizes = [g[2] for g in grams]
    rows = one_row_per_id(docs, id_col, text_col).toDF("doc_id", "text")
    # The bounds stand inside the projections, not in filters: a filter would be pushed below the words'
    # projection and split the unit anew for every bigram.
    found = units(rows).select("doc_id", "kind", "at", F.array_distinct(F.transform(
        F.when(F.size("w") - 1 >= min(sizes) * least, F.sequence(F.lit(0), F.size("w") - 2)),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1)))).alias("grams"))
    found = found.withColumn("a", F.coalesce(F.size("grams"), F.lit(0)))
    pairs = found.select("doc_id", "kind", "at", "a", F.explode_outer(F.when(
        (F.col("a") >= min(sizes) * least) & (F.col("a") <= max(sizes) * most), F.col("grams"))).alias("gram"))
    pairs = pairs.join(F.broadcast(table), "gram").where(
        (F.col("a") >= F.col("b") * least) & (F.col("a") <= F.col("b") * most))
    scored = pairs.groupBy("doc_id", "kind", "at", "template", "license", "a", "b").agg(F.count("*").alias("both"))
    scored = scored.withColumn("dice", 2.0 * F.col("both") / (F.col("a") + F.col("b"))).where(F.col("dice") >= min_dice)
    return scored.groupBy("doc_id", "license").agg(
        F.max("dice").alias("dice"), F.countDistinct("kind", "at").alias("n_units"))
