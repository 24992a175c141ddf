"""Licence scans: Dice coefficient over word bigrams against templates, in SQL functions alone.

A document's lines, its paragraphs and itself are its units. A unit is compared with those templates only whose size
lets the coefficient reach the threshold, and only if enough of its bigrams occur in any template.
"""

from math import ceil, floor

from pyspark.sql import functions as F

from ._store import narrow

THRESHOLD = 0.8

# Public notices and short licence texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)

_NOT_WORDS = r"[^\p{L}\p{N}\n]+"


def bounds(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Sizes of sets whose Dice coefficient with one of the given size can reach the threshold."""
    return max(1, ceil(threshold / (2 - threshold) * size - 1e-9)), floor((2 - threshold) / threshold * size + 1e-9)


def normal(text):
    """Words in lower case, single spaces between them, lines kept apart."""
    return F.regexp_replace(F.lower(text), _NOT_WORDS, " ")


def bigrams(words):
    """Distinct hashes of neighbouring words."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1))))


def _words(line):
    return F.split(F.trim(line), " +")


def _table(spark, templates, threshold):
    """(licence, size, low, high, bigrams) of each template of two words or more, by the same functions as units. As many rows as templates."""
    rows = spark.createDataFrame([(a, b) for a, b in templates], "licence string, text string").select("licence", _words(F.translate(normal(F.col("text")), "\n", " ")).alias("w"))
    return [(r.licence, len(r.b), *bounds(len(r.b), threshold), sorted(r.b)) for r in rows.where(F.size("w") > 1).select("licence", bigrams(F.col("w")).alias("b")).collect()]


def scan(docs, templates=TEMPLATES, threshold: float = THRESHOLD):
    """(doc_id, matches array<struct<unit, position, licence, dice>>) of every row of docs.

    unit is line, paragraph (several lines between blank ones) or document (several paragraphs); position counts from
    0 within its kind. A unit matches any template, however many, with which the Dice coefficient of their sets of
    word bigrams reaches the threshold. A null or empty text has no matches, nor has a unit of one word. Rows with a
    null or repeated doc_id, and other columns, don't matter.
    """
    table = _table(docs.sparkSession, templates, threshold)
    if not table:
        return narrow(docs, doc_id="bigint").withColumn("matches", F.expr("CAST(array() AS array<struct<unit:string,position:int,licence:string,dice:double>>)"))
    low, high = min(t[2] for t in table), max(t[3] for t in table)
    all_bigrams = F.array(*[F.lit(b) for b in sorted({b for t in table for b in t[4]})])
    known = F.array(*[F.struct(F.lit(a).alias("licence"), F.lit(n).alias("size"), F.lit(x).alias("low"), F.lit(y).alias("high"), F.array(*[F.lit(b) for b in s]).alias("bigrams")) for a, n, x, y, s in table])
    text = F.coalesce(normal(F.col("text")), F.lit(""))
    rows = narrow(docs, doc_id="bigint", text="string").select("doc_id", text.alias("norm"))
    lines = F.transform(F.split("norm", "\n"), lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("position"), _words(x).alias("words")))
    paragraphs = F.filter(F.transform(F.split("norm", r"\n *\n\s*"), lambda x, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("position"), F.when(F.contains(F.trim(x), F.lit("\n")), _words(F.translate(x, "\n", " "))).alias("words"))), lambda u: u["words"].isNotNull())
    whole = F.when(F.regexp_like("norm", F.lit(r"\n *\n")), F.array(F.struct(F.lit("document").alias("unit"), F.lit(0).alias("position"), _words(F.translate("norm", "\n", " ")).alias("words")))).otherwise(F.slice(lines, 1, 0))
    units = F.filter(F.concat(lines, paragraphs, whole), lambda u: F.size(u["words"]) > low)
    sized = F.transform(units, lambda u: F.struct(u["unit"].alias("unit"), u["position"].alias("position"), bigrams(u["words"]).alias("b")))
    close = F.filter(sized, lambda u: F.size(u["b"]).between(low, high) & (F.size(F.array_intersect(u["b"], all_bigrams)) >= F.size(u["b"]) * (threshold / (2 - threshold)) - 1e-9))
    rows = rows.select("doc_id", close.alias("units"))

    def matched(u):
        fitting = F.filter(known, lambda t: F.size(u["b"]).between(t["low"], t["high"]))
        scored = F.transform(fitting, lambda t: F.struct(u["unit"].alias("unit"), u["position"].alias("position"), t["licence"].alias("licence"), (F.lit(2.0) * F.size(F.array_intersect(u["b"], t["bigrams"])) / (F.size(u["b"]) + t["size"])).alias("dice")))
        return F.filter(scored, lambda m: m["dice"] >= threshold)

    return rows.select("doc_id", F.flatten(F.transform("units", matched)).alias("matches"))


def summary(matches):
    """(doc_id, licences, n_matches, best_dice): licences sorted and joined by commas, empty for none; best_dice 0 for none."""
    return matches.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.licence"))), ",").alias("licences"),
        F.size("matches").cast("bigint").alias("n_matches"),
        F.coalesce(F.array_max(F.col("matches.dice")), F.lit(0.0)).alias("best_dice"),
    )
