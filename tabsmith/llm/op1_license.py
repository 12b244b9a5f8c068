"""License scan: which license notices a document holds, and where.

Words are runs other than ASCII punctuation and white space, lower-cased; a
document is the sequence of its five-word shingles (64-bit hashes).  Templates
fall into length classes L = 1, 2, 4, ...; a class looks at overlapping windows
of 2.25 L shingles every L shingles, so each run as long as a template of the
class, and a quarter longer, lies whole in some window.

A window is compared with templates by ``BANDS`` MinHash bands of one value.  A
window that holds 80 % of a template has a Jaccard similarity of at least 0.17
to it (the template is longer than L / 2), so all bands miss with a probability
of at most 0.83 ** 64, under 1e-5.  Window and template pairs that meet in a band
are verified: the share of the template's shingles that the window holds must
reach 0.8, exactly.

Only column functions are used.  Most text is passed by without work that can't
find anything: a document must hold an *anchor* (a set of words of which every
template shingle has one), then a template shingle, and a window must hold one
too - else no band value could be a template's.  Nothing is shuffled but the
matches, by document.

Defined cases: null and empty texts, and texts of under five words, hold
nothing; templates need five words; a document that holds a notice several times
gives one row, with its best window, then the earliest; rows that share an id
count as one document; null ids are kept; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import barrier

WIDTH, CONTAINED, BANDS = 5, 0.8, 64
#: Bands of all templates are broadcast up to so many, else joined by shuffle.
MAX_BROADCAST_BANDS = 500_000
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Words too common in prose to be anchors where others will do.
COMMON = frozenset("a all an and any are as at be by can do for form from if in is it no not of on one or other so such "
                   "that the this to use was with you your".split())


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, text.lower()) if w]


def anchors(templates: Mapping[str, str]) -> list[str]:
    """Words of which every template shingle has at least one, common words last."""
    open_ = [frozenset(ws[i:i + WIDTH]) for ws in map(template_words, templates.values())
             for i in range(len(ws) - WIDTH + 1)]
    chosen = []
    while open_:
        counts = Counter(w for s in open_ for w in s)
        best = min(counts, key=lambda w: (w in COMMON, -counts[w], w))
        chosen.append(best)
        open_ = [s for s in open_ if best not in s]
    return sorted(chosen)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of all shingles in order; none with fewer words than a shingle."""
    return F.when(F.size(words) >= WIDTH,
                  F.transform(F.sequence(F.lit(1), F.size(words) - (WIDTH - 1)),
                              lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(WIDTH)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def length_class(n: int) -> int:
    """The least power of two that n does not exceed."""
    return 1 << (n - 1).bit_length()


def window_size(length: int) -> int:
    return 2 * length + max(1, length // 4)


def _bands(shingles: Column) -> Column:
    """Structs of band number and MinHash value."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, b))).alias("value")))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, license, matched, shingles, containment, first_word) of every notice
    that a document holds."""
    spark = docs.sparkSession
    sizes = {}
    for name, text in templates.items():
        n = len(template_words(text)) - WIDTH + 1
        if n < 1:
            raise ValueError(f"template {name} has fewer than {WIDTH} words")
        sizes[name] = n
    notices = (spark.createDataFrame(list(templates.items()), "license string, text string")
               .select("license", F.array_distinct(shingles_of(words_of(F.col("text")))).alias("notice")))
    lengths = {name: length_class(n) for name, n in sizes.items()}
    length = F.create_map(*[F.lit(x) for item in lengths.items() for x in item])
    rows = notices.withColumn("length", length[F.col("license")]).collect()     # one row per template
    wanted = F.array(*[F.lit(h).cast("long") for h in sorted({h for r in rows for h in r["notice"]})])
    notices = spark.createDataFrame(rows, "license string, notice array<bigint>, length int")

    words = barrier(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")),
                    words=words_of(F.col("text"))).select("id", "words")
    words = words.where(F.arrays_overlap("words", F.array(*map(F.lit, anchors(templates)))))
    hashed = barrier(words, h=shingles_of(F.col("words"))).select("id", "h").where(F.arrays_overlap("h", wanted))
    of_class = {n: sorted({h for r in rows if r["length"] == n for h in r["notice"]}) for n in set(lengths.values())}
    classes = F.array(*[F.struct(F.lit(n).alias("length"), F.lit(window_size(n)).alias("size"),
                                 F.array(*[F.lit(h).cast("long") for h in own]).alias("wanted"))
                        for n, own in sorted(of_class.items())])
    # Windows of a class that hold a shingle of the class.
    starts = F.flatten(F.transform(classes, lambda c: F.filter(F.transform(
        F.sequence(F.lit(0), F.floor((F.size("h") - 1) / c["length"]).cast("int")),
        lambda i: F.struct(c["length"].alias("length"), (i * c["length"]).alias("start"), c["size"].alias("size"))),
        lambda w: F.arrays_overlap(F.slice(F.col("h"), w["start"] + 1, w["size"]), c["wanted"]))))
    windows = hashed.select("id", "h", F.explode(starts).alias("w"))
    windows = barrier(windows, window=F.slice(F.col("h"), F.col("w.start") + 1, F.col("w.size"))).select(
        "id", "w.length", "w.start", "window")

    bands = notices.select("license", "notice", "length", F.explode(_bands(F.col("notice"))).alias("b")).select(
        F.col("b.band").alias("t_band"), F.col("b.value").alias("t_value"), F.col("length").alias("t_length"),
        "license", "notice")
    if len(templates) * BANDS <= MAX_BROADCAST_BANDS:
        bands = F.broadcast(bands)
    windows = barrier(windows, distinct=F.array_distinct("window"))
    probes = windows.select("id", "length", "start", "window", F.explode(_bands(F.col("distinct"))).alias("b"))
    met = probes.join(bands, (F.col("length") == F.col("t_length")) & (F.col("b.band") == F.col("t_band"))
                      & (F.col("b.value") == F.col("t_value")))
    held = F.size(F.array_intersect("window", "notice"))
    first = F.col("start") + F.array_min(F.filter(F.transform(
        "window", lambda x, i: F.when(F.array_contains(F.col("notice"), x), i)), lambda i: i.isNotNull()))
    checked = met.select("id", "license", held.alias("matched"), F.size("notice").alias("shingles"), first.alias("first"))
    return (checked.where(F.col("matched") >= F.lit(CONTAINED) * F.col("shingles"))
            .groupBy(F.col("id").alias(id_col), "license", F.col("shingles").cast("long").alias("shingles"))
            .agg(F.max(F.struct("matched", (-F.col("first")).alias("back"))).alias("best"))
            .select(id_col, "license", F.col("best.matched").cast("long").alias("matched"), "shingles",
                    (F.col("best.matched") / F.col("shingles")).alias("containment"),
                    (-F.col("best.back")).cast("long").alias("first_word")))


def _oracle() -> str:
    """Every window and template, by plain joins of shingle strings."""
    rows = []
    for name, text in sorted(TEMPLATES.items()):
        ws = template_words(text)
        distinct = sorted({" ".join(ws[i:i + WIDTH]) for i in range(len(ws) - WIDTH + 1)})
        length = length_class(len(ws) - WIDTH + 1)
        rows += [f"('{name}', {length}, {window_size(length)}, {len(distinct)}, '{s}')" for s in distinct]
    return rf"""
WITH t(license, step, size, shingles, s) AS (VALUES {', '.join(rows)}),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{SEPARATOR}'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(len(ws) - {WIDTH - 1})) AS i, ws FROM w WHERE len(ws) >= {WIDTH}),
h AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + {WIDTH}], ' ') AS s FROM p),
m AS (SELECT h.doc_id, t.license, t.shingles, t.s, h.i, t.step, t.size, unnest(range(i // t.step + 1)) AS k FROM h JOIN t USING (s)),
c AS (SELECT doc_id, license, shingles, k, count(DISTINCT s) AS matched, min(i) AS first_word FROM m
      WHERE i < k * step + size GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY matched DESC, first_word) AS r
      FROM c WHERE matched >= {CONTAINED} * shingles)
SELECT doc_id, license, matched::BIGINT AS matched, shingles::BIGINT AS shingles,
       matched::DOUBLE / shingles AS containment, first_word::BIGINT AS first_word FROM b WHERE r = 1
"""


ORACLE_SQL = _oracle()
