"""License scans in DataFrame functions: MinHash bands over text windows, then exact containment.

Words are runs of [a-z0-9] of the lower-case text, shingles run over five words (all words of a
template that has fewer). For each template length n, overlapping windows of n + n/4 words begin at
every n/4-th word, so any passage as long as a template lies whole in some window. A window's MinHash
signature, in ``BANDS`` bands of ``ROWS`` values, retrieves the templates that share a band; they
match if the window holds at least ``PERCENT`` per cent of the template's shingles.

A window that holds a whole passage with that share has a Jaccard similarity of 0.8 / 1.45 = 0.55 or
more with the template, and the chance that no band collides is at most (1 - 0.55**2)**32 < 1e-5.

Only windows with an anchor word are hashed: every template has anchor words in more than a fifth of
its shingles (checked when templates are prepared), so a match without one can't be.

Defined cases: a null or empty text has no match; repeated rows and null ids are scanned like other
rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 32, 2

# Notices by which texts and programs are put under public licences.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
}
ANCHORS = ("licensed", "license", "licence", "rights", "permission", "redistribution", "redistributions", "redistribute", "permitted", "copyright", "software", "public", "conditions")


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def prepared(templates: dict[str, str]) -> list[tuple[str, int, int, list[str]]]:
    """(name, words, shingle width, distinct shingles) of each template; checks the anchors."""
    out = []
    for name, text in templates.items():
        words = words_of(text)
        width = min(SHINGLE, len(words))
        shingles = list(dict.fromkeys(" ".join(words[i : i + width]) for i in range(len(words) - width + 1)))
        anchored = sum(any(w in ANCHORS for w in s.split()) for s in shingles)
        if not anchored * 100 > (100 - PERCENT) * len(shingles):
            raise ValueError(f"template {name} can match without an anchor word")
        out.append((name, len(words), width, shingles))
    return out


def signature(shingles: Column) -> Column:
    """Band values of a set of shingles: (band, value) for each band."""
    hashed = F.transform(shingles, lambda s: F.xxhash64(s))
    least = lambda j: F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, F.lit(j))))
    return F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(*[least(b * ROWS + r) for r in range(ROWS)]).alias("value")) for b in range(BANDS)])


def _template_tables(spark: SparkSession, templates: dict[str, str]) -> tuple[list[tuple[int, int]], DataFrame]:
    rows = prepared(templates)
    table = spark.createDataFrame(rows, "template string, words int, width int, shingles array<string>")
    return sorted({(n, k) for _, n, k, _ in rows}), table


def scan_licenses(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each document and template that matches: id, ``template``, ``containment`` of the
    best window, its ``first_word`` (from 0) and ``n_windows`` that match."""
    lengths, table = _template_tables(df.sparkSession, TEMPLATES if templates is None else templates)
    docs = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("t"))
    docs = docs.filter(F.col("t").rlike("|".join(sorted({a[:6] for a in ANCHORS}))))
    docs = docs.select("rid", "id", F.regexp_extract_all("t", F.lit("[a-z0-9]+"), F.lit(0)).alias("all"))
    known = F.array(*[F.lit(a) for a in ANCHORS])
    numbered = F.transform("all", lambda w, i: F.when(F.array_contains(known, w), i))
    docs = docs.withColumn("anchors", F.filter(numbered, lambda i: i.isNotNull())).filter(F.size("anchors") > 0)

    # The windows of each length that hold an anchor, by their starts.
    def starts(n: int) -> Column:
        step, size = max(1, n // 4), n + max(1, n // 4)
        first = lambda p: F.greatest(F.lit(0), F.ceil((p - (size - 1)) / step).cast("int"))
        around = F.transform("anchors", lambda p: F.transform(F.sequence(first(p), F.floor(p / step).cast("int")), lambda i: i * step))
        return F.array_distinct(F.flatten(around))

    spans = F.flatten(F.array(*[_with_length(starts(n), n, k) for n, k in lengths]))
    windows = docs.select("rid", "id", "all", F.explode(spans).alias("at"))
    window = F.slice("all", F.col("at.start") + 1, F.col("at.size"))
    count = F.size("window") - F.col("width") + 1
    windows = windows.select("rid", "id", F.col("at.start").alias("start"), F.col("at.n").alias("words"), F.col("at.width").alias("width"), window.alias("window"))
    shingles = F.array_distinct(F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice("window", i, F.col("width")), " ")))
    windows = windows.filter(count > 0).select("rid", "id", "start", "words", shingles.alias("held"))
    banded = windows.select("*", F.explode(signature(F.col("held"))).alias("b")).select("rid", "id", "start", "words", "held", "b.band", "b.value")
    bands = table.select("template", "words", "shingles", F.explode(signature(F.col("shingles"))).alias("b")).select("template", "words", "shingles", "b.band", "b.value")
    # A row for each band of a fixed list of templates: far below any broadcast limit.
    found = banded.join(F.broadcast(bands), ["words", "band", "value"])
    held = F.size(F.array_intersect("held", "shingles"))
    checked = found.select("rid", "id", "template", "start", held.alias("shared"), F.size("shingles").alias("of")).filter(100 * F.col("shared") >= PERCENT * F.col("of"))
    share = F.col("shared") / F.col("of")
    best = checked.groupBy("rid", "id", "template").agg(F.max(share).alias("containment"), F.min(F.struct((-share).alias("less"), "start")).alias("first"), F.count_distinct("start").alias("n_windows"))
    return best.select(F.col("id").alias(id_col), "template", "containment", F.col("first.start").cast("long").alias("first_word"), "n_windows")


def _with_length(starts: Column, n: int, width: int) -> Column:
    size = n + max(1, n // 4)
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(n).alias("n"), F.lit(size).alias("size"), F.lit(width).alias("width")))
