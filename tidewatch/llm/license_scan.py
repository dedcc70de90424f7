"""License notices in texts, with built-in functions only.

Words are lower-cased (A-Z) and stripped of punctuation at their ends; a template and a text are lists of five-word shingles. Each
template is searched by overlapping windows of as many shingles as it has (the whole text where that is shorter). `BANDS` MinHash
bands of one sample each retrieve templates for a window: a window that holds 80 % of a template's shingles has a similarity of 2/3 or
more and is missed with a probability of at most (1/3)^16 < 3e-8. Exact containment of the template's shingles in the window then
decides. A window can only collide with a template in a band if it holds the template's shingle of least sample there, its lead; so the
windows are made around leads, at most `BANDS` a template however long it is, and all others are known not to collide.

Defined cases: null, empty and very short texts hold nothing; very long texts are searched whole; repeated rows are reported once each; a template of fewer than five words
raises ValueError; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, words_of

SHINGLE, BANDS, CONTAINED = 5, 16, 0.8
#: Rows of the template table that may be broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 50_000

#: Public license notices: one-line references and the standard paragraphs (fixed values).
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "CC-BY-4.0": "Licensed under CC BY 4.0 International",
    "CC-BY-4.0 full": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-SA-4.0 full": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0 header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def clean_words(text: Column) -> Column:
    return F.filter(F.transform(words_of(lower_ascii(text)), lambda w: F.regexp_replace(w, r"^[\p{Punct}]+|[\p{Punct}]+$", "")), lambda w: w != "")


def shingles(words: Column) -> Column:
    at = lambda i, k: F.get(words, i + k)
    joined = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.concat_ws(" ", *[at(i, k) for k in range(SHINGLE)]))
    return F.when(F.size(words) >= SHINGLE, joined).otherwise(F.array().cast("array<string>"))


def bands(hashes: Column) -> Column:
    """MinHash samples of an array of shingle hashes, one a band."""

    def sample(i: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(i))))

    return F.array(*map(sample, range(BANDS)))


def leads(hashes: Column) -> Column:
    """The shingle hash of the least sample in each band."""

    def least(i: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.struct(F.xxhash64(h, F.lit(i)).alias("v"), h.alias("h"))))["h"]

    return F.array_distinct(F.array(*map(least, range(BANDS))))


def window_starts(spots: Column, n: int) -> Column:
    """(n, a) for each start a of a window of n shingles that holds one of the spots."""
    around = F.transform(spots, lambda p: F.sequence(F.greatest(p - n + 1, F.lit(0)), p))
    return F.transform(F.array_distinct(F.flatten(around)), lambda a: F.struct(F.lit(n).alias("n"), a.alias("a")))


def template_table(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    """(license, n, own): a template's number of positions and its distinct shingles."""
    if short := [k for k, v in notices.items() if len(v.split()) < SHINGLE]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    rows = spark.createDataFrame(sorted(notices.items()), "license string, body string")
    cut = rows.withColumn("words", clean_words(F.col("body"))).withColumn("s", shingles(F.col("words")))
    return cut.select("license", F.size("s").alias("n"), F.array_distinct("s").alias("own"))


def scan(docs: DataFrame, notices: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license, containment, first_word, n_windows): for each row and template found, the best window, its first word (from 0) and how many windows hold the template."""
    spark = docs.sparkSession
    templates = template_table(spark, notices or NOTICES)
    known = templates.select("n", leads(F.transform("own", lambda s: F.xxhash64(s))).alias("h")).collect()  # the templates, not the corpus
    of: dict[int, set[int]] = {}
    for r in known:
        of.setdefault(r["n"], set()).update(r["h"])
    every = sorted(set().union(*of.values()))
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), clean_words(F.col(text).cast("string")).alias("words"))
    cut = own.where(F.size("words") >= SHINGLE).withColumn("h", F.transform(F.sequence(F.lit(0), F.size("words") - SHINGLE), lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(F.col("words"), i + k) for k in range(SHINGLE)]))))
    spot = lambda h, i: F.when(h.isin(every), F.struct(i.alias("i"), h.alias("h")))
    near = cut.withColumn("spots", F.filter(F.transform("h", spot), lambda s: s.isNotNull())).where(F.size("spots") > 0)
    # The starts of windows that hold a lead, for each length; then the windows with their own shingles.
    at = {n: F.transform(F.filter("spots", lambda s: s["h"].isin(sorted(own))), lambda s: s["i"]) for n, own in sorted(of.items())}
    starts = F.flatten(F.array(*[window_starts(spots, n) for n, spots in at.items()]))
    end = F.col("w.a") + F.col("w.n")
    windows = near.select("row", "doc_id", "words", "h", F.explode(starts).alias("w")).where((end <= F.size("h")) | ((F.col("w.a") == 0) & (end > F.size("h"))))
    windows = windows.select("row", "doc_id", "w.n", "w.a", F.slice("words", F.col("w.a") + 1, F.col("w.n") + SHINGLE - 1).alias("words"), F.slice("h", F.col("w.a") + 1, F.col("w.n")).alias("h"))
    windows = windows.withColumn("b", bands(F.col("h")))
    keyed = windows.select("row", "doc_id", "n", "a", "words", F.posexplode("b").alias("band", "value"))
    wanted = templates.withColumn("b", bands(F.transform("own", lambda s: F.xxhash64(s)))).select("license", "n", "own", F.posexplode("b").alias("band", "value"))
    wanted = F.broadcast(wanted) if len(known) * BANDS <= BROADCAST_ROWS else wanted
    held = F.size(F.array_intersect(F.array_distinct(shingles(F.col("words"))), F.col("own"))) / F.size("own")
    found = keyed.join(wanted, ["n", "band", "value"]).withColumn("containment", held).where(F.col("containment") >= CONTAINED)
    best = F.max(F.struct(F.col("containment"), (-F.col("a")).alias("a")))
    out = found.groupBy("row", "doc_id", "license").agg(best.alias("best"), F.count_distinct("a").cast("long").alias("n_windows"))
    return out.select("doc_id", "license", F.col("best.containment").alias("containment"), (-F.col("best.a")).cast("long").alias("first_word"), "n_windows")
