"""License scan on DataFrame functions only: MinHash bands over overlapping word windows.

Words are runs of a-z and 0-9 after lower-casing A-Z, shingles are three consecutive words.

1. Only documents that can match are cut into words.  A match holds at least ``containment``
   of a template's shingles and all of its identifying ones, so it holds one with an anchor word
   as soon as the anchors touch more than the rest of them, or one identifying shingle;
   ``anchors`` picks few words with that property, and a document without any can't match.
2. Windows of WINDOW words start every STRIDE words, so any run of WINDOW - STRIDE + 1 words
   lies inside one.  Templates longer than a window are cut the same way.
3. A window's signature is BANDS minima of seeded hashes of its shingles, one row a band.
   A window and a template piece of Jaccard J share a band with probability
   1 - (1 - J)**BANDS: at J = 0.25, which a whole template of five words still reaches inside
   a window, that is 0.9999.
4. Retrieved pairs are verified: the largest share of the template's distinct shingles, as
   words and not as hashes, in any run of as many words as the template has.  A run counts
   only if it holds every shingle of the template's identifying part (``identity``: version,
   clause or name), so versions of nearly the same wording are told apart.

Defined cases
-------------
* null and empty texts, and texts of fewer than three words: no match.
* templates of fewer than three words, or null, are left out; no templates: an empty result.
* repeated rows and ids: one row per id and template, with the largest containment.
* a template without an identifying part, or with one of fewer than three words, is matched
  by containment alone.
* extra columns are ignored.
* texts of any length are scanned whole.  A document's windows are rows of their own, so a
  long document is never held against all templates at once.

Template pieces are broadcast while there are at most ``max_broadcast_rows`` bands of them
and joined by shuffle beyond that.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of templates that are too frequent in any prose to tell where a license may be.
COMMON = frozenset(("above", "under", "their", "other", "without", "whether", "including", "provided", "following"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Q, WINDOW, STRIDE, BANDS = 3, 12, 6, 32

# Notices by which texts state their license, standard headers, and short licenses (MIT whole, ISC and BSD without the last clauses).
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0-warranty": """Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "mit-notice": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
        WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
        THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS.""",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY""",
    "bsd-3-clause-endorsement": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software.""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "gpl-warranty": "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl-1.1-header": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "epl-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "bsl-1.0-notice": "Distributed under the Boost Software License, Version 1.0",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4.0-international": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0-1.0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
}
# The parts of a template that tell its license, version or clauses from others of nearly the same wording.
IDENTITY = {
    "apache-2.0-notice": "Apache License, Version 2.0",
    "bsd-2-clause": "the distribution. THIS SOFTWARE IS PROVIDED",
    "gpl-2.0-notice": "GNU General Public License, version 2",
    "gpl-3.0-notice": "GNU General Public License, version 3",
    "gpl-redistribute": "the GNU General Public License",
    "lgpl-redistribute": "the GNU Lesser General Public License",
    "agpl-redistribute": "the GNU Affero General Public License",
    "mpl-1.1-header": "Mozilla Public License Version 1.1",
    "mpl-2.0-header": "Mozilla Public License, v. 2.0",
    "epl-2.0-header": "Eclipse Public License 2.0",
    "bsl-1.0-notice": "Boost Software License, Version 1.0",
    "cc-by-nc-4.0-notice": "CC BY-NC 4.0",
    "cc-by-4.0-notice": "Creative Commons Attribution 4.0 International",
    "cc-by-sa-4.0-notice": "Attribution-ShareAlike 4.0 International",
    "cc-by-nc-4.0-international": "Attribution-NonCommercial 4.0 International",
}


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def _shingle_set(text: str | None) -> set[tuple[str, ...]]:
    w = template_words(text or "")
    return {tuple(w[i : i + Q]) for i in range(len(w) - Q + 1)}


def anchors(templates: dict[str, str], containment: float, identity: dict[str, str] = {}) -> list[str]:
    """Words of which every match holds at least one: chosen greedily, rarer and longer ones first."""
    open_sets = []
    for name, text in templates.items():
        shingles, must = _shingle_set(text), _shingle_set(identity.get(name))
        if shingles and must:  # a match holds all of these
            open_sets.append([must, 1])
        elif shingles:
            open_sets.append([shingles, len(shingles) - math.ceil(containment * len(shingles)) + 1])
    out: list[str] = []
    while open_sets:
        # every open set still needs to be touched: value of a word is how much of the need it covers
        gain: Counter = Counter()
        for shingles, need in open_sets:
            words = {x for s in shingles for x in s}
            for word in {x for x in words - COMMON if len(x) > 6} or {x for x in words - COMMON if len(x) > 4} or words:
                gain[word] += min(need, sum(word in s for s in shingles)) / need
        word = max(gain, key=lambda x: (round(gain[x], 6), len(x), x))
        out.append(word)
        left = []
        for shingles, need in open_sets:
            hit = {s for s in shingles if word in s}
            if need > len(hit):
                left.append([shingles - hit, need - len(hit)])
        open_sets = left
    return out


def words_col(text) -> F.Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0))


def _shingles(words: F.Column, as_hash: bool) -> F.Column:
    """Shingles of an array of at least Q words, in order."""
    at = lambda i, k: F.element_at(words, (i + k).cast("int"))
    make = (lambda i: F.xxhash64(*(at(i, k) for k in range(Q)))) if as_hash else (lambda i: F.concat_ws(" ", *(at(i, k) for k in range(Q))))
    return F.transform(F.sequence(F.lit(1), F.size(words) - (Q - 1)), make)


def _bands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, band, value) of the windows of rows with an array ``words`` of at least Q words."""
    r = rows.withColumn("hashes", _shingles(F.col("words"), True)).select(*keys, "hashes")
    starts = F.sequence(F.lit(1), F.size("hashes"), F.lit(STRIDE))
    r = r.select(*keys, F.explode(F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice("hashes", s, WINDOW - Q + 1).alias("h")))).alias("w"))
    seeds = F.sequence(F.lit(0), F.lit(BANDS - 1))
    sig = F.transform(seeds, lambda k: F.array_min(F.transform(F.col("w.h"), lambda x: F.xxhash64(x, k))))
    return r.select(*keys, F.col("w.start").alias("start"), F.posexplode(sig).alias("band", "value"))


def template_table(spark: SparkSession, templates: dict[str, str], identity: dict[str, str]) -> DataFrame:
    """(license, words, must): must is the words of the identifying part, null without one."""
    rows = [(k, v, identity.get(k)) for k, v in sorted(templates.items()) if v is not None and len(template_words(v)) >= Q]
    return spark.createDataFrame(rows, "license string, text string, part string").select(
        "license", words_col(F.col("text")).alias("words"), words_col(F.col("part")).alias("must")
    )


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    containment: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_broadcast_rows: int = 200_000,
    identity: dict[str, str] = IDENTITY,
) -> DataFrame:
    """(id, license, containment) of every document and template that match."""
    spark = docs.sparkSession
    templates = {k: v for k, v in templates.items() if v is not None and len(template_words(v)) >= Q}
    text = F.col(text_col).cast("string")
    if not templates:
        return docs.where(F.lit(False)).select(id_col, F.lit("").alias("license"), F.lit(0.0).alias("containment"))
    possible = text.rlike("(?i)(?<![a-z0-9])(?:" + "|".join(anchors(templates, containment, identity)) + ")(?![a-z0-9])")
    found = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(possible)
    # a text is known by its id and hash, so repeated ids are no trouble
    cut = found.select("id", F.xxhash64("text").alias("h"), words_col(F.col("text")).alias("words")).where(F.size("words") >= Q)

    t = template_table(spark, templates, identity)
    n_bands = sum(math.ceil((len(template_words(v)) - Q + 1) / STRIDE) for v in templates.values()) * BANDS
    small = n_bands <= max_broadcast_rows
    pieces = _bands(t, ["license"]).select("license", "band", "value").distinct()
    hits = _bands(cut, ["id", "h"]).join(F.broadcast(pieces) if small else pieces, ["band", "value"]).select("id", "h", "start", "license").distinct()

    none = F.array().cast("array<string>")
    must = F.when(F.size("must") >= Q, F.array_distinct(_shingles(F.col("must"), False))).otherwise(none)
    t = t.select("license", F.array_distinct(_shingles(F.col("words"), False)).alias("known"), must.alias("must"), F.size("words").alias("m"))
    lengths = t.select("license", "m")
    hits = hits.join(F.broadcast(lengths) if small else lengths, "license").alias("x")
    # a row per spot, cut to its region where it is joined: no row holds all spots of a document
    both = cut.alias("c").join(hits, F.col("c.id").eqNullSafe(F.col("x.id")) & (F.col("c.h") == F.col("x.h")))
    m = F.col("x.m")
    region = both.select(
        F.col("c.id").alias("id"), "x.license", F.slice("c.words", F.greatest(F.lit(1), F.col("x.start") - m), F.lit(WINDOW) + 2 * m).alias("words")
    )
    region = region.where(F.size("words") >= Q).select("id", "license", _shingles(F.col("words"), False).alias("sh"))
    region = region.join(F.broadcast(t) if small else t, "license")
    # most spots share one shingle by chance: the whole region bounds each of its runs
    enough = lambda x: F.size(F.array_intersect("known", x)) / F.size("known") >= containment
    whole = lambda x: F.size(F.array_intersect("must", x)) == F.size("must")
    region = region.where(enough(F.col("sh")) & whole(F.col("sh")))
    runs = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("sh") - F.col("m") + Q))
    run = lambda i: F.slice("sh", i, F.col("m") - (Q - 1))
    best = F.array_max(F.transform(runs, lambda i: F.when(whole(run(i)), F.size(F.array_intersect("known", run(i)))).otherwise(0)))
    share = best / F.size("known")
    return (
        region.select("id", "license", share.alias("containment"))
        .where(F.col("containment") >= containment)
        .groupBy(F.col("id").alias(id_col), "license")
        .agg(F.max("containment").alias("containment"))
    )
