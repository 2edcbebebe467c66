"""Licence scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

SQL functions alone. Words are lower-cased and end at blanks and ASCII punctuation, in texts and templates alike, so a header reads
the same behind comment marks, in quotes or re-wrapped. A template is a licence notice, header or body; its length in shingles (five
words) sets the length of the windows it is looked for in, each a quarter of a window after the one before. A window gets ``BANDS`` bands of ``ROWS``
MinHash values and meets the templates of its length that share a band. Since a band can only agree on a shingle of the
template, windows without any such shingle are left out beforehand, which loses nothing and ends most texts early.

A notice with at least ``CONTAINED`` of its shingles in a text has a window that agrees with it in 0.54 of their union or more,
so a band agrees with probability 0.29 and all bands miss with 0.00002. Every text and template that met are then verified on
their shingles as texts: some window, with a quarter more on both sides, holds ``CONTAINED`` of the template's shingles.

Nulls and odd input: a null or empty text has no notice; a template of fewer than five words is one shingle, the whole of it;
rows that share a ``doc_id`` (or have none) are reported together; equal windows go to the first; an empty table gives no
rows; columns of other names are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fellwalk.llm.common import bound
from fellwalk.workspace import settled

SHINGLE, CONTAINED = 5, 0.8
BANDS, ROWS = 32, 2
MOST_BROADCAST = 5000  # templates; more are joined without a hint

# Notices, headers and bodies of public licences (fixed values).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT-body": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "ISC-body": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
        AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "BSD-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "Apache-2.0-full-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "GPL-3.0-or-later-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "LGPL-2.1-or-later-header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.
        This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "BSL-1.0-header": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
        http://www.boost.org/LICENSE_1_0.txt)""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions""",
}

# Capitals become small letters; ASCII punctuation and blanks end a word, so comment marks and quotes are never part of one.
MARKS = string.punctuation + "\t\n\x0b\x0c\r"
PLAIN = string.ascii_uppercase + MARKS, string.ascii_lowercase + " " * len(MARKS)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), *PLAIN), " +"), lambda w: w != "")


def _shingled(words: Column, use) -> Column:
    """``use`` of every five words in a row, or of all if there are fewer."""
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: use(F.slice(words, i + 1, SHINGLE)))).otherwise(
        F.array().cast("array<bigint>" if use is F.xxhash64 else "array<string>"))


def _bands(hashes: Column) -> Column:
    smallest = lambda seed: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, seed)))
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, *[smallest(band * ROWS + row) for row in range(ROWS)]))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``license, span, stride, shingles, bands`` of each template."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string").withColumn("words", _words(F.col("text")))
    hashed = rows.withColumn("hashes", F.array_distinct(_shingled(F.col("words"), F.xxhash64)))
    span = F.greatest(F.size("words") - SHINGLE + 1, F.lit(1))
    return hashed.filter("size(words) > 0").select(
        "license", span.alias("span"), F.greatest(F.floor(span / 4), F.lit(1)).cast("int").alias("stride"),
        F.array_distinct(_shingled(F.col("words"), lambda w: F.array_join(w, " "))).alias("shingles"), "hashes", _bands(F.col("hashes")).alias("bands"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, license, matched, containment, first_shingle``: the best window of every licence found in a document."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    table = template_table(spark, templates)
    known = table.select("license", "span", "stride", "hashes").collect()  # a parameter, not data
    if not known:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, license string, matched bigint, containment double, first_shingle bigint")
    every = sorted({h for t in known for h in t.hashes})
    spans = sorted({(t.span, t.stride) for t in known})

    def found(words: Column, hashes: Column) -> Column:
        flagged = F.transform(hashes, lambda h, i: F.struct(h.isin(every).alias("hit"), i.alias("at")))
        hits = F.transform(F.filter(flagged, lambda f: f["hit"]), lambda f: f["at"])
        return F.struct(words.alias("words"), hashes.alias("hashes"), hits.alias("hits"))

    # everything about a text in one expression, each part bound to a name; tied to the partition, so that the filter below
    # reads its result and is not moved beneath it, where it would be made a second time
    of_text = bound(_words(F.col("text")), lambda words: bound(_shingled(words, F.xxhash64), lambda hashes: found(words, hashes)))
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.when(F.spark_partition_id() >= 0, of_text).alias("_found"))
    with_hits = texts.filter(F.size("_found.hits") > 0).select("doc_id", "_text", "_found.words", "_found.hashes", "_found.hits")

    def starts(span: int, stride: int) -> Column:
        """Starts of the windows that hold a hit."""
        first = lambda p: F.greatest(F.ceil((p - span + 1) / stride), F.lit(0)).cast("int")
        of = lambda p: F.transform(F.sequence(first(p), F.floor(p / stride).cast("int")), lambda j: j * stride)
        return F.array_distinct(F.flatten(F.transform("hits", of)))

    def windows_of(span: int, stride: int) -> Column:
        window = lambda s: F.struct(F.lit(span).alias("span"), F.lit(stride).alias("stride"), s.alias("start"))
        return F.transform(starts(span, stride), window)

    placed = F.flatten(F.array(*[windows_of(span, stride) for span, stride in spans]))
    windows = with_hits.select("doc_id", "_text", "words", "hashes", F.explode(placed).alias("w")).select("doc_id", "_text", "w.*", "words", "hashes")
    begin = F.greatest(F.col("start") - F.col("stride"), F.lit(0))
    cut = windows.select(
        "doc_id", "_text", "span", "start",
        F.slice("hashes", F.col("start") + 1, F.col("span")).alias("inner"),
        F.slice("words", begin + 1, F.col("start") + F.col("span") + F.col("stride") - begin + SHINGLE - 1).alias("around"))

    cut = settled(cut, "licence-windows")  # few texts have any; read twice below

    small = (lambda df: F.broadcast(df)) if len(templates) <= MOST_BROADCAST else (lambda df: df)
    bands = table.select("license", "span", F.explode("bands").alias("band"))
    met = cut.select("doc_id", "_text", "span", F.explode(_bands(F.col("inner"))).alias("band")).join(small(bands), ["span", "band"])
    candidates = met.select("doc_id", "_text", "license").dropDuplicates()

    held = cut.select("doc_id", "_text", "span", "start", F.array_distinct(_shingled(F.col("around"), lambda w: F.array_join(w, " "))).alias("there"))
    judged = held.join(small(table.select("license", "span", "shingles")), "span").select(
        "doc_id", "_text", "license", "start", F.size(F.array_intersect("shingles", "there")).alias("matched"), F.size("shingles").alias("of"))
    enough = judged.filter(F.col("matched") >= CONTAINED * F.col("of"))
    same = (enough["doc_id"].eqNullSafe(candidates["doc_id"])) & (enough["_text"] == candidates["_text"]) & (enough["license"] == candidates["license"])
    verified = enough.join(candidates, same, "left_semi")
    best = verified.groupBy("doc_id", "license").agg(F.max(F.struct("matched", (-F.col("start")).alias("back"), "of")).alias("_best"))
    return best.select(
        "doc_id", "license", F.col("_best.matched").cast("bigint").alias("matched"),
        (F.col("_best.matched") / F.col("_best.of")).alias("containment"), (-F.col("_best.back")).cast("bigint").alias("first_shingle"))
