"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

A template of s five-word shingles belongs to the scale L, the power of two with L / 2 < s <= L. At
that scale a text is covered by windows of 3/2 L shingles every L / 2 (two and one for L = 1), so any
run of L shingles lies within one window whole. A window that holds 0.8 of a template shares at least
0.8 s of at most 3/2 L + 0.2 s shingles with it, a Jaccard similarity of 0.8 (L / 2) / (3/2 L + 0.1 L) = 0.25 or more.
With BANDS bands of one row the chance to miss it is (1 - 0.25)^BANDS, 1e-4 for 32 bands; a band of one row
seldom gives a candidate that shares nothing. Each candidate is then verified by the exact share of the
template's shingles that the window holds.

Only windows that share a shingle with any template, in texts that do, get bands; others cannot hold 0.8 of one, so nothing
is lost. All of it is DataFrame functions, row by row; templates (LARGEST shingles at most) are broadcast.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.llm.common import once, repeated, row_key, text_of

WORDS, CONTAINMENT, BANDS = 5, 0.8, 32
#: Shingles of all templates together; more are refused, which bounds the broadcast.
LARGEST = 200_000

# Short notices and opening passages of public licenses.
TEMPLATES = {
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    "MIT warranty": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT short": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies.""",
    "GPL-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc.""",
    "LGPL-2.1 notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by
        the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "LGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "AGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
        You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0 short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 short": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0 short": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
        (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
}
WORD_END = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_END), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of the WORDS-word shingles in order; a text of fewer words has none. words must be a column that is read more than once."""
    each = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WORDS))))
    return F.slice(each, 1, F.greatest(F.size(words) - (WORDS - 1), F.lit(0)))


def scale_of(shingles: int) -> int:
    return 1 << max(0, (shingles - 1).bit_length())


def window_length(scale: int) -> int:
    return scale + max(1, scale // 2)


def band_seeds() -> list[int]:
    """Constants whose leading bits differ, so that the least hash under exclusive or is another element for each."""
    golden = 0x9E3779B97F4A7C15
    seeds = [((i << 59) | ((golden * (i + 1)) & ((1 << 59) - 1))) & ((1 << 64) - 1) for i in range(BANDS)]
    return [s - (1 << 64) if s >> 63 else s for s in seeds]


def bands(shingles: Column) -> Column:
    """Structs (band, value): the least hash under each band's permutation. One expression for all bands keeps the generated code small."""
    seeds = F.array(*(F.lit(s).cast("long") for s in band_seeds()))
    return F.transform(seeds, lambda s, i: F.struct(i.alias("band"), F.array_min(F.transform(shingles, lambda h: h.bitwiseXOR(s))).alias("value")))


def template_frame(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """(license, shingles, n, scale) of templates of WORDS words or more; shorter ones are refused."""
    if sum(len(t.split()) for t in templates.values()) > LARGEST:
        raise ValueError(f"templates may have {LARGEST} words at most")
    short = [k for k, t in templates.items() if sum(any(c.isalnum() for c in w) for w in re.split(r"[\W_]+", t)) < WORDS]
    if short:
        raise ValueError(f"templates need {WORDS} words: {short}")
    listed = F.from_json(F.lit(json.dumps([{"license": k, "text": t} for k, t in templates.items()])), "array<struct<license: string, text: string>>")
    rows = spark.range(1).select(F.explode(listed).alias("t")).select("t.license", words_of(F.col("t.text")).alias("w"))
    rows = rows.select("license", F.array_distinct(shingles_of(F.col("w"))).alias("shingles")).withColumn("n", F.size("shingles"))
    return rows.withColumn("scale", F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int"))


def candidates(holders: DataFrame, templates: DataFrame, scales: list[int], known_shingles: Column) -> DataFrame:
    """Windows of holders(key1, key2, shingles) that share a band with a template of their scale."""
    plan = F.array(*(F.struct(F.lit(s).alias("scale"), F.lit(window_length(s)).alias("length"), F.lit(max(1, s // 2)).alias("step")) for s in scales))
    placed = holders.select("*", F.explode(plan).alias("p"))
    starts = F.sequence(F.lit(0), F.size("shingles") - 1, F.col("p.step"))
    windows = placed.withColumn("start", F.explode(starts))
    windows = once(windows.select("key1", "key2", "p", "start", F.slice("shingles", F.col("start") + 1, F.col("p.length")).alias("window"))).where(F.arrays_overlap("window", known_shingles))
    keyed = windows.select("key1", "key2", "start", "window", F.col("p.scale").alias("scale"), bands(F.col("window")).alias("bands"))
    keyed = keyed.select("*", F.explode("bands").alias("b")).select("key1", "key2", "start", "window", "scale", "bands", "b.band", "b.value")
    known = templates.select("license", "scale", "shingles", "n", bands(F.col("shingles")).alias("own_bands"))
    known = known.select("license", "scale", F.col("shingles").alias("template"), "n", "own_bands", F.explode("own_bands").alias("b")).select("license", "scale", "template", "n", "own_bands", "b.band", "b.value")
    met = keyed.join(F.broadcast(known), ["scale", "band", "value"])
    # a window and a template meet in many bands: the first of them verifies
    first = F.array_position(F.zip_with("bands", "own_bands", lambda a, b: a["value"] == b["value"]), True) - 1
    return met.where(F.col("band") == first).drop("bands", "own_bands")


def license_scan(docs: DataFrame, templates: Mapping[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document and license it holds: id, license, containment (0.8 to 1) and first_word, the place of the first word of the best window.

    Null, empty and short texts hold none. Documents without a license give no row; each row of docs counts as a document, and rows that are
    equal in id and text give theirs as often. Ids may be null; an id column named like a column of the result is refused. Other columns are not read.
    """
    if id_col in ("license", "containment", "first_word"):
        raise ValueError(f"the id column must not be named {id_col}")
    spark = docs.sparkSession
    chosen = template_frame(spark, templates if templates is not None else TEMPLATES)
    facts = chosen.agg(F.collect_set("scale").alias("scales"), F.flatten(F.collect_list("shingles")).alias("all")).first()
    known = F.from_json(F.lit(json.dumps(sorted(set(facts["all"])))), "array<bigint>")
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    worded = docs.select(F.col(id_col).alias("id"), k1.alias("key1"), k2.alias("key2"), words_of(text_of(text_col)).alias("w"))
    holders = once(worded.select("id", "key1", "key2", shingles_of(F.col("w")).alias("shingles"))).where(F.arrays_overlap("shingles", known))
    named = holders.withColumns({"key1": F.struct("id", "key1")})
    found = candidates(named, chosen, sorted(facts["scales"]), known)
    share = F.size(F.array_intersect("window", "template")) / F.col("n")
    # equal rows have equal windows: each start counts them
    verified = found.select("key1", "key2", "license", "start", share.alias("containment")).where(F.col("containment") >= CONTAINMENT)
    placed = verified.groupBy("key1", "key2", "license", "start").agg(F.max("containment").alias("containment"), F.count(F.lit(1)).alias("copies"))
    best = placed.groupBy("key1", "key2", "license").agg(F.max(F.struct("containment", (-F.col("start")).alias("back"), "copies")).alias("best"))
    out = best.select(F.col("key1.id").alias(id_col), "license", F.col("best.containment").alias("containment"), (-F.col("best.back")).cast("long").alias("first_word"), F.col("best.copies").alias("_copies"))
    return repeated(out, "_copies")
