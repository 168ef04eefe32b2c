"""Licence scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Expressions and joins of Spark alone. Words are runs of letters, digits and points inside numbers, in lower case; shingles
are two words, as xxhash64. A template is cut into windows as a text is. BANDS bands of one minimum each: a window that
holds a template piece of s shingles agrees with it in some band with the chance 1 - (1 - s / WINDOW) ** BANDS at least,
which is over 0.999 for half a window. So windows of which less than half may be shingles of any template, nearly all, aren't
banded: a table of bits tells, whatever the number of templates.

The templates' bands are a table by (band, value). A window's bands are joined to it, so a text meets only templates that
it shares a band with; these alone are verified, around the windows that found them.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, small

# Notices by which works name their licence, and the wording that identifies a full text.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    # clauses of full texts
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("GPL-2.0", "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"),
    ("CC-BY-ND-4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
]

# Full texts, without names and years.
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
FULL_TEXTS = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_TAIL}"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
]

WORD = r"[\p{L}\p{N}]+(?:\.[\p{N}]+)*"
#: Shingles of a window and between windows' beginnings; bands; share of a template's shingles that verifies it.
WINDOW, STRIDE, BANDS, CONTAINED = 8, 4, 10, 0.9


def _shingles(words: Column) -> Column:
    """Hashes of the two-word shingles of an array of words, in order."""
    n = F.size(words)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1)))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<bigint>"))


def _masks(seed: int = 11) -> list[int]:
    rng = random.Random(seed)
    return [rng.getrandbits(63) for _ in range(BANDS)]


def _bands(window: Column) -> list[Column]:
    """For each band, the least of a window's hashes, each hashed anew with the band's mask: any is as likely as another, in each band apart."""

    def turned(mask: int):
        return lambda h: F.xxhash64(h, F.lit(mask))

    return [F.array_min(F.transform(window, turned(m))) for m in _masks()]


def _windows(hashes: Column, picked: Column) -> Column:
    """at and bands of the windows that begin at the places in `picked`."""
    return F.transform(picked, lambda i: F.struct(i.alias("at"), F.array(*_bands(F.slice(hashes, i + 1, WINDOW))).alias("bands")))


def _starts(hashes: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(hashes) - STRIDE - 1, F.lit(0)), F.lit(STRIDE))


def _hashed(df: DataFrame) -> DataFrame:
    """df with h, the hashes of its texts' shingles, in place of text; words are taken in a step of their own, once a text."""
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0))
    return df.withColumn("_w", words).drop("text").withColumn("h", _shingles(F.col("_w"))).drop("_w")


def templates(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """number, license, h (shingles in order), shingles (distinct ones) of each template."""
    df = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(texts)], "number int, license string, text string")
    df = _hashed(df)
    return cut(df.withColumn("shingles", F.array_distinct("h")).filter(F.size("shingles") > 0))


def _banded(df: DataFrame, *own: str) -> DataFrame:
    """own, at, band, value: a row for each band of each window of df (h, begins), one with nulls without windows: no filter is inferred, which would be pushed down to the text with all of this in it."""
    df = df.select(*own, F.explode_outer(_windows(F.col("h"), F.col("begins"))).alias("w"))
    return df.select(*own, F.col("w.at").alias("at"), F.posexplode_outer("w.bands").alias("band", "value"))


def _marked(shingles: list[int]):
    """A test whether a shingle's bit is set in a table of bits, one in sixteen of which the given ones set: it passes all of these and few others."""
    bits = 1 << max(12, (16 * len(shingles)).bit_length())
    longs = [0] * (bits // 64)
    for h in shingles:
        longs[(h & bits - 1) >> 6] |= 1 << (h & 63)
    table = F.from_json(F.lit(json.dumps([x - (1 << 64) if x >> 63 else x for x in longs])), "array<bigint>")

    def test(x: Column) -> Column:
        slot = x.bitwiseAND(F.lit(bits - 1))
        return F.call_function("shiftright", F.get(table, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def candidates(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, key, number, ats: templates that share a band with a text, and its windows that do."""
    shingles = [r[0] for r in known.select(F.explode("shingles").alias("x")).distinct().collect()]  # as many as the templates have
    least = min([WINDOW // 2, *(r[0] for r in known.agg(F.min(F.size("shingles"))).collect() if r[0])])
    df = _hashed(docs.select("doc_id", "key", "text"))
    df = df.withColumn("known", F.transform("h", _marked(shingles)))
    enough = lambda at: F.size(F.filter(F.slice("known", at + 1, WINDOW), lambda x: x)) >= least
    begins = F.when(F.array_contains("known", F.lit(True)), F.filter(F.sequence(F.lit(0), F.size("h") - 1, F.lit(STRIDE)), enough))
    df = df.select("doc_id", "key", "h", begins.alias("begins"))
    index = _banded(known.select("number", "h", _starts(F.col("h")).alias("begins")), "number").select("band", "value", "number").distinct()
    met = _banded(df, "doc_id", "key").join(small(cut(index)), ["band", "value"])
    return cut(met.groupBy("doc_id", "key", "number").agg(F.array_sort(F.collect_set("at")).alias("ats")))


def _places(h: Column, shingles: Column, ats: Column, contained: float) -> Column:
    """containment, start, end of the verified places around the windows at `ats`: enough of the template's shingles are in the text from a template's length before a window on."""
    n = F.size(shingles)
    reach = 2 * n + WINDOW
    low = F.array_distinct(F.transform(ats, lambda at: F.greatest(at - n, F.lit(0))))
    checked = F.transform(low, lambda x: F.struct((F.size(F.array_intersect(shingles, F.slice(h, x + 1, reach))) / n).alias("containment"), x.alias("low")))
    good = F.filter(checked, lambda x: x["containment"] >= contained)

    def place(x: Column) -> Column:
        text = F.slice(h, x["low"] + 1, reach)

        def shortest(v: Column) -> Column:
            begins = F.filter(F.transform(v["text"], lambda y, i: F.when(F.array_contains(v["common"], y), i)), lambda i: i.isNotNull())
            firsts = F.transform(begins, lambda i: F.struct(i.alias("i"), F.transform(v["common"], lambda y: F.array_position(F.slice(v["text"], i + 1, reach), y)).alias("first")))
            whole = F.filter(firsts, lambda f: F.array_min(f["first"]) > 0)
            return F.array_min(F.transform(whole, lambda f: F.struct(F.array_max(f["first"]).cast("int").alias("n"), f["i"].alias("i"))))

        best = F.transform(F.array(F.struct(text.alias("text"), F.array_intersect(shingles, text).alias("common"))), shortest)
        return F.get(F.transform(best, lambda s: F.struct(x["containment"].alias("containment"), (x["low"] + s["i"]).alias("start"), (x["low"] + s["i"] + s["n"] + 1).alias("end"))), F.lit(0))

    return F.array_distinct(F.transform(good, place))


def matches(docs: DataFrame, texts: list[tuple[str, str]] | None = None, contained: float = CONTAINED) -> DataFrame:
    """doc_id, found: array of (license, containment, start, end), a row for each document.

    start and end count words, from 0, end excluded: the shortest stretch with all of the template's shingles that a
    retrieved window's surroundings have. A template is in found once for each place where it is verified.
    """
    known = templates(docs.sparkSession, texts or [*TEMPLATES, *FULL_TEXTS])
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    met = candidates(docs, known).withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    rows = docs.join(small(met), same).join(small(known.select("number", "license", "shingles")), "number")
    rows = _hashed(rows.select("_id", "_key", "license", "shingles", "ats", "text"))
    found = F.transform(_places(F.col("h"), F.col("shingles"), F.col("ats"), contained), lambda x: F.struct(F.col("license"), x["containment"].alias("containment"), x["start"].alias("start"), x["end"].alias("end")))
    # copies of a row, and templates of one licence, tell the same place once
    found = rows.select("_id", "_key", F.explode_outer(found).alias("x")).groupBy("_id", "_key").agg(F.array_sort(F.collect_set("x")).alias("_found"))
    # of matches that overlap, those that another contains more of go: one version's notice nearly contains another's
    both = F.col("_found")
    best = F.filter(both, lambda x: ~F.exists(both, lambda y: (y["containment"] > x["containment"]) & (y["start"] < x["end"]) & (x["start"] < y["end"])))
    found = cut(found.select("_id", "_key", best.alias("found")))
    empty = F.array().cast("array<struct<license: string, containment: double, start: int, end: int>>")
    return docs.select("doc_id", "key").join(small(found), same, "left").select("doc_id", F.coalesce("found", empty).alias("found"))


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, licenses (sorted, comma-joined; empty if none), n_licenses, containment (the best; null if none).

    Null and empty texts have none; repeated rows get a row each; an empty table gives none. Texts of any length are
    scanned whole; docs' other columns play no part, whatever their names. Of matches in the same place the fullest
    stays, and all of them where they are equally full.
    """
    found = matches(docs)
    names = F.array_sort(F.array_distinct(F.col("found.license")))
    return found.select("doc_id", F.array_join(names, ",").alias("licenses"), F.size(names).alias("n_licenses"), F.array_max(F.col("found.containment")).alias("containment"))
