r"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Native: DataFrame expressions only.

Texts are lower-cased (A-Z) and cut into words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`; five words are a
shingle, fewer words are one. A window is two shingles that follow each other (the first and the last one
also make a window by themselves), so that each shingle lies in two windows. Documents and templates are
windowed alike. Each of BANDS bands has one MinHash: the least of the window's shingle hashes, mixed
with the band's mask by xxhash64. A shingle of the document that a template has too is, in one band, the
least of one of its two windows there and here with probability of at least 8/15 (the integral of
(1 - u**2)**2, if all neighbours differ; 2/3 for templates of one shingle), so that all BANDS = 16
miss it with 5e-6 at most (2e-8 for one shingle), and miss a template that has more of them less often.

1. Bands come first: the values of every window are joined with the index of the templates' values,
   which is bounded and broadcast, and those that meet retrieve templates.
2. Then the document's shingles (a long one in parts of PART) are intersected with those of the
   templates that were retrieved, and it is a match if it holds at least CONTAINED of a template's.

Rows are (document, template) matches. Defined results: null and empty texts match nothing; rows
that repeat give one match; a null doc_id is kept; templates without words are no templates; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, BANDS, CONTAINED = 5, 16, 0.75
#: Shingles of the templates of one pass, which bounds its index; more templates take more passes.
BLOCK_SHINGLES = 20_000
#: Shingles of a part of a document.
PART = 4096
# Texts by which licenses are named or granted.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl-2.0-header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("agpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Odd multiples of the golden ratio's 64 bits, one for each band.
_MASKS = [((0x9E3779B97F4A7C15 * (2 * b + 1)) % 2**64) - 2**63 for b in range(BANDS)]


def _words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


# Each step is a projection of its own: what a lambda refers to must be a column, or it is
# computed again for every element.


def _shingles(words: Column) -> Column:
    """Hashes of the shingles; xxhash64 passes over the nulls behind the last word."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - WIDTH, F.lit(0)))
    return F.when(F.size(words) > 0, F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]))).otherwise(F.array().cast("array<bigint>"))


def _windows(shingles: Column) -> Column:
    """Pairs (a, b) of neighbours, the first and the last with themselves."""
    return F.arrays_zip(F.concat(F.slice(shingles, 1, 1), shingles).alias("a"), F.concat(shingles, F.slice(shingles, -1, 1)).alias("b"))


def _band(b: int) -> Column:
    return F.least(*[F.xxhash64(F.col(f"_window.{side}").bitwiseXOR(F.lit(_MASKS[b]))) for side in ("a", "b")])


def _bands() -> Column:
    """The window's value in each band; those of one shingle differ from band to band."""
    return F.array(*[_band(b) for b in range(BANDS)])


def scan_licenses(docs: DataFrame, templates=TEMPLATES, doc_id: str = "doc_id", text: str = "text", contained: float = CONTAINED, block: int = BLOCK_SHINGLES, part: int = PART) -> DataFrame:
    """doc_id, license, shared and shingles: the template's different shingles, and those in the document."""
    spark = docs.sparkSession
    named = spark.createDataFrame([tuple(t) for t in templates], "license string, body string")
    named = named.select("license", _words(F.col("body")).alias("_words")).where("size(_words) > 0").select("license", _shingles(F.col("_words")).alias("_all"))
    windowed = named.select("license", F.array_distinct("_all").alias("_wanted"), F.explode(_windows(F.col("_all"))).alias("_window"))
    rows = windowed.select("license", "_wanted", _bands().alias("_bands")).collect()  # the templates, which the caller gave
    blocks: list[dict] = [{}]
    size = 0
    for row in rows:
        key = (row["license"], tuple(row["_wanted"]))
        if key not in blocks[-1] and size and size + len(key[1]) > block:
            blocks.append({})
            size = 0
        size += len(key[1]) * (key not in blocks[-1])
        blocks[-1].setdefault(key, set()).update(row["_bands"])
    return reduce(DataFrame.unionByName, [_scan_block(docs, b, doc_id, text, contained, part) for b in blocks])


def _scan_block(docs: DataFrame, templates: dict, doc_id: str, text: str, contained: float, part: int) -> DataFrame:
    """templates: the band values of (license, different shingles)."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i, name, list(w)) for i, (name, w) in enumerate(templates)], "_template int, license string, _wanted array<bigint>")
    index = spark.createDataFrame(sorted((v, i) for i, own in enumerate(templates.values()) for v in own), "_known long, _of int")

    own = F.col(f"`{text}`")
    worded = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), own).alias("_row"), _words(own).alias("_words"))
    hashed = worded.where("size(_words) > 0").select("doc_id", "_row", _shingles(F.col("_words")).alias("_shingles"))
    starts = F.sequence(F.lit(1), F.size("_shingles"), F.lit(part))
    parts = F.transform(starts, lambda i: F.slice(F.col("_shingles"), i, F.lit(part)))
    parted = hashed.select("doc_id", "_row", F.posexplode(parts).alias("_part", "_held"))
    windows = parted.select("doc_id", "_row", "_part", "_held", F.explode(_windows(F.col("_held"))).alias("_window"))
    banded = windows.select("doc_id", "_row", "_part", "_held", F.explode(_bands()).alias("_value"))
    found = banded.join(F.broadcast(index), F.col("_value") == F.col("_known"))
    retrieved = found.groupBy("doc_id", "_row", "_part", "_of").agg(F.first("_held").alias("_held"))
    both = retrieved.join(F.broadcast(wanted), F.col("_of") == F.col("_template"))
    shared = both.select("doc_id", "_row", "license", F.size("_wanted").cast("long").alias("shingles"), "_template", F.explode(F.array_intersect("_held", "_wanted")).alias("_shingle"))
    counted = shared.groupBy("doc_id", "_row", "_template", "license", "shingles").agg(F.count_distinct("_shingle").alias("shared"))
    return counted.where(F.col("shared") >= F.lit(contained) * F.col("shingles")).select("doc_id", "license", "shared", "shingles").distinct()


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP5_SQL = (
    r"""
WITH t(license, body) AS (VALUES """
    + ", ".join("('{}', '{}')".format(name, body.replace("'", "''")) for name, body in TEMPLATES)
    + r"""),
src AS (SELECT 'd' AS k, row_number() OVER () AS r, doc_id, NULL AS license, text FROM documents UNION ALL SELECT 't', row_number() OVER (), NULL, license, body FROM t),
w AS (SELECT k, r, doc_id, license, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM src),
s AS (SELECT DISTINCT k, r, doc_id, license, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT license, count(*) AS n FROM s WHERE k = 't' GROUP BY license)
SELECT DISTINCT doc_id, license, shared, n::BIGINT AS shingles FROM (
  SELECT d.r, d.doc_id, t.license, count(*)::BIGINT AS shared FROM s d JOIN s t ON d.k = 'd' AND t.k = 't' AND d.s = t.s GROUP BY ALL)
JOIN n USING (license) WHERE shared >= 0.75 * n
"""
)
