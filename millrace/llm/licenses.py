"""Licence scans by Dice coefficient over word bigrams.

Units of a text are its lines, its paragraphs (between blank lines) and the whole
text. Each is normalised (lower case, all but a-z and 0-9 as one space, so that comment
signs and line breaks do not count) and turned into its set of word bigrams. A
template's Dice coefficient with it, 2 * shared / (size + size), can only reach the
threshold if the sizes are close; those bounds prune units and templates before any
bigram is looked at. Shared bigrams are counted by joining the rest with an inverted
index of the templates, a fixed table. DataFrame functions only.

Templates are whole licences of up to a page, the notices that stand for longer ones,
paragraphs that come by themselves, and one-line notices.

Defined results: null and empty texts, and units of fewer than two words, match
nothing; a unit that repeats counts once; of templates with one coefficient all count,
the first by name is the best, of its units the one with the most shared bigrams; a very
long text is judged by its lines and paragraphs, as a whole no template is that long;
repeated rows, null doc_ids too, are each judged by their own text; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Least Dice coefficient of a match, in percent.
PERCENT = 80

# Wording of licences and of their usual notices.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_GNU_WARRANTY = """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
_UNLICENSE_OPENING = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
_ZLIB_OPENING = """This software is provided 'as-is', without any express or implied warranty.
In no event will the authors be held liable for any damages arising from the use of this software."""
_ZLIB_CONDITIONS = """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
TEMPLATES = {
    "0bsd": f"{_ISC_GRANT}. {_ISC_DISCLAIMER}",
    "agpl-3.0-notice": f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. {_GNU_WARRANTY} See the GNU Affero General Public License for more details.""",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "apache-2.0-warranty": """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "bsd-2-clause": f"{_BSD_OPENING} {_BSD_TWO} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"{_BSD_OPENING} {_BSD_TWO} {_BSD_THIRD} {_BSD_DISCLAIMER}",
    "bsd-conditions": f"{_BSD_OPENING} {_BSD_TWO}",
    "bsd-disclaimer": _BSD_DISCLAIMER,
    "bsd-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "bsl-1.0": f"""Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software")
to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part,
and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT.
IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0-notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "gpl-warranty": f"{_GNU_WARRANTY} See the GNU General Public License for more details.",
    "isc": f"{_ISC_GRANT}, {_ISC_NOTICE} {_ISC_DISCLAIMER}",
    "isc-grant": f"{_ISC_GRANT}, {_ISC_NOTICE}",
    "lgpl-2.1-notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
    "mit": f"{_MIT_GRANT}, subject to the following conditions: {_MIT_NOTICE} {_MIT_DISCLAIMER}",
    "mit-0": f"{_MIT_GRANT}. {_MIT_DISCLAIMER}",
    "mit-disclaimer": _MIT_DISCLAIMER,
    "mit-grant": f"{_MIT_GRANT}, subject to the following conditions:",
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": f"""{_UNLICENSE_OPENING}
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large
and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. {_MIT_DISCLAIMER}
For more information, please refer to <http://unlicense.org/>""",
    "unlicense-opening": _UNLICENSE_OPENING,
    "zlib": f"{_ZLIB_OPENING} {_ZLIB_CONDITIONS}",
    "zlib-opening": _ZLIB_OPENING,
}


def bigrams(text: str) -> list[str]:
    """The sorted distinct word bigrams of a text."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bounds(size: int, percent: int) -> tuple[int, int]:
    """Set sizes for which the coefficient with a set of this size can reach the threshold."""
    return -(-size * percent // (200 - percent)), size * (200 - percent) // percent


def _once(value: Column) -> Column:
    """The value, computed in one place: a filter on it is not moved below, where it would compute it again."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _templates(percent: int) -> list[tuple[str, str, int, int, int, int]]:
    out = []
    for name, text in TEMPLATES.items():
        own = bigrams(text)
        out += [(gram, name, len(own), *bounds(len(own), percent), i) for i, gram in enumerate(own)]
    return out


def scan(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_licenses, licenses (names, comma-joined, in order), best and its coefficient as shared, size and template size."""
    spark = docs.sparkSession
    index = spark.createDataFrame(_templates(percent), "gram string, license string, t_size int, low int, high int, number int")
    low, high = (f(r[i] for r in _templates(percent)) for f, i in ((min, 3), (max, 4)))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows with one id and one text have one result; the digest keeps texts of one id apart.
    docs = docs.withColumn("tag", F.unhex(F.md5("text")))
    parts = F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", r"\n[\x20\t\r]*\n"), F.array("text")))
    units = docs.where("text is not null").select("doc_id", "tag", F.posexplode(parts).alias("unit", "part"))
    # With fewer words than the smallest bound has bigrams, nothing can match.
    words = F.split(F.trim(F.regexp_replace(F.lower("part"), "[^a-z0-9]+", " ")), " ")
    units = units.select("doc_id", "tag", "unit", _once(words).alias("words")).where(F.size("words") > low)
    # A set of bigrams has at least as many as there are distinct words, less one: most whole texts stop here.
    units = units.where((F.size("words") - 1 <= high) | (F.size(F.array_distinct("words")) - 1 <= high))
    grams = F.array_distinct(F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1), lambda a, b: F.concat_ws(" ", a, b)))
    units = units.select("doc_id", "tag", "unit", _once(grams).alias("grams")).select("doc_id", "tag", "unit", F.size("grams").alias("size"), "grams").where(F.col("size").between(low, high))
    # The index has as many rows as the templates have bigrams: a fixed, small broadcast.
    held = units.select("doc_id", "tag", "unit", "size", F.explode("grams").alias("gram")).join(F.broadcast(index), "gram").where(F.col("size").between(F.col("low"), F.col("high")))
    shared = held.groupBy("doc_id", "tag", "unit", "size", "license", "t_size").agg(F.countDistinct("number").alias("shared"))
    found = shared.where(200 * F.col("shared") >= percent * (F.col("size") + F.col("t_size")))
    # Of a document's units, the one nearest to each licence.
    near = F.struct((F.col("shared") / (F.col("size") + F.col("t_size"))).alias("dice"), "shared", "size", "t_size")
    best = found.groupBy("doc_id", "tag", "license").agg(F.max(near).alias("near"))
    top = F.struct((-F.col("near.dice")).alias("d"), F.col("license").alias("name"), F.col("near.shared").alias("shared"), F.col("near.size").alias("size"), F.col("near.t_size").alias("t_size"))
    per_doc = best.groupBy(F.col("doc_id").alias("own_id"), F.col("tag").alias("own_tag")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("license")), ",").alias("licenses"), F.min(top).alias("top"))
    out = docs.select("doc_id", "tag").join(per_doc, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("tag") == F.col("own_tag")), "left")
    return out.select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_licenses"), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("top.name", F.lit("")).alias("best"),
        F.coalesce("top.shared", F.lit(0)).cast("long").alias("shared"), F.coalesce("top.size", F.lit(0)).cast("long").alias("size"), F.coalesce("top.t_size", F.lit(0)).cast("long").alias("template_size"),
    )


def _sql(percent: int = PERCENT) -> str:
    values = ", ".join("('" + "', '".join(r[:2]) + f"', {r[2]})" for r in _templates(percent))
    return f"""
with index(gram, license, t_size) as (values {values}),
docs as (select distinct doc_id, md5(text) as tag, text from documents where text is not null),
parts as (select doc_id, tag, list_distinct(list_concat(string_split(text, chr(10)), string_split_regex(text, '\\n[\\x20\\t\\r]*\\n'), [text])) as l from docs),
units as (select doc_id, tag, unnest(range(len(l))) as unit, unnest(l) as part from parts),
words as (select doc_id, tag, unit, string_split(trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g'), ' '), ' ') as w from units),
grams as (select doc_id, tag, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from words where len(w) > 1),
held as (select doc_id, tag, unit, len(g) as size, unnest(g) as gram from grams),
shared as (select doc_id, tag, unit, size, license, t_size, count(*) as shared from held join index using (gram) group by all),
found as (select *, shared::double / (size + t_size) as dice from shared where 200 * shared >= {percent} * (size + t_size)),
best as (select *, row_number() over (partition by doc_id, tag, license order by dice desc, shared desc) as r from found),
tops as (select *, row_number() over (partition by doc_id, tag order by dice desc, license) as t from best where r = 1),
per_doc as (select doc_id, tag, count(*) as n, string_agg(license, ',' order by license) as licenses, max(case when t = 1 then license end) as best,
  max(case when t = 1 then shared end) as shared, max(case when t = 1 then size end) as size, max(case when t = 1 then t_size end) as t_size from tops group by doc_id, tag)
select d.doc_id, coalesce(p.n, 0)::bigint as n_licenses, coalesce(p.licenses, '') as licenses, coalesce(p.best, '') as best, coalesce(p.shared, 0)::bigint as shared,
  coalesce(p.size, 0)::bigint as size, coalesce(p.t_size, 0)::bigint as template_size
from documents d left join per_doc p on d.doc_id is not distinct from p.doc_id and md5(d.text) = p.tag"""


SQL = _sql()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1 over the whole documents table."""
    return scan(common.table(spark, sf_dir, "documents"))
