"""Licence scans: Dice coefficient over word bigrams against licence templates.

A text is scanned as a whole and line by line. A unit is normalised (lower case, all but
letters and digits to single spaces) and becomes the set of its word bigrams. With sizes a
and b the coefficient is 2 * common / (a + b); it can reach the threshold t only if
t / (2 - t) <= a / b <= (2 - t) / t. These bounds prune the templates of a unit before
anything is compared; units outside of all bounds are dropped before they are cut.

Built-in functions only. The bigrams of the templates are a fixed table (given by the
templates, about a thousand rows) and are broadcast; a unit meets only templates that share a
bigram with it. Common bigrams are summed before the shuffle. Nothing else is shuffled, and no
key can be hot: groups are (row, unit, template).

``scan_blocks`` finds licences of several lines inside longer texts: windows of the length of
each template, across lines. Its words are stored once, and only texts that have enough of a
template's bigrams are cut to windows.

Edge cases: null and empty texts and units of fewer than two words match nothing; a null id
is kept; repeated rows are reported each; equal scores are all reported (the best of a
document is the higher score, then the smaller licence id); extra columns are ignored; an
empty table gives an empty result; texts are taken whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import read
from changeflow.session import stored

THRESHOLD = 0.8
# Wordings of licences and licence notices, as their publishers give them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder "
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
        "notices in the Software and this entire statement, including the above license grant, this restriction and "
        "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all "
        "derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS "
        "IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
        "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser "
        "General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense-header": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For "
        "more information, please refer to <https://unlicense.org>"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution."
    ),
}


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, int, str]]:
    """(licence, number of its bigrams, bigram); a template of one word has none."""
    rows = []
    for name, text in templates.items():
        words = re.sub(r"[\W_]+", " ", text.lower()).split()
        found = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
        rows += [(name, len(found), bigram) for bigram in found]
    return rows


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, license_id, dice) of every unit that reaches the threshold.

    ``line`` is the number of the line from 1, or 0 for a text of several lines as a whole.
    """
    table = template_bigrams(TEMPLATES if templates is None else templates)
    known = docs.sparkSession.createDataFrame(table, "license_id string, m int, bigram string")
    sizes = [m for _, m, _ in table] or [0]
    ratio = threshold / (2 - threshold)
    # A unit of n words has at most n - 1 bigrams; repeated words make it fewer.
    low, high = ratio * min(sizes), max(sizes) / ratio
    lines = F.split(F.col("text"), "\n")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.transform(lines, lambda x, i: F.struct((i + 1).alias("line"), x.alias("unit")))
    whole = F.when(F.col("text").contains("\n"), F.array(F.struct(F.lit(0).alias("line"), F.col("text").alias("unit"))))
    # The row numbers keep the optimiser from copying a step into the filters of the next.
    units = (
        rows.select("id", F.explode(F.concat(lines, F.coalesce(whole, F.array().cast("array<struct<line:int,unit:string>>")))).alias("u"))
        .select(F.monotonically_increasing_id().alias("uid"), "id", "u.line", F.split(normalised(F.col("u.unit")), " ").alias("words"))
        .where(F.size("words") - 1 >= low)
    )
    bigrams = F.array_distinct(
        F.transform(F.slice("words", F.lit(2), F.size("words")), lambda w, i: F.concat(F.get("words", i), F.lit(" "), w))
    )
    sets = units.select(F.monotonically_increasing_id().alias("unit"), "uid", "id", "line", bigrams.alias("bigrams")).withColumn("n", F.size("bigrams"))
    sets = sets.where(F.col("n").between(low, high))
    pairs = sets.select("unit", "uid", "id", "line", "n", F.explode("bigrams").alias("bigram")).join(
        F.broadcast(known), "bigram"
    ).where((F.col("n") >= ratio * F.col("m")) & (F.col("m") >= ratio * F.col("n")))
    return (
        pairs.groupBy("unit", "uid", "id", "line", "license_id", "n", "m")
        .agg(F.count("*").alias("common"))
        .select("id", "line", "license_id", (2 * F.col("common") / (F.col("n") + F.col("m"))).alias("dice"))
        .where(F.col("dice") >= threshold)
    )


def scan_blocks(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, license_id, dice) of the windows of each template's length, across lines, that reach the threshold.

    Windows begin at every word; ``line`` is that of the first word, from 1. Of overlapping windows the
    one with the highest score is reported, the first of equal ones. A text that has not the bigrams that
    the threshold asks for is dropped before it is cut. Of the others the windows at a grid (each tenth of the
    template's words) are counted first. A window d words away has at most d bigrams of the template more, so
    only around those that come near enough all windows are scored, and none is missed.
    """
    templates = TEMPLATES if templates is None else templates
    table = template_bigrams(templates)
    spark = docs.sparkSession
    known = spark.createDataFrame(table, "license_id string, m int, bigram string")
    lengths = {name: len(re.sub(r"[\W_]+", " ", text.lower()).split()) for name, text in templates.items()}
    lengths = spark.createDataFrame(list(lengths.items()), "license_id string, size int")
    ratio = threshold / (2 - threshold)
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    tagged = F.transform(lines, lambda x, i: F.transform(F.filter(F.split(normalised(x), " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), (i + 1).alias("line"))))
    # Read twice, so the numbers of the rows are kept.
    rows = stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.flatten(tagged).alias("words")), "licence-words")

    def pairs(words: Column) -> Column:
        return F.array_distinct(F.transform(F.slice(words, F.lit(2), F.size(words)), lambda w, i: F.concat(F.get(words, i)["w"], F.lit(" "), w["w"])))

    # No window has more of a template than the text; at least ratio * m are needed.
    near = rows.select("uid", F.explode(pairs(F.col("words"))).alias("bigram")).join(F.broadcast(known), "bigram")
    near = near.groupBy("uid", "license_id", "m").agg(F.count("*").alias("common")).where(F.col("common") >= ratio * F.col("m"))
    near = stored(near.select("uid", "license_id", "m").join(F.broadcast(lengths), "license_id"), "near-licences")
    own = known.groupBy("license_id").agg(F.collect_list("bigram").alias("template"))
    near = near.join(F.broadcast(own), "license_id").withColumn("step", F.greatest(F.floor(F.col("size") / 10), F.lit(1)))
    near = near.withColumn("half", F.floor(F.col("step") / 2))
    n = F.size("words").cast("long")
    fixed = ["uid", "id", "words", "license_id", "m", "size", "template"]

    def windows(at: DataFrame) -> DataFrame:
        parts = at.withColumn("part", F.slice("words", (F.col("at") + 1).cast("int"), F.col("size")))
        parts = parts.withColumn("line", F.get(F.col("part"), F.lit(0))["line"]).withColumn("bigrams", pairs(F.col("part"))).drop("part")
        return parts.withColumn("common", F.size(F.array_intersect("bigrams", "template")))

    grid = rows.join(near, "uid").select(*fixed, "step", "half", F.explode(F.sequence(F.lit(0).cast("long"), n - 1 + F.col("half"), F.col("step"))).alias("at"))
    grid = windows(grid).where(F.col("common") >= ratio * F.col("m") - F.col("half"))
    offsets = F.sequence(F.greatest(F.col("at") - F.col("half"), F.lit(0).cast("long")), F.least(F.col("at") - F.col("half") + F.col("step"), n) - 1)
    # The last window of the grid may begin behind the text, with nothing before it that is not of another one.
    close = grid.where(F.col("at") - F.col("half") < n).select(*fixed, F.explode(offsets).alias("at"))
    scored = windows(close).withColumn("dice", 2 * F.col("common") / (F.size("bigrams") + F.col("m")))
    scored = scored.where(F.col("dice") >= threshold).drop("words", "bigrams", "template")
    # Less than a length apart, in thousandths of lengths.
    around = Window.partitionBy("uid", "license_id").orderBy(F.floor(1000 * F.col("at") / F.col("size"))).rangeBetween(-999, 999)
    top = F.max(F.struct("dice", (-F.col("at")).alias("at"))).over(around)
    return scored.withColumn("top", top).where(F.col("top.at") == -F.col("at")).select("id", "line", "license_id", "dice")


def best(found: DataFrame) -> DataFrame:
    """(id, license_id, dice): the best match of each id in the result of ``scan``."""
    top = F.min(F.struct(-F.col("dice"), "license_id")).alias("top")
    return found.groupBy("id").agg(top).select("id", "top.license_id", (-F.col("top.col1")).alias("dice"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "line", "license_id", F.round("dice", 9).alias("dice"))


def op6_license_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_blocks(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "line", "license_id", F.round("dice", 9).alias("dice"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP6_SQL = r"""
WITH templates(license_id, body) AS (VALUES %s),
units AS (
  SELECT doc_id, i AS line, p[i] AS unit
  FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents))
  UNION ALL
  SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))),
words AS (
  SELECT 'd' AS kind, doc_id, line, NULL AS license_id, string_split(trim(regexp_replace(lower(unit), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM units
  UNION ALL
  SELECT 't', NULL, NULL, license_id, string_split(trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') FROM templates),
sets AS (
  SELECT * REPLACE (list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS w) FROM words),
d AS (SELECT doc_id, line, len(w) AS n, unnest(w) AS b FROM sets WHERE kind = 'd'),
t AS (SELECT license_id, len(w) AS m, unnest(w) AS b FROM sets WHERE kind = 't')
SELECT doc_id, CAST(line AS INTEGER) AS line, license_id, round(2 * count(*) / (n + m), 9) AS dice
FROM d JOIN t USING (b) GROUP BY doc_id, line, license_id, n, m HAVING 2 * count(*) / (n + m) >= 0.8
""" % ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in TEMPLATES.items())  # fmt: skip
