"""Licence scan: Dice coefficient over word bigrams.

A text is normalised to lower-case words, so comment signs and line breaks do
not count, and compared with notices and whole licence texts as multisets of
word bigrams.  A window of a template's length shares at least ``t`` per cent
of a template's ``b`` bigrams if its Dice coefficient reaches ``t``, so at least
one of the ``b - ceil(t b / 100) + 1`` rarest stands in it: the templates' anchors,
rarest by the number of licences that hold them.  Where an anchor stands in a
text, it puts the template's beginning; the window from there is compared.  A
window cut short by an end of the text has ``a`` bigrams and can only reach
``t`` if ``t (a + b) <= 200 min(a, b)``, which is asked before any count.

Everything is DataFrame operations; the templates are a fixed small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, measured_side, prepare, stored, table

THRESHOLD = 80  # per cent

# Notices by which public licences are applied or named, and
# whole texts of the short ones (without their copyright lines).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
            "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
            "IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
            "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
             "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
             "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
             "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
             "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
                     "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
                     "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
                     "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                     "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
                     "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
                     "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
                     "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
                     "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
                     "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
                     "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
                     "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
                     "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
                     "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
                     "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
             "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
             "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
             "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
             "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
             "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
             "distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
                  "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
                  "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
                  "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
                  "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
                  "present and future rights to this software under copyright law."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
                "to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
                "and this entire statement, including the above license grant, this restriction and the following disclaimer, "
                "must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
                "unless such copies or derivative works are solely in the form of machine-executable object code generated by a "
                "source language processor."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                   "See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
                "General Public License for more details. You should have received a copy of the GNU General Public License "
                "along with this program. If not, see <https://www.gnu.org/licenses/>."),
]
_WORD = r"[0-9a-z]+(?:\.[0-9]+)*"


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _bigrams(words: str) -> str:
    """Hashes of the bigrams of two words or more, which are made once."""
    return f"transform(array({words}), x -> transform(sequence(0, size(x) - 2), i -> xxhash64(x[i], x[i + 1])))[0]"


def _text_key() -> tuple[Column, Column]:
    """Two hashes of a text; the second starts from another seed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def templates(spark: SparkSession, rows=TEMPLATES, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(templates: template, licence, b, tg: distinct bigrams with their counts,
    gs: the bigrams alone, most: the greatest count; anchors: g, template, off),
    of the fixed table."""
    t = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(rows)], "template int, licence string, text string")
    t = t.select("template", "licence", normal_words(F.col("text")).alias("w"))
    grams = t.select("template", "licence", (F.size("w") - 1).alias("b"), F.posexplode(F.expr(_bigrams("w"))).alias("off", "g"))
    counts = grams.groupBy("template", "licence", "b", "g").agg(F.count("*").alias("tb"))
    whole = counts.groupBy("template", "licence", "b").agg(
        F.collect_list(F.struct("g", "tb")).alias("tg"), F.collect_list("g").alias("gs"), F.max("tb").alias("most"))
    held = grams.groupBy("g").agg(F.count_distinct("licence").alias("licences"), F.count("*").alias("times"))
    order = Window.partitionBy("template").orderBy("licences", "times", "off")
    anchors = (grams.join(F.broadcast(held), "g").withColumn("rank", F.row_number().over(order))
               .filter(F.col("rank") <= F.col("b") - F.ceil(F.col("b") * threshold / 100) + 1).select("g", "template", "off"))
    return whole, anchors


def matches(docs: DataFrame, threshold: int = THRESHOLD, rows=TEMPLATES) -> DataFrame:
    """Per distinct text and licence the best window at or over the threshold:
    (k1, k2, licence, template, start, dice); start is the window's first word.
    Ties go to the first template, then to the first window."""
    whole, anchors = templates(docs.sparkSession, rows, threshold)
    whole, anchors = F.broadcast(whole), F.broadcast(anchors)  # a fixed table of templates
    k1, k2 = _text_key()
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(k1.alias("k1"), k2.alias("k2"), text.alias("t"))
    begun = (texts.select("k1", "k2", normal_words(F.col("t")).alias("w")).filter(F.size("w") > 1)
             .select("k1", "k2", F.posexplode(F.expr(_bigrams("w"))).alias("pos", "g")).join(anchors, "g")
             .groupBy("k1", "k2", "template").agg(F.collect_set(F.col("pos") - F.col("off")).alias("starts")))
    begun = stored(begun, "begun")
    keys = stored(begun.select("k1", "k2").distinct(), "keys")
    held = (texts.join(measured_side(keys), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
            .select("k1", "k2", normal_words(F.col("t")).alias("w")))
    # All windows of a text and template in one row, so the text is not copied
    # for each.  A window without enough different bigrams of the template is not
    # counted through.
    shared = f"""if(200 * most * size(array_intersect(gs, zg)) < {threshold} * (size(zg) + b), 0L,
        aggregate(tg, 0L, (n, y) -> n + least(y.tb, size(filter(zg, g -> g = y.g)))))"""
    windows = f"""filter(transform(starts, s -> transform(array(slice(w, greatest(s, 0) + 1, b + 1 + least(s, 0))), z ->
        named_struct('start', s, 'a', size(z) - 1, 'o',
            if(size(z) < 2 or {threshold} * (size(z) - 1 + b) > 200 * least(size(z) - 1, b), 0L,
               transform(array({_bigrams('z')}), zg -> {shared})[0])))[0]),
        h -> h.a > 0 and 200 * h.o >= {threshold} * (h.a + b))"""
    scored = (held.join(begun, ["k1", "k2"]).join(whole, "template")
              .select("k1", "k2", "template", "licence", "b", F.explode(F.expr(windows)).alias("h")).select("*", "h.*")
              .withColumn("dice", F.lit(2.0) * F.col("o") / (F.col("a") + F.col("b"))))
    best = F.max(F.struct("dice", (-F.col("template")).alias("t"), (-F.col("start")).alias("s"))).alias("m")
    found = stored(scored.groupBy("k1", "k2", "licence").agg(best).select(
        "k1", "k2", "licence", (-F.col("m.t")).alias("template"), (-F.col("m.s")).alias("start"), "m.dice"), "licences")
    discard(begun, keys)
    return found


def scan(docs: DataFrame, threshold: int = THRESHOLD, rows=TEMPLATES) -> DataFrame:
    """Rows (doc_id, licence, template, start, dice) for each licence found in
    each row of ``docs`` (doc_id, text): its best window.  start may be before
    the text's first word by as much as a template's beginning is missing.
    Null, empty and other clean texts give no row; copies and repeated rows each
    give theirs."""
    k1, k2 = _text_key()
    return (docs.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(measured_side(matches(docs, threshold, rows)), ["k1", "k2"])
            .select("doc_id", "licence", "template", F.col("start").cast("long").alias("start"), F.round("dice", 6).alias("dice")))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


_VALUES = ", ".join("({}, '{}', '{}')".format(k, a, b.replace("'", "''")) for k, (a, b) in enumerate(TEMPLATES))
ORACLE = rf"""
WITH tpl(template, licence, txt) AS (VALUES {_VALUES}),
tw AS (SELECT template, licence, regexp_extract_all(lower(txt), '{_WORD}') AS w FROM tpl),
tp AS (
  SELECT template, licence, len(w) - 1 AS b, unnest(range(0, len(w) - 1)) AS off,
         unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw
), tg AS (SELECT template, g, count(*) AS tb FROM tp GROUP BY ALL),
held AS (SELECT g, count(DISTINCT licence) AS licences, count(*) AS times FROM tp GROUP BY g),
anchors AS (
  SELECT template, g, off, b FROM tp JOIN held USING (g)
  QUALIFY row_number() OVER (PARTITION BY template ORDER BY licences, times, off) <= b - CAST(ceil(b * {THRESHOLD} / 100.0) AS BIGINT) + 1
), d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS w FROM documents),
dp AS (
  SELECT doc_id, unnest(range(0, len(w) - 1)) AS pos,
         unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM d WHERE len(w) > 1
), begun AS (SELECT DISTINCT doc_id, template, b, pos - off AS start FROM dp JOIN anchors USING (g)),
windows AS (
  SELECT s.doc_id, template, start, b, d.w[greatest(start, 0) + 1:start + b + 1] AS z FROM begun s JOIN d ON d.doc_id = s.doc_id
), wg AS (
  SELECT doc_id, template, start, b, len(z) - 1 AS a,
         unnest(list_transform(range(1, len(z)), lambda i: z[i] || ' ' || z[i + 1])) AS g FROM windows WHERE len(z) > 1
), wc AS (SELECT doc_id, template, start, a, b, g, count(*) AS c FROM wg GROUP BY ALL),
scored AS (
  SELECT doc_id, template, start, a, b, CAST(sum(least(c, tb)) AS BIGINT) AS o FROM wc JOIN tg USING (template, g) GROUP BY ALL
)
SELECT s.doc_id, licence, template, start, round(2.0::DOUBLE * o / (a + b), 6) AS dice
FROM scored s JOIN tw USING (template) WHERE 200 * o >= {THRESHOLD} * (a + b)
QUALIFY row_number() OVER (PARTITION BY s.doc_id, licence ORDER BY 2.0::DOUBLE * o / (a + b) DESC, template, start) = 1
"""
