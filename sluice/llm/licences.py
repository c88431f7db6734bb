"""Licence scan: Dice coefficient of word bigrams against licence templates.

A unit of a text is a run of consecutive lines (a line, a paragraph, a notice of
several paragraphs, the whole). It is normalised (lower case; everything but
letters and digits is one space) and compared with the templates whose number
of distinct bigrams lets the coefficient reach the threshold at all: with ``t``
the threshold and ``b`` the template's size only sizes from ``b t / (2 - t)`` to
``b (2 - t) / t`` can. Texts without any of a few probe words are left out
before: no unit that reaches the threshold can lack them all. For the rest the
best run of each template is found (``best_run``); nothing is shuffled but the
matches.

Defined cases: a null or empty text has no match; texts are scanned whole, also
where they have one line only; rows with one doc_id are one document; of equal
runs the one with the fewest lines counts, then the first; a text may match
several templates (the first line of a header can be a notice too); an empty
table gives no rows; names of further columns don't matter.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
COMMON = set("a all and any be by for from in is it of on or out the this to under which with you".split())

# Public licence notices and texts.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE "
        "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."),
    "BSL-1.0 notice": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"),
    "GPL-2.0 header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA "
        "02110-1301 USA."),
    "LGPL-2.1 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public "
        "License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth "
        "Floor, Boston, MA 02110-1301 USA"),
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
        "General Public License for more details. You should have received a copy of the GNU Affero General Public License "
        "along with this program. If not, see <https://www.gnu.org/licenses/>."),
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Unlicense notice": "This is free and unencumbered software released into the public domain.",
}


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def probes(sized: list[tuple[str, list[str], int]], low: float) -> list[str]:
    """Words of which every unit that reaches the threshold holds one: such a
    unit shares at least ``low`` of a template's bigrams, so words that occur
    in more than the rest of them can't all be missing. Rare (long) words first."""
    out: list[str] = []
    for _, grams, n in sized:
        missing = [set(g.split()) for g in grams]
        for word in sorted({w for g in missing for w in g}, key=lambda w: (w in COMMON, w not in out, -len(w), w)):
            if n - len(missing) > n * (1 - low):
                break
            held = [g for g in missing if word not in g]
            if len(held) < len(missing) and word not in out:
                out.append(word)
            missing = held
    return out


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def best_run(grams: list[tuple[str, str]], first: list[int], last: list[int], template: set[tuple[str, str]],
             threshold: float) -> tuple[float, int, int] | None:
    """Score, first and last line of the run of lines that is most like the
    template, if any reaches the threshold. ``first`` and ``last`` are the lines
    of the two words of each bigram of the text.

    Only runs that could be the shortest best are looked at. Without its first
    (last) line such a run has fewer of the template's bigrams, so one of them
    starts in the first line and in no later one, and one ends in the last line
    and in none before. A run from a line ends where the line's own bigrams have
    all come again or the size bound is passed, so that a place in the text is
    in no more runs than the template has bigrams.
    """
    n = len(template)
    high = n * (2 - threshold) / threshold
    starts: dict[int, int] = {}         # line -> its first bigram
    at_line = -1
    for k, g in enumerate(grams):
        if first[k] != at_line:
            at_line, begin = first[k], k
        if g in template:
            starts.setdefault(at_line, begin)
    best = None
    for line, begin in starts.items():
        seen: set = set()
        own: set = set()
        shared = new = 0
        end = line
        for k in range(begin, len(grams) + 1):
            if k == len(grams) or last[k] != end:
                if new and 2.0 * shared / (len(seen) + n) >= threshold:
                    found = (-2.0 * shared / (len(seen) + n), end - line, line)
                    best = found if best is None or found < best else best
                if k == len(grams):
                    break
                end, new = last[k], 0
            g = grams[k]
            if g in template:
                if first[k] == line:
                    own.add(g)
                elif g in own:
                    own.discard(g)
                if g not in seen:
                    shared, new = shared + 1, new + 1
            if first[k] != line and not own:
                break
            seen.add(g)
            if len(seen) > high:
                break
    return None if best is None else (-best[0], best[2], best[2] + best[1])


def licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
             templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id, licence, score, first_line, last_line``: the licences found in a
    document, each with its best run of lines (counted from 0)."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    low = threshold / (2 - threshold)
    sized = [(name, b, len(b)) for name, b in ((n, template_bigrams(t)) for n, t in templates.items()) if b]
    probe = r"(?<![\p{L}\p{N}])(?:" + "|".join(probes(sized, low)) + r")(?![\p{L}\p{N}])"
    sets = [(name, {tuple(g.split()) for g in b}, n * low) for name, b, n in sized]
    key = docs.schema[doc_id].dataType

    def scan(batches):
        for batch in batches:
            rows = []
            for row, lines in enumerate(batch.column("lines")):     # a text at a time
                words = [line.split() for line in lines.as_py()]
                at = [i for i, w in enumerate(words) for _ in w]
                flat = [x for w in words for x in w]
                grams = list(zip(flat, flat[1:]))
                distinct = set(grams)
                for name, template, least in sets:
                    if len(template & distinct) >= least:
                        run = best_run(grams, at, at[1:], template, threshold)
                        if run:
                            rows.append((row, name, *run))
            index, *columns = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(index, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.int32(), pa.int32())))],
                ["doc_id", "licence", "score", "first_line", "last_line"])

    # Texts without any probe can't match; the rest is little.
    found = (docs.filter(F.lower(whole).rlike(probe))
             .select(F.col(f"`{doc_id}`").alias("doc_id"), F.transform(F.split(whole, "\n"), normalised).alias("lines"))
             .mapInArrow(scan, f"doc_id {key.simpleString()}, licence string, score double, first_line int, last_line int"))
    least = F.min(F.struct(-F.col("score"), F.expr("last_line - first_line"), "first_line", "last_line", "score")).alias("best")
    return found.groupBy("doc_id", "licence").agg(least).select("doc_id", "licence", "best.score", "best.first_line", "best.last_line")


def op6_licence_dice(spark, sf_dir: str) -> DataFrame:
    return licences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql() -> str:
    rows = ", ".join("('{}', ['{}'])".format(n.replace("'", "''"), "', '".join(template_bigrams(t)))
                     for n, t in TEMPLATES.items())
    return f"""
WITH templates AS (SELECT licence, len(b) AS n, unnest(b) AS g FROM (VALUES {rows}) AS t(licence, b)),
lines AS (
  SELECT r, doc_id, unnest(range(len(l))) AS line, unnest(l) AS unit
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
words AS (
  SELECT r, doc_id, line, unnest(range(len(w))) AS place, unnest(w) AS word
  FROM (SELECT r, doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM lines)),
grams AS (
  SELECT r, doc_id, line AS a, lead(line) OVER o AS z, word || ' ' || lead(word) OVER o AS g
  FROM words WHERE word <> '' WINDOW o AS (PARTITION BY r ORDER BY line, place)),
hits AS (SELECT DISTINCT r, doc_id, licence, n, a, z, g FROM grams JOIN templates USING (g)),
able AS (
  SELECT r, licence FROM hits GROUP BY r, licence, n HAVING count(DISTINCT g) >= n * {THRESHOLD / (2 - THRESHOLD)!r}),
runs AS (
  SELECT DISTINCT s.r, s.doc_id, s.licence, s.n, s.a AS first_line, e.z AS last_line
  FROM hits s JOIN able USING (r, licence) JOIN hits e ON s.r = e.r AND s.licence = e.licence AND s.a <= e.z),
shared AS (
  SELECT u.r, u.doc_id, u.licence, u.n, first_line, last_line, count(DISTINCT g) AS shared
  FROM runs u JOIN hits h ON u.r = h.r AND u.licence = h.licence AND h.a >= first_line AND h.z <= last_line GROUP BY ALL),
scored AS (
  SELECT u.doc_id, u.licence, first_line, last_line, 2.0 * CAST(shared AS DOUBLE) / (count(DISTINCT g) + u.n) AS score
  FROM shared u JOIN grams w ON u.r = w.r AND w.a >= first_line AND w.z <= last_line
  WHERE shared >= u.n * {THRESHOLD / (2 - THRESHOLD)!r}
  GROUP BY u.r, u.doc_id, u.licence, u.n, first_line, last_line, shared)
SELECT doc_id, licence, score, CAST(first_line AS INTEGER) AS first_line, CAST(last_line AS INTEGER) AS last_line
FROM scored WHERE score >= {THRESHOLD!r}
QUALIFY row_number() OVER (PARTITION BY doc_id, licence ORDER BY score DESC, last_line - first_line, first_line) = 1
"""


OP6_SQL = _sql()
