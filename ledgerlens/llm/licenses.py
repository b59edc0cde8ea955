"""Licence scan: text units against licence templates by Dice over word bigrams.

Main path: DataFrame expressions only, one narrow projection, no shuffle.

A document's units are all runs of consecutive lines, from one line to the whole
text, so a licence wrapped over any number of lines is found inside a longer
document.  Normalising lower-cases A-Z and turns every run of other signs than
letters and digits into one blank; lines without words do not count.
With bags of word bigrams A (unit) and B (template) the score is
2 * |A and B| / (|A| + |B|).  A score of ``threshold`` needs
threshold / (2 - threshold) <= |A| / |B| <= (2 - threshold) / threshold, and |A| is
the unit's number of words less one.  A template that shares too few distinct
bigrams with the whole text for that is dropped first; for the others, runs are
listed from each line as far as the upper size bound, and those stay whose size and
number of bigrams that the template has (both differences of running counts) allow
the score.  No unit is capped: the bounds lose none.

Defined cases: null, empty and one-word texts have no bigrams and no licence;
of the matches the one that shares
most bigrams is the document's licence (a full text before its parts), then the
higher score, then the template's name; equal units count once; repeated
rows give repeated rows; an empty table an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Licence notices and texts, from the licences themselves.
BSD_CONDITIONS = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                  "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                  "in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                  "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                  "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
                  "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
                  "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                  "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                  "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
                  "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. ")
MIT_TEXT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. ")
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                         "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                         "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                         "specific language governing permissions and limitations under the License.",
    "bsd-2-clause": BSD_CONDITIONS.strip(),
    "bsd-2-clause-full": BSD_CONDITIONS + BSD_DISCLAIMER,
    "bsd-3-clause-full": BSD_CONDITIONS + "3. Neither the name of the copyright holder nor the names of its contributors may "
                         "be used to endorse or promote products derived from this software without specific prior written "
                         "permission. " + BSD_DISCLAIMER,
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "isc": ISC_GRANT.strip(),
    "isc-full": ISC_GRANT + "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
                "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
                "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
                "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
                "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "mit": "Released under the MIT License.",
    "mit-full": MIT_TEXT + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
                "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
                "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-text": MIT_TEXT.strip(),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
               "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "reserved": "All rights reserved.",
}
THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> Counter:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def _templates(templates: dict[str, str], threshold: float) -> str:
    """The templates as one literal array; its size is that of ``templates``."""
    # a hair wider, so that rounding prunes nothing on the bound
    lo, hi = threshold / (2 - threshold) * (1 - 1e-9), (2 - threshold) / threshold * (1 + 1e-9)
    rows = []
    for name, text in sorted(templates.items()):
        bag = sorted(template_bigrams(text).items())
        k = sum(c for _, c in bag)
        rows.append({"name": name, "k": k, "low": lo * k, "high": hi * k, "most": max(c for _, c in bag),
                     "grams": [g for g, _ in bag], "counts": [c for _, c in bag]})
    return _literal(rows, "array<struct<name: string, k: int, low: double, high: double, most: int, "
                          "grams: array<string>, counts: array<int>>>")


def _literal(value, kind: str) -> str:
    """A constant as one JSON string, folded once; as nested constructors the planner would visit every element.
    Names and bigrams are letters, digits and signs without quotes."""
    return f"from_json('{json.dumps(value)}', '{kind}')"


def _extend(column: str, keep: str, **more: str) -> str:
    """Every struct ``t`` of an array with fewer and further fields."""
    fields = [f"'{k}', t.{k}" for k in keep.split()] + [f"'{k}', {v}" for k, v in more.items()]
    return f"transform({column}, t -> named_struct({', '.join(fields)})) as {column}"


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(id, license, score, n_units): the template with most shared bigrams among the matches (null: none), its
    score, number of matching distinct units."""
    known = _templates(templates or TEMPLATES, threshold)
    every = _literal(sorted(set().union(*map(template_bigrams, (templates or TEMPLATES).values()))), "array<string>")
    least = f"{threshold * (1 - 1e-9)!r}D"
    flat = F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER),
                            r"[^\p{L}\p{N}\n]+", " ")
    # one sign sequence: words, and a line feed of its own between lines that have words
    signs = F.split(F.trim(F.regexp_replace(flat, r" *\n[ \n]*", " \n ")), " ")
    return (
        df.select(F.col(id_col).alias("id"), signs.alias("signs"))
        .selectExpr("id", "filter(signs, s -> s <> '\\n' and s <> '') as words",
                    "filter(transform(signs, (s, i) -> if(s = '\\n', i, -1)), i -> i >= 0) as feeds")
        # words before each line's end: a feed's place less the feeds before it
        .selectExpr("id", "words",
                    "array_distinct(concat(array(0), transform(feeds, (x, i) -> x - i), array(size(words)))) as cuts",
                    "zip_with(slice(words, 1, greatest(size(words) - 1, 0)), slice(words, 2, size(words)), "
                    "(a, b) -> concat(a, ' ', b)) as grams")
        # known bigrams of the text once, as a lambda's argument (a column used once would be worked out per template)
        .selectExpr("id", "words", "cuts", "grams",
                    f"get(transform(array(array_intersect(grams, {every})), near -> filter({known}, "
                    "t -> t.most * size(array_intersect(t.grams, near)) >= t.low)), 0) as found")
        # the text's bigrams that the template has, by bigram and place
        .selectExpr("id", "words", "cuts", "grams", _extend(
            "found", "name k low high counts",
            hits="array_sort(filter(transform(grams, (g, p) -> named_struct('g', array_position(t.grams, g), 'p', p)), "
                 "h -> h.g > 0))"))
        # of a bigram that the template has c times, a hit counts in a run that starts after the cth hit before it
        .selectExpr("id", "words", "cuts", _extend(
            "found", "name k low high",
            hits="array_sort(transform(t.hits, (h, i) -> named_struct('p', h.p, 'after', "
                 "if(get(t.hits, i - cast(get(t.counts, cast(h.g - 1 as int)) as int)).g = h.g, "
                 "get(t.hits, i - cast(get(t.counts, cast(h.g - 1 as int)) as int)).p, -1))))"))
        # hits before each cut: its place among hits and cuts less that among cuts
        .selectExpr("id", "words", _extend(
            "found", "name k low high hits",
            cuts="filter(transform(array_sort(concat("
                 "transform(cuts, (x, i) -> named_struct('x', x, 'hit', 0, 'i', i)), "
                 "transform(t.hits, (h, i) -> named_struct('x', h.p, 'hit', 1, 'i', i)))), "
                 "(e, j) -> named_struct('x', e.x, 'hit', e.hit, 'h', j - e.i)), e -> e.hit = 0)"))
        # runs of lines that the size bounds and their hits allow
        .selectExpr("id", "words", _extend(
            "found", "name k hits",
            runs="flatten(transform(t.cuts, (s, i) -> filter(transform(slice(t.cuts, i + 2, cast(t.high as int) + 2), "
                 "e -> named_struct('a', s.x, 'b', e.x, 'h', s.h, 'n', e.h - s.h)), "
                 "r -> r.b - r.a - 1 >= t.low and r.b - r.a - 1 <= t.high "
                 f"and 2 * r.n >= {least} * (r.b - r.a - 1 + t.k))))"))
        .selectExpr("id", "words", "flatten(transform(found, t -> transform(t.runs, r -> named_struct("
                    "'shared', size(filter(slice(t.hits, r.h + 1, r.n), h -> h.p < r.b - 1 and h.after < r.a)), "
                    "'size', r.b - r.a - 1 + t.k, 'name', t.name, 'a', r.a, 'n', r.b - r.a)))) as found")
        .selectExpr("id", "words", f"filter(found, f -> 2D * f.shared / f.size >= {threshold!r}D) as found")
        .selectExpr("id", "found",
                    "array_max(transform(found, f -> named_struct('shared', f.shared, 'score', 2D * f.shared / f.size))) as best",
                    "cast(size(array_distinct(transform(found, f -> array_join(slice(words, f.a + 1, f.n), ' ')))) as long) "
                    "as n_units")
        .select(F.col("id").alias(id_col),
                F.expr("array_min(transform(filter(found, f -> f.shared = best.shared and 2D * f.shared / f.size = best.score), "
                       "f -> f.name))").alias("license"),
                F.col("best.score").alias("score"), "n_units"))
