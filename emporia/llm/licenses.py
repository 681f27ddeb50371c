"""Licence scan (DataFrame functions only).

A document's lines and its paragraphs of several lines are normalised (lower
case; everything but letters and digits separates words) and compared with
licence templates by the Dice coefficient of their sets of word bigrams,
2 |A and T| / (|A| + |T|).  As the intersection is no larger than the smaller
set, a coefficient of at least t needs |A| between t / (2 - t) and (2 - t) / t
times |T|: other templates are pruned by size alone, and a unit with too many
distinct words for any template is dropped before its bigrams are built.

A notice that shares its line with other words, or is wrapped or spread over
other units, is found as a passage, across lines and paragraphs: all runs of
words that begin and end with a bigram of the template (others only lower the
coefficient) and have, repeats included, as many bigrams as the size bound allows are
compared, shorter ones too, since a notice may leave words out.  Of runs that
share words the best counts, best first, among those of a template and then of all.  Units that match the same licence are left
out, as are runs that a better match of the unit around them explains.  By the
same bound a run shares at least t / (2 - t) of the template's bigrams.  So a
document or unit is looked at only if it holds one of a few words that no match
can do without, and a template's runs only if the whole document has that many
of its bigrams.

The templates are a parameter and part of the plan.  Every document is scanned
where it is read; there is no shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices as the licences give them, by SPDX-like names.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied. See the License for the specific language governing permissions and limitations under the "
                   "License."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of "
                 "the License, or (at your option) any later version."),
    ("Apache-1.0", "Licensed under the Apache License, Version 1.0."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
            "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
            "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
            "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
            "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
                "License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
            "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
            "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
            "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
            "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
            "THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
                  "means."),
    ("reserved", "All rights reserved."),
]

#: Words that are tried last when anchors are chosen.
COMMON = set("a all an and any are be by for from in is it not of on or that the this to use with without work".split())
HITS = "array<struct<dice:double,name:string,unit:string,k:int>>"
PARAGRAPH = "\n *(?:\n *)+"


def template_words(text: str) -> list[str]:
    """A template's words, normalised as documents are."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template."""
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(grams: list[str], low: float) -> set[str]:
    """Words, long and less common ones first, of so many of the bigrams that any share of
    ``low`` of them holds one of the words."""
    spare = len(grams) - max(1, math.ceil(len(grams) * low))
    found: set[str] = set()
    held: set[str] = set()
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        new = {g for g in grams if word in g.split()} - held
        if new:
            found.add(word)
            held |= new
        if len(held) > spare:
            break
    return found


def _templates(templates: list[tuple[str, str]]) -> tuple[Column, int, list]:
    rows = [(name, grams) for name, text in templates if (grams := template_bigrams(text))]
    cols = [F.struct(F.lit(name).alias("name"), F.lit(len(g)).alias("n"), F.array(*map(F.lit, g)).alias("grams"),
                     F.lit(k).alias("k")) for k, (name, g) in enumerate(rows, 1)]
    return F.array(*cols), max((len(g) for _, g in rows), default=0), rows


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    return F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
                      F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def _passages(templates: Column, low: float, high: float, threshold: float) -> Column:
    """Matches (dice, name, unit) of runs of words, from the columns
    ``paragraphs`` (of lines of words), ``grams`` and ``hits``."""
    near = F.filter(templates, lambda t: F.size(F.array_intersect(t["grams"], F.col("grams"))) >= t["n"] * low)

    def of_template(t: Column) -> Column:
        taken = F.array_distinct(F.transform(F.filter("hits", lambda h: h["name"] == t["name"]), lambda h: h["unit"]))

        def left(words: Column, otherwise: Column) -> Column:
            return F.when(F.array_contains(taken, F.array_join(words, " ")),
                          F.array_repeat(F.lit("\n"), F.size(words))).otherwise(otherwise)

        words = F.flatten(F.transform("paragraphs", lambda p: left(
            F.flatten(p), F.flatten(F.transform(p, lambda line: left(line, line))))))
        # one-element arrays, so that what is used several times is made once
        return F.flatten(F.transform(F.array(words), lambda w: F.flatten(
            F.transform(F.array(_bigrams(w)), lambda g: of_words(t, w, g)))))

    def of_words(t: Column, words: Column, grams: Column) -> Column:
        least = F.greatest(F.lit(1), F.ceil(t["n"] * low).cast("int"))
        most = F.floor(t["n"] * high).cast("int")
        at = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i + 1)),
                      lambda i: i.isNotNull())

        def scored(r: Column) -> Column:
            return F.flatten(F.transform(F.array(F.array_distinct(F.slice(grams, r["start"], r["n"]))),
                                         lambda a: F.array(F.struct(
                (F.lit(2.0) * F.size(F.array_intersect(a, t["grams"])) / (F.size(a) + t["n"])).alias("dice"),
                r["n"].alias("n"), (-r["start"]).alias("start")))))

        def of_starts(starts: Column) -> Column:
            # (position, number) of the hits from which enough others are near
            full = F.filter(F.transform(starts, lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
                            lambda x: F.get(starts, x["i"] + least - 1) - x["s"] < most)
            runs = F.flatten(F.transform(full, lambda x: F.transform(
                F.filter(F.slice(starts, x["i"] + least, most - least + 1), lambda e: e - x["s"] < most),
                lambda e: F.struct(x["s"].alias("start"), (e - x["s"] + 1).alias("n")))))
            return F.filter(F.flatten(F.transform(runs, scored)), lambda x: x["dice"] >= threshold)

        found = F.flatten(F.transform(F.array(at), of_starts))
        return F.transform(F.flatten(F.transform(F.array(found), best)), lambda x: F.struct(
            x["dice"].alias("dice"), x["n"].alias("n"), x["start"].alias("start"), t["name"].alias("name"),
            F.array_join(F.array_remove(F.slice(words, -x["start"], x["n"] + 1), "\n"), " ").alias("unit"),
            t["k"].alias("k")))

    def best(found: Column) -> Column:
        """Best first (then the longest), those that share no word with one taken before."""
        return F.aggregate(F.sort_array(found, asc=False), F.slice(found, F.lit(1), F.lit(0)), lambda kept, a: F.when(
            F.exists(kept, lambda b: (-b["start"] <= a["n"] - a["start"]) & (-a["start"] <= b["n"] - b["start"])),
            kept).otherwise(F.array_append(kept, a)))

    def explained(x: Column) -> Column:
        """Whether a unit around the passage matches another licence by a
        template with all the bigrams that the passage shares with its own, and
        that at least as well, or with more of them."""
        own = F.array_intersect(_bigrams(F.split(x["unit"], " ")), F.element_at(templates, x["k"])["grams"])

        def more(h: Column) -> Column:
            return F.size(F.array_intersect(_bigrams(F.split(h["unit"], " ")), F.element_at(templates, h["k"])["grams"])) > F.size(own)

        return F.exists(F.array_distinct("hits"), lambda h: (
            h["name"] != x["name"]) & F.contains(h["unit"], x["unit"]) & (
            F.size(F.array_except(own, F.element_at(templates, h["k"])["grams"])) == 0) & (
            (h["dice"] >= x["dice"]) | more(h)))

    # the best of each template's runs, then of all of them
    found = F.flatten(F.transform(F.array(F.flatten(F.transform(near, of_template))), best))
    return F.transform(F.filter(found, lambda x: ~explained(x)), lambda x: F.struct(
        x["dice"].alias("dice"), x["name"].alias("name"), x["unit"].alias("unit"), x["k"].alias("k")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per input row: the identifier, ``n_matches`` (units or
    passages, and templates that match), ``license`` and ``dice`` of the best match (ties:
    the last name), and ``matches``, an array of (unit, name, dice) with the
    normalised words of each matching unit or passage.

    A null or empty text, or one without two words, matches nothing:
    0, nulls and an empty array.  A line that repeats counts each time.  A unit
    that matches has its own coefficient, even where a run inside it has a higher one.  Null
    and repeated identifiers pass through; other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    column, largest, rows = _templates(templates)
    if not rows:
        column = F.lit(None).cast("array<struct<name:string,n:int,grams:array<string>,k:int>>")
    # a little wide, so that rounding prunes nothing that is just at the threshold
    low, high = threshold / (2 - threshold) * (1 - 1e-9), (2 - threshold) / threshold * (1 + 1e-9)
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    texts = docs.select(F.col(id_col).alias("id"), plain.alias("plain"))
    rare = sorted(set().union(*(anchors(grams, low) for _, grams in rows)))
    rare = F.array(*map(F.lit, rare)) if rare else F.lit(None).cast("array<string>")
    texts = texts.select("id", F.when(F.arrays_overlap(F.split(F.translate("plain", "\n", " "), " "), rare),
                                      F.col("plain")).alias("plain"))
    units = texts.select(
        "id", "plain", F.concat(
            F.split("plain", "\n"),
            F.transform(F.filter(F.split("plain", PARAGRAPH), lambda p: F.contains(p, F.lit("\n"))),
                        lambda p: F.translate(p, "\n", " "))).alias("units"))
    words = units.select("id", "plain", F.filter(
        F.transform("units", _words),
        lambda w: (F.size(w) > 1) & F.arrays_overlap(w, rare) & (F.size(F.array_distinct(w)) - 1 <= largest * high)).alias("words"))
    sets = words.select("id", "plain", F.transform("words", lambda w: F.struct(
        w.alias("words"), F.array_distinct(_bigrams(w)).alias("grams"))).alias("sets"))

    def compare(unit: Column) -> Column:
        grams = unit["grams"]
        near = F.filter(column, lambda t: (F.size(grams) >= t["n"] * low) & (F.size(grams) <= t["n"] * high))
        scored = F.transform(near, lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + t["n"])).alias("dice"),
            t["name"].alias("name"), F.array_join(unit["words"], " ").alias("unit"), t["k"].alias("k")))
        return F.filter(scored, lambda s: s["dice"] >= threshold)

    hits = sets.select("id", "plain", F.flatten(F.transform("sets", compare)).alias("hits"))
    hits = hits.select(
        "id", "hits", F.transform(F.split("plain", PARAGRAPH), lambda p: F.transform(F.split(p, "\n"), _words)).alias("paragraphs"),
        _words(F.translate("plain", "\n", " ")).alias("words"))
    hits = hits.select("id", "hits", "paragraphs", F.array_distinct(_bigrams(F.col("words"))).alias("grams"))
    hits = hits.select("id", F.when(F.col("hits").isNull(), F.array().cast(HITS)).otherwise(
        F.concat("hits", _passages(column, low, high, threshold))).alias("hits"))
    best = F.array_max("hits")
    return hits.select(
        F.col("id").alias(id_col), F.size("hits").cast("long").alias("n_matches"),
        best["name"].alias("license"), best["dice"].alias("dice"),
        F.transform("hits", lambda h: F.struct(h["unit"].alias("unit"), h["name"].alias("name"),
                                               h["dice"].alias("dice"))).alias("matches"))


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> str:
    """The scan's first four columns for DuckDB."""
    values = ",\n    ".join(
        f"({k}, '{name}', ['" + "', '".join(template_bigrams(text)) + "'])"
        for k, (name, text) in enumerate(templates))
    return f"""
WITH t(k, name, grams) AS (VALUES
    {values}
), d AS (
  SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS plain
  FROM documents
), u AS (
  SELECT doc_id, unnest(string_split(plain, chr(10))) AS unit FROM d
  UNION ALL
  SELECT doc_id, unit FROM (
    SELECT doc_id, unnest(regexp_split_to_array(plain, '\\n *(?:\\n *)+')) AS unit FROM d)
  WHERE contains(unit, chr(10))
), w AS (
  SELECT doc_id, list_filter(string_split(replace(unit, chr(10), ' '), ' '), lambda x: x <> '') AS words FROM u
), g AS (
  SELECT doc_id, list_distinct(list_transform(range(1, len(words)),
                                              lambda i: words[i] || ' ' || words[i + 1])) AS grams
  FROM w WHERE len(words) > 1
), m AS (
  SELECT g.doc_id, t.name,
         2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
  FROM g JOIN t ON list_has_any(g.grams, t.grams)
), b AS (
  SELECT doc_id, count(*) AS n_matches, max({{'dice': dice, 'name': name}}) AS best
  FROM m WHERE dice >= {threshold} GROUP BY doc_id
)
SELECT d.doc_id, coalesce(b.n_matches, 0) AS n_matches, b.best.name AS license, b.best.dice AS dice
FROM d LEFT JOIN b USING (doc_id)
"""
