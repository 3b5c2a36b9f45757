"""Licence scans: Dice coefficient of word bigrams against licence templates.

A text is scanned by lines, by paragraphs and as a whole. A unit of n words
has n - 1 bigrams, repeats numbered. The coefficient can only reach the
threshold t if the smaller of two sizes is at least t / (2 - t) of the larger:
a unit meets only the templates of the sizes so admitted, and most units none.
Built-in expressions on the rows as they are scanned; nothing is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from creditweave.llm.common import ascii_lower
from creditweave.llm.license_texts import NOTICES, PARAGRAPHS

THRESHOLD = 0.8
# Units below this many bigrams say too little.
LEAST_BIGRAMS = 2

# Notices and clauses of public licences.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "lgpl-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "agpl-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}
for _more in (NOTICES, PARAGRAPHS):
    for _name, _texts in _more.items():
        TEMPLATES[_name] = list(dict.fromkeys(TEMPLATES.get(_name, []) + _texts))


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate({c: c + 32 for c in range(65, 91)}))


def numbered_bigrams(words: list[str]) -> list[str]:
    """Bigrams, the k-th of equal ones marked by k."""
    seen, out = Counter(), []
    for pair in zip(words, words[1:]):
        bigram = " ".join(pair)
        out.append(f"{bigram} {seen[bigram]}")
        seen[bigram] += 1
    return out


def admitted_sizes(size: int, threshold: float) -> range:
    """Sizes that can reach ``threshold`` with ``size`` bigrams."""
    share = threshold / (2 - threshold)
    return range(max(1, math.ceil(size * share - 1e-9)), math.floor(size / share + 1e-9) + 1)


def templates_by_size(templates: dict[str, list[str]], threshold: float) -> dict[int, list[tuple[str, list[str]]]]:
    admitted = defaultdict(list)
    for name, texts in templates.items():
        for text in texts:
            bigrams = numbered_bigrams(words_of(text))
            if len(bigrams) >= LEAST_BIGRAMS:
                for size in admitted_sizes(len(bigrams), threshold):
                    admitted[size].append((name, bigrams))
    return dict(admitted)


def units(text: Column) -> Column:
    """Lines, paragraphs and the whole of a text, of characters a-z, 0-9 and line ends."""
    plain = F.regexp_replace(ascii_lower(text), "[^a-z0-9\n]+", " ")
    return F.array_union(F.array_union(F.split(plain, "\n"), F.split(plain, "\n ?\n[\n ]*")), F.array(plain))


def _bigrams(candidates: Column) -> Column:
    """``numbered_bigrams`` of each unit; a step's result is the next one's variable, so nothing is computed twice."""
    words = F.transform(candidates, lambda unit: F.regexp_extract_all(unit, F.lit("[a-z0-9]+"), F.lit(0)))

    def pairs(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - 1)
        return F.transform(places, lambda i: F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1)))

    # Among sorted bigrams, equal ones follow the first of them.
    def numbered(p: Column) -> Column:
        return F.transform(p, lambda x, i: F.concat_ws(" ", x, (i + 1 - F.array_position(p, x)).cast("string")))

    return F.transform(F.transform(F.transform(words, pairs), lambda p: F.array_sort(p)), numbered)


def _literal(value: object, kind: str) -> Column:
    """A constant, folded when the query is planned."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, n_candidates, n_matches, license, dice)`` of every row.

    ``n_candidates`` counts the units that any template's size admits,
    ``n_matches`` those that reach the threshold. ``license`` and ``dice`` are
    of the best match, the first name among equals; without one they are null
    and zero. Null text is empty. Repeated rows and null ids are kept; other
    columns are not read.
    """
    templates = templates or TEMPLATES
    admitted = templates_by_size(templates, threshold)
    every = list({(name, tuple(bigrams)): None for ts in admitted.values() for name, bigrams in ts})
    number = {t: k for k, t in enumerate(every)}
    by_size = [[number[n, tuple(b)] for n, b in admitted.get(size, [])] for size in range(max(admitted) + 1)]
    lookup = _literal(by_size, "array<array<int>>")
    texts = _literal([{"name": n, "bigrams": b} for n, b in every], "array<struct<name:string,bigrams:array<string>>>")
    vocabulary = sorted({w for ts in templates.values() for t in ts for w in words_of(t)})
    # Common bigrams are at least this share of a unit's, and consist of the templates' words.
    share = threshold / (2 - threshold)

    def may_match(unit: Column) -> Column:
        return F.coalesce(F.size(F.get(lookup, F.regexp_count(unit, F.lit("[a-z0-9]+")) - 1)) > 0, F.lit(False))

    def worth(unit: Column) -> Column:
        words = F.regexp_extract_all(unit, F.lit("[a-z0-9]+"), F.lit(0))
        return F.size(F.filter(words, lambda w: w.isin(vocabulary))) >= (F.size(words) - 1) * share - 1e-9

    def dice(bigrams: Column, template: Column) -> Column:
        common = F.size(F.array_intersect(bigrams, template["bigrams"]))
        return common * 2.0 / (F.size(bigrams) + F.size(template["bigrams"]))

    def good(bigrams: Column) -> Column:
        rated = F.transform(
            F.get(lookup, F.size(bigrams)),
            lambda k: F.struct(dice(bigrams, F.get(texts, k)).alias("dice"), F.get(texts, k)["name"].alias("name")),
        )
        return F.filter(rated, lambda m: m["dice"] >= threshold)

    candidates = F.filter(units(F.col(text_column)), may_match)
    found = docs.select(F.col(id_column).alias("id"), candidates.alias("candidates"))
    found = found.select("id", F.size("candidates").alias("n"), F.transform(_bigrams(F.filter("candidates", worth)), good).alias("good"))
    matched = F.filter("good", lambda ms: F.size(ms) > 0)
    every = F.flatten("good")
    found = found.select("id", "n", F.size(matched).alias("m"), every.alias("every"))
    top = found.withColumn("top", F.array_max(F.transform("every", lambda m: m["dice"])))
    names = F.transform(F.filter("every", lambda m: m["dice"] == F.col("top")), lambda m: m["name"])
    return top.select(
        F.col("id").alias(id_column),
        F.col("n").cast("long").alias("n_candidates"),
        F.col("m").cast("long").alias("n_matches"),
        F.array_min(names).alias("license"),
        F.coalesce(F.round("top", 9), F.lit(0.0)).alias("dice"),
    )
