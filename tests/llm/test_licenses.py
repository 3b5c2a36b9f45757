"""Licence scans against a plain scan of every unit and template."""

import random
import re

from creditweave.llm import licenses as L

A_Z = {c: c + 32 for c in range(65, 91)}


def plain(text):
    flat = re.sub("[^a-z0-9\n]+", " ", (text or "").translate(A_Z))
    units = {*flat.split("\n"), *re.split("\n ?\n[\n ]*", flat), flat}
    candidates = matches = 0
    best = (0.0, None)
    for unit in units:
        mine = L.numbered_bigrams(re.findall("[a-z0-9]+", unit))
        rates = []
        admitted = False
        for name, texts in L.TEMPLATES.items():
            for t in texts:
                theirs = L.numbered_bigrams(L.words_of(t))
                if len(theirs) < 2:
                    continue
                low, high = sorted((len(mine), len(theirs)))
                admitted |= low > 0 and low * 1.2 + 1e-9 >= high * 0.8
                rates.append((2 * len(set(mine) & set(theirs)) / max(1, len(mine) + len(theirs)), name))
        candidates += admitted
        good = [r for r in rates if r[0] >= 0.8]
        matches += bool(good)
        for r in good:
            if r[0] > best[0] or (r[0] == best[0] and r[1] < best[1]):
                best = r
    return candidates, matches, best[1], round(best[0], 9)


def test_every_unit_and_template(spark):
    rng = random.Random(8)
    every = [t for ts in L.TEMPLATES.values() for t in ts]
    texts = [None, "", " ", "All rights reserved", "ALL RIGHTS RESERVED.\n\nno", "x " * 20_000, "a a a a a a", "é É ß"]
    for _ in range(150):
        words = rng.choice(every).split()
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = rng.choice(["the", "foo", words[0]])
        joined = rng.choice([" ", "\n", "  "]).join(words)
        texts.append(rng.choice(["{}", "intro line\n{}\nrest of it", "one\n\n{}\n\ntwo three four"]).format(joined))
    df = spark.createDataFrame([(k, t, "l") for k, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {r.doc_id: (r.n_candidates, r.n_matches, r.license, r.dice) for r in L.scan(df).collect()}
    assert got == {k: plain(t) for k, t in enumerate(texts)}
    assert sum(g[1] > 0 for g in got.values()) > 50


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "All rights reserved"), (1, "All rights reserved"), (None, "x")], "doc_id long, text string")
    assert sorted((r.license or "", r.dice) for r in L.scan(df).collect()) == [("", 0.0)] + [("all-rights-reserved", 1.0)] * 2
    assert L.scan(df.limit(0)).collect() == []


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = L.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_standard_notices_and_bodies(spark):
    copy = "You should have received a copy of the GNU {} General Public License along with this {}. If not, see <https://www.gnu.org/licenses/>."
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:"
    isc = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    texts = {
        "agpl-3.0": copy.format("Affero", "program"),
        "lgpl-3.0": copy.format("Lesser", "library"),
        "mit": f"Copyright (c) someone\n\n{mit}\n\nmore",
        "isc": f"Some words\n{isc}",
        "zlib": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "bsl-1.0": "// Distributed under the Boost Software License, Version 1.0.",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    assert {r.doc_id: r.license for r in L.scan(df).collect()} == {k: k for k in texts}
