"""Raking and sampling against plain loops."""

import hashlib
import random
from collections import Counter

import pytest

from creditweave.llm import mixing


def table(n=400, seed=4):
    rng = random.Random(seed)
    langs = ["en"] * 6 + ["de", "fr", None]
    rows = []
    for k in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        text = rng.choice([" ".join(["w"] * rng.choice([0, 3, 150, 1200])), "x | y", "$% " * 40, None, ""])
        rows.append((k, text, rng.choice(langs), source))
    return rows


def plain(rows, sweeps=mixing.SWEEPS):
    def topic(text, n):
        signs = sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in text)
        if " | " in text:
            return "table"
        if signs * 12 > len(text):
            return "symbols"
        return "short" if n < 100 else "long" if n >= 1000 else "prose"

    cells, of = {}, {}
    for k, text, lang, source in rows:
        n = len((text or "").split())
        of[k] = (source or "unknown", lang or "und", topic(text or "", n))
        cells[of[k]] = cells.get(of[k], 0) + n
    tokens = {c: n for c, n in cells.items() if n}
    weight, goals = dict(tokens), []
    for i, m in enumerate(mixing.MARGINS):
        sums = {}
        for c, n in tokens.items():
            sums[c[i]] = sums.get(c[i], 0) + n
        power = sum(s ** mixing.TEMPERATURE[m] for s in sums.values())
        goals.append({v: s ** mixing.TEMPERATURE[m] / power * sum(sums.values()) for v, s in sums.items()})
    for _ in range(sweeps):
        for i, goal in enumerate(goals):
            now = {}
            for c, w in weight.items():
                now[c[i]] = now.get(c[i], 0) + w
            weight = {c: w * goal[c[i]] / now[c[i]] for c, w in weight.items()}
    ratio = {k: weight[c] / tokens[c] if c in tokens else 1.0 for k, c in of.items()}
    return ratio, of, weight, goals


def test_ratios_draws_and_margins(spark):
    rows = table()
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, weight double")
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    ratio, of, weight, goals = plain(rows)
    assert len(got) == len(rows)
    for k, r in got.items():
        assert (r.source, r.lang, r.topic) == of[k]
        assert r.ratio == pytest.approx(ratio[k], abs=2e-9)
        u = int(hashlib.md5(f"mix-1:{k}".encode()).hexdigest()[:8], 16) / 2**32
        assert r.kept == (u < min(1.0, ratio[k]))
        assert r.probability * r.weight == pytest.approx(r.ratio, abs=1e-6)
    for i, goal in enumerate(goals):
        for value, target in goal.items():
            assert sum(w for c, w in weight.items() if c[i] == value) == pytest.approx(target, rel=0.02)


def test_tables_without_tokens(spark):
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (None, "", "en", "a")], schema)
    got = mixing.mix(df).collect()
    assert [(r.ratio, r.kept) for r in got] == [(1.0, True)] * 3
    assert mixing.mix(df.limit(0)).collect() == []


def test_drawn_rows_meet_the_targets(spark):
    rows = table(20_000, 9)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    ratio, of, _, goals = plain(rows)
    largest = max(r for k, r in ratio.items() if rows[k][1])
    assert largest > 1.5
    tokens = {k: len((text or "").split()) for k, text, _, _ in rows}
    kept = Counter(r.doc_id for r in mixing.sampled(df).collect())
    assert set(kept.values()) == {1}
    for k in tokens:
        u = int(hashlib.md5(f"mix-1:{k}".encode()).hexdigest()[:8], 16) / 2**32
        assert (k in kept) == (u < ratio[k] / largest) or not tokens[k]
    chance = {k: ratio[k] / largest for k in tokens}
    for i, goal in enumerate(goals):
        for value, target in goal.items():
            members = [k for k in tokens if of[k][i] == value]
            assert sum(chance[k] * tokens[k] for k in members) == pytest.approx(target / largest, rel=0.02)
            spread = sum(chance[k] * (1 - chance[k]) * tokens[k] ** 2 for k in members) ** 0.5
            assert abs(sum(tokens[k] for k in members if k in kept) - target / largest) < 4 * spread + 0.02 * target
