"""SimHash against plain loops over all pairs."""

import itertools
import random
import re

import numpy as np
import xxhash

from creditweave.llm import simhash
from creditweave.llm.components import connected_components

A_Z = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))
    if not words:
        return 0
    runs = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in prints}


def check(spark, rows, schema="doc_id long, text string, home string, fp string"):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.simhash_components(df).collect()}
    want = {k: plain_fingerprint(t) for k, t in rows}
    roots = plain_components(want)
    assert got == {k: (want[k], roots[k]) for k in want}
    return got


def test_texts_of_every_kind(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "two words"), (6, "É x a b c d"), (7, "a " * 30_000)]
    for k in range(10, 40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 40, 400]))]
        rows.append((k, " ".join(base)))
        base[-1] = "changed"
        rows.append((100 + k, "  ".join(base).upper()))
    check(spark, rows)


def test_planted_bit_distances_link_exactly_to_four(spark):
    rng = random.Random(6)
    points, key = [], 0
    for _ in range(60):
        base = rng.getrandbits(64)
        for distance in (0, 1, 2, 3, 4, 5, 6):
            flips = sum(1 << b for b in rng.sample(range(64), distance))
            points.append((key, base ^ flips))
            key += 1
    prints = dict(points)
    signed = [(v - (1 << 64) if v >> 63 else v, k) for k, v in prints.items()]
    df = spark.createDataFrame(signed, "fp long, rep long").groupBy("fp").agg({"rep": "min"}).toDF("fp", "rep")
    roots = {r.node: r.root for r in connected_components(simhash.links(df)).collect()}
    want = plain_components(prints)
    least = {}
    for k, v in prints.items():
        least.setdefault(v, k)
    assert {k: roots.get(least[v], least[v]) for k, v in prints.items()} == want


def test_crowded_anchors_are_dealt_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(simhash, "PAIRS", 20)
    rng = random.Random(7)
    base = rng.getrandbits(63)
    prints = {k: base ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(8))) for k in range(150)}
    least = {}
    for k, v in prints.items():
        least.setdefault(v, k)
    df = spark.createDataFrame([(v, k) for v, k in least.items()], "fp long, rep long")
    found = simhash.links(df)
    roots = {r.node: r.root for r in connected_components(found).collect()}
    assert {k: roots.get(least[v], least[v]) for k, v in prints.items()} == plain_components(prints)


def test_covering_radius():
    for _, length in simhash.BLOCKS:
        code = simhash.Covering(length)
        words = np.random.default_rng(1).integers(0, 1 << length, 5000)
        index, anchor, home = code.anchors(words)
        assert not code.syndromes(anchor).any()
        distance = np.bitwise_count(words[index] ^ anchor)
        assert distance[home].max() <= code.radius and home.sum() == len(words)
        assert distance.max() <= code.radius + simhash.BLOCK_BITS


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(df).collect() == []


def test_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(1, 41)} | {(101, 100), (102, 100)}
