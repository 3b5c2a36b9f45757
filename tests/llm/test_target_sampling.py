"""Weights, scores and ranks against plain counting."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import pytest
from test_decontaminate import words

from creditweave.llm import target_sampling as ts


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def plain(rows, target, buckets=10_000, share=25, least=20):
    def bucket(f):
        return crc32(f.encode()) % buckets

    own, wanted = Counter(), Counter()
    for _, text in rows:
        own.update(map(bucket, features(text)))
    for text in target:
        wanted.update(map(bucket, features(text)))
    s, t = sum(own.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out, able = [], []
    for key, text in rows:
        f = features(text)
        weight = math.floor(sum(gain[bucket(x)] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(f), weight, score, None])
        if len(words(text)) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0]))
    for i, r in enumerate(able[: share * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, out))


def tables(seed=2, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["É", "日本", "x" * 70, "0"]
    rows = [(0, None), (1, ""), (2, "--\x00"), (3, "one"), (4, "two words"), (5, "w1 " * 50_000), (6, "x" * 100_000)]
    rows += [(k, " ".join(rng.choices(vocabulary[k % 40 :], k=rng.choice([3, 19, 20, 21, 90])))) for k in range(10, n)]
    rows += [(n + k, rows[20][1]) for k in range(60)]
    target = [None, ""] + [" ".join(rng.choices(vocabulary[:30], k=40)) for _ in range(9)]
    return rows, target


def frames(spark, rows, target):
    docs = spark.createDataFrame([(*r, 1.5, "y") for r in rows], "doc_id long, text string, score double, row string").repartition(4)
    return docs, spark.createDataFrame([(t, 1) for t in target], "text string, item_id int")


@pytest.mark.parametrize("small", [False, True])
def test_every_row(spark, monkeypatch, small):
    if small:  # nearly everything is tail, and nothing is remembered for long
        for name, value in [("HEAD_WORDS", 5), ("HEAD_PAIRS", 4), ("CACHE_SIZE", 7), ("SAMPLE_ROWS", 30), ("LONGEST_KEPT", 6)]:
            monkeypatch.setattr(ts, name, value)
    rows, target = tables()
    got = ts.sample_like(*frames(spark, rows, target)).drop("n_words").collect()
    assert sorted(map(tuple, got)) == plain(rows, target)
    assert sum(r.rank is not None for r in got) > 40


def test_other_parameters(spark):
    rows, target = tables(4, 90)
    docs, wanted = frames(spark, rows, target)
    got = ts.sample_like(docs, wanted, buckets=64, share=100, least_words=1).drop("n_words").collect()
    assert sorted(map(tuple, got)) == plain(rows, target, 64, 100, 1)
    assert all(r.rank is None for r in ts.sample_like(docs, wanted, share=0).collect())
    with pytest.raises(ValueError):
        ts.sample_like(docs, wanted, buckets=70_000)


def test_drawn_rows_are_more_like_the_target(spark):
    rows, target = tables(6, 400)
    docs, wanted = frames(spark, rows, target)
    kept = ts.drawn_documents(docs, wanted)
    assert kept.columns == docs.columns
    want = {r[0] for r in plain(rows, target) if r[4]}
    assert {r.doc_id for r in kept.collect()} == want
    common = {w for t in target for w in words(t)}

    def alike(keys):
        found = [w in common for k, t in rows if k in keys for w in words(t) if len(t) < 5000]
        return sum(found) / len(found)

    assert alike(want) > alike({k for k, t in rows if len(words(t)) >= 20})


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "a b " * 20
    docs, wanted = frames(spark, [(1, text), (1, text), (None, text), (None, text)], ["a b"])
    got = ts.sample_like(docs, wanted, share=100).collect()
    assert sorted(r.rank for r in got) == [1, 2, 3, 4] and len({r.score for r in got if r.doc_id is None}) == 1
    assert ts.sample_like(docs.limit(0), wanted).collect() == []
    assert len(ts.sample_like(docs, wanted.limit(0)).collect()) == 4
