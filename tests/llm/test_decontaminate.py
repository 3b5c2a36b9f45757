"""Passages against windows looked up one by one."""

import hashlib
import random
import re

import numpy as np
import pytest

from creditweave.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(low)


def plain(docs, items, window=10):
    windows = {}
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), []).append("null" if key is None else str(key))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i : i + n]))
                if names:
                    hit |= set(range(i, i + n))
                    found |= set(names)
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def longest(text, items, window=10):
    w, best = words(text), 0
    for _, t in items:
        v = words(t)
        least = min(window, len(v))
        for i in range(len(w)):
            for j in range(len(v)):
                n = 0
                while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                    n += 1
                if n >= least:
                    best = max(best, n)
    return best


def tables(seed=5, docs=220):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "É", "zé", "x9", "日本"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(8, 30)))) for k in range(14)]
    items += [(20, None), (21, ""), (22, "..."), (23, "x9 zé"), (None, "only one Word here of Null"), (100, items[2][1]), (3, items[3][1]), (9, "a " * 25)]
    rows = [(0, None), (1, ""), (2, "a " * 400), (3, "x9 x9 zé zé"), (4, "x9\x00ZÉ"), (5, "x9-Zé"), (6, "日本" * 3000)]
    for k in range(10, docs):
        parts = []
        for _ in range(rng.randrange(5)):
            item = words(rng.choice(items)[1])
            a = rng.randrange(len(item) + 1)
            parts += item[a : a + rng.randrange(25)] + rng.choices(vocabulary + ["unknown", "Other"], k=rng.randrange(6))
        rows.append((k, rng.choice([" ", ", ", "\n", "\x7f"]).join(parts).upper() if k % 3 else " ".join(parts)))
    return rows, items


def frames(spark, rows, items):
    docs = spark.createDataFrame([(*r, 3, "i") for r in rows], "doc_id long, text string, row int, items string").repartition(3)
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    return docs, bench


@pytest.mark.parametrize("shard_words,block_bytes", [(dc.SHARD_WORDS, dc.BLOCK_BYTES), (1, 10**6), (300, 200)])
def test_every_word(spark, shard_words, block_bytes):
    rows, items = tables()
    docs, bench = frames(spark, rows, items)
    found = dc.find_passages(docs, bench, shard_words=shard_words, block_bytes=block_bytes).collect()
    got = spark.createDataFrame(found, dc.find_passages(docs, bench).schema)
    assert sorted(tuple(r)[:6] for r in dc.contamination(got).collect()) == sorted(plain(rows, items))
    assert {r.contaminated for r in dc.contamination(got).collect()} == {True, False}
    for r in found:
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))


def test_windows_of_other_lengths_and_longest_passage(spark):
    rows, items = tables(7, 60)
    docs, bench = frames(spark, rows[3:6] + rows[7:], items)
    for window in (1, 3, 17):
        got = {r.doc_id: r for r in dc.find_passages(docs, bench, window=window, shard_words=100).collect()}
        want = plain(rows[3:6] + rows[7:], items, window)
        assert {k: (r.n_words, r.n_hit, len(r["items"])) for k, r in got.items()} == {w[0]: w[1:4] for w in want}
        for key, text in rows[7:30]:
            assert got[key].longest == longest(text, items, window)


def test_suffixes_are_sorted_as_deep_as_asked():
    rng = random.Random(1)
    for size, letters, depth in [(0, 2, 10), (1, 1, 10), (300, 1, 10), (400, 2, 10), (500, 70_000, 3), (500, 2**40, 13)]:
        ids = np.array([rng.randrange(1, letters + 1) if rng.random() < 0.9 else 0 for _ in range(size)] + [0] * depth, np.int64)
        starts = np.flatnonzero(ids)

        def known(i):
            run = ids[i : i + depth].tolist()
            return run[: run.index(0)] if 0 in run else run

        order = dc.suffix_array(ids, starts, depth).tolist()
        assert sorted(order) == starts.tolist()
        assert all(known(i) <= known(j) for i, j in zip(order, order[1:]))


def test_contaminated_documents_go(spark):
    rows, items = tables()
    docs, bench = frames(spark, rows + [(2, "clean"), (None, "clean")], items)
    clean = dc.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    hit = {r[0] for r in plain(rows, items) if r[5]}
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in rows if k not in hit} | {None}


def test_empty_tables_and_repeated_rows(spark):
    docs, bench = frames(spark, [(1, "a b"), (1, "a b"), (None, "x")], [(4, "A b"), (4, "A b")])
    got = dc.contamination(dc.find_passages(docs, bench)).collect()
    assert sorted((r.doc_id or 0, r.n_hit, r.n_items) for r in got) == [(0, 0, 0), (1, 2, 1), (1, 2, 1)]
    assert dc.find_passages(docs.limit(0), bench).collect() == []
    assert [r.n_hit for r in dc.find_passages(docs, bench.limit(0)).collect()] == [0, 0, 0]
