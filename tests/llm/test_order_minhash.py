"""Order MinHash: edited texts by plain Python, signatures by a plain rebuild."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from creditweave.llm import order_minhash as om


def xx(spark, rows, kind):
    """XXH64 as Spark computes it, for many inputs in one job."""
    return [r[0] for r in spark.createDataFrame(rows, kind).select(F.xxhash64("*")).collect()]


def plain_signature(spark, text):
    words = xx(spark, [(w,) for w in re.split("[ \t-\r]+", text)], "w string")
    n = len(words)
    padded = words + [None, None]
    kmers = xx(spark, [tuple(padded[i : i + 3]) for i in range(n)], "a long, b long, c long")
    signed = lambda v: ((v & ((1 << 38) - 1)) ^ (1 << 37)) - (1 << 37)
    kmers = [signed(k) for k in kmers]
    seen, numbers = Counter(), []
    for k in kmers:
        numbers.append(seen[k])
        seen[k] += 1
    values = xx(spark, list(zip(kmers, numbers)), "a long, b int")
    bins = {}
    for place, v in enumerate(values):
        v &= (1 << 37) - 1
        bins.setdefault(v >> 31, []).append((v & ((1 << 31) - 1), place))
    chosen = {b: [h for _, h in sorted((p, h) for h, p in sorted(m)[:2])] for b, m in bins.items()}
    hashed = xx(spark, [(chosen[b],) for b in sorted(chosen)], "a array<long>")
    return [b << 24 | h & 0xFFFFFF for b, h in zip(sorted(chosen), hashed)]


def test_signature_is_the_plain_one(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(8)]
    texts = ["", "one", "a a a a a a a a a a a", " lead  and\ttail "]
    texts += [" ".join(rng.choices(vocabulary, k=k)) for k in (2, 30, 400, 3000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(om.signature(F.col("t"))).collect()
    assert [list(r[0]) for r in got] == [plain_signature(spark, t) for t in texts]


def edited(rows):
    ordered = sorted(rows)
    out = {}
    for i, (k, t) in enumerate(ordered):
        t, following = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        out[k] = t[: len(t) - half] + following[:half]
    return out


def test_edited_texts_follow_ascending_ids(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(10**12), "".join(rng.choices("ab é😀\n", k=rng.randrange(60)))) for _ in range(300)]
    rows += [(5, None), (6, ""), (7, "x" * 50_001)]
    want = edited(rows)
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, key int")
    for buckets in (1, 2, 40):
        got = {r.doc_id: r for r in om.fingerprints(df, buckets=buckets).collect()}
        assert {k: r.edited_sha256 for k, r in got.items()} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in want.items()}
        assert all(r.n_chars == len(t or "") for (k, t), r in zip(rows, (got[k] for k, _ in rows)))


def test_likeness_falls_with_edits(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(800)]
    other = [f"w{rng.randrange(5000)}" for _ in range(800)]
    swapped = base[400:] + base[:400]
    texts = [base, base, base[:720] + other[:80], base[:400] + other[400:], other, swapped, sorted(base)]
    df = spark.createDataFrame([(" ".join(t),) for t in texts], "t string").select(om.signature(F.col("t")).alias("s"))
    first = df.limit(1).select(F.col("s").alias("f"))
    near = [r[0] for r in df.join(first).select(om.likeness(F.col("f"), F.col("s"))).collect()]
    assert near[0] == near[1] == 1.0
    assert 1 > near[2] > near[3] > near[4] and near[4] < 0.2 and near[6] < 0.2
    # The same k-mers in another order are less alike than their set says.
    assert near[5] < 0.9


def test_repeated_rows_one_row_and_empty_table(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(1, "ab cd"), (1, "ab cd"), (None, "x")], schema)
    got = om.fingerprints(df).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    alone = om.fingerprints(spark.createDataFrame([(4, "abcd")], schema)).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone[0].near_next == 1.0
    assert om.fingerprints(df.limit(0)).collect() == []


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in om.fingerprints(df)._jdf.queryExecution().toString()
