"""Exact copies against a dictionary."""

import hashlib

import pytest

from creditweave.llm.exact_dedup import exact_dedup

A_Z = {c: c + 32 for c in range(65, 91)}


def plain(rows, pick=max):
    sha = lambda t: hashlib.sha256((t or "").translate(A_Z).encode()).hexdigest()
    groups = {}
    for k, t in rows:
        groups.setdefault(sha(t), []).append(k)
    return sorted((k, pick(groups[sha(t)]), len(groups[sha(t)]), k == pick(groups[sha(t)]), sha(t)) for k, t in rows)


ROWS = [(1, None), (2, ""), (3, "Ab"), (4, "aB"), (5, "É"), (6, "é"), (7, " ab"), (8, "x" * 500_000), (9, "X" * 500_000)]
ROWS += [(k, "the same text") for k in range(20, 60)]


@pytest.mark.parametrize("keep,pick,fan_in", [("largest", max, 2), ("smallest", min, 3), ("largest", max, 64)])
def test_every_tree_gives_the_same_groups(spark, keep, pick, fan_in):
    df = spark.createDataFrame([(*r, "a", 1) for r in ROWS], "doc_id long, text string, run string, digest int").repartition(9)
    got = exact_dedup(df, keep=keep, fan_in=fan_in).collect()
    assert sorted(map(tuple, got)) == plain(ROWS, pick)


def test_of_repeated_rows_one_stays(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "A"), (None, "a"), (None, "b")], "doc_id long, text string")
    got = exact_dedup(df).collect()
    assert sum(r.kept for r in got) == 2
    assert sorted((r.group_size, str(r.keep_id)) for r in got) == [(1, "None")] + [(4, "1")] * 4


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
