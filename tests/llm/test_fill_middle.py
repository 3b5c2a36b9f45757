"""Cuts at lines against slices, and exact round trips."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from creditweave.llm import fill_middle as fm

LINE = re.compile(r"[^\n]*\n|[^\n]+")


@given(st.lists(st.integers(0, 9), max_size=700), st.data())
@settings(max_examples=60, deadline=None)
def test_places_in_the_list_are_prefix_sums(widths, data):
    nodes = fm.SkipList(widths)
    assert len(nodes) == len(widths)
    rank = data.draw(st.integers(0, len(widths)))
    assert nodes.place(rank) == sum(widths[:rank])
    with pytest.raises(IndexError):
        nodes.place(len(widths) + 1)


@given(st.text("a\n\r\x0b\x85 é😀<PSM>", max_size=60))
def test_lines(text):
    assert fm.line_widths(text) == [len(u) for u in LINE.findall(text)]


def plain(key, text, rate=100, spm=50, seed=7):
    """The contract, by slices of a list of lines."""
    text = text or ""
    units = LINE.findall(text)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(units), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def texts():
    rng = random.Random(3)
    some = [None, "", "\n", "\n\n\n", "a", "a\n", "<", "<P", "<P\n>", "x<M>\ny", "<P><S><M>", "P>\n<S\n<M\n>", "\r\n\x00\n b", "l\n" * 120_000, "z" * 400_000]
    return some + ["".join(rng.choices(["a", "é", "😀", "\n", "<", "P", "S", "M", ">", " w"], k=rng.randrange(80))) for _ in range(600)]


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (70, 100), (0, 50)])
def test_every_kind_of_text(spark, rate, spm):
    given_rows = list(enumerate(texts()))
    df = spark.createDataFrame([(*r, 5, "x") for r in given_rows], "doc_id long, text string, n int, output string").repartition(4)
    got = {r.doc_id: r for r in fm.restored(fm.fill_middle(df, rate=rate, spm_rate=spm)).collect()}
    assert len(got) == len(given_rows)
    forms = set()
    for key, text in given_rows:
        r = got[key]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(key, text, rate, spm)
        assert r.restored == (text or "") == fm.original(r.form, r.output)
        forms.add(r.form)
    assert len(forms) > (rate > 0)


def test_null_and_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a\nb"), (None, "a\nb"), (4, "c"), (4, "c")], "key int, body string")
    got = fm.fill_middle(df, "key", "body").collect()
    assert sorted((r.key or 0, r.output) for r in got) == sorted((k or 0, plain("null" if k is None else k, t)[4]) for k, t in [(None, "a\nb")] * 2 + [(4, "c")] * 2)
    assert fm.restored(fm.fill_middle(df.limit(0), "key", "body")).collect() == []
