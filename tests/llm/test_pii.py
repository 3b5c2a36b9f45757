"""Personal data: base spans by plain patterns, the field by brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from creditweave.llm import pii

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = [
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                16 <= len(digits) <= 19 and pii.luhn(digits),
                8 <= len(digits) <= 15,
            ][kind]
            if good:
                found.append((kind, *m.span()))
    return found


def test_base_spans_equal_plain_patterns():
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "@@", ".", "..", "1", "255", "256", "4111 1111-1111 1111", "4111111111111111", "+", "(", ") ", "-", " ", "é", "٣", "x-1", "\n", "000"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for run in ("a" * 2_000_000, "1" * 1_000_000, "1." * 500_000, "+" * 1_000_000, "@" * 100_000, "1 " * 300_000):
        pii.base_spans(run)


@pytest.fixture(scope="module")
def field():
    return pii.fit(["12.34.56.78", "a.b@c.example.com", "+1 (988) 555-2485", "4433687251362221", "4111111111111111"] * 3)


def test_decoding_is_the_best_of_all_segmentations(field):
    for zone in ("(988) 555-2485", "1.2.3.4 555.123.4567", "ab@cd.com 12345678"):
        grid = pii.lattice(zone)
        scores = (grid.table @ field.weights.T).max(axis=1)
        best = 0.0
        for size in range(1, 4):
            for chosen in itertools.combinations(range(len(grid.spans)), size):
                ordered = sorted(grid.spans[k] for k in chosen)
                if all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:])):
                    best = max(best, scores[list(chosen)].sum())
        at = {b: i for i, b in enumerate(grid.bounds)}
        index = {s: k for k, s in enumerate(grid.spans)}
        got = sum(scores[index[at[a], at[b]]] for _, a, b in field.decode(zone))
        assert got == pytest.approx(best)


def test_gradient():
    grid = pii.lattice("(988) 555-2485")
    gold = {(0, len(grid.bounds) - 1): 3}
    weights = np.random.default_rng(0).normal(size=(4, len(pii.FEATURES))) * 0.1
    _, gradient = pii.likelihood(grid, gold, weights)
    for k, f in [(3, 0), (3, 8), (1, 0), (2, 21)]:
        step = np.zeros_like(weights)
        step[k, f] = 1e-5
        slope = (pii.likelihood(grid, gold, weights + step)[0] - pii.likelihood(grid, gold, weights - step)[0]) / 2e-5
        assert slope == pytest.approx(gradient[k, f], abs=1e-6)


def test_other_notations_are_found_and_numbers_left_alone(field):
    rng = random.Random(99)
    right = total = wrong = 0
    for _ in range(400):
        zone, gold = pii.written_otherwise(rng)
        text = f"see {zone} there"
        _, spans = pii.all_spans(text, field)
        want = [(k, a + 4, b + 4) for k, a, b in gold]
        total += bool(gold)
        right += bool(gold) and spans == want
        wrong += not gold and bool(spans)
    assert right >= 0.95 * total and wrong <= 4


def test_rows_of_every_kind(spark):
    texts = {1: None, 2: "", 3: "mail a.b@c.de now", 4: "ip 1.2.3.4", 5: "x" * 400_000 + " 4111 1111 1111 1111", 6: "call (988) 555-2485", 7: "é a@b.c"}
    df = spark.createDataFrame([(k, t, "q") for k, t in texts.items()] + [(None, "a@b.c", "q")], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert {k: (r.n_email, r.n_ip, r.n_card, r.n_phone) for k, r in got.items()} == {
        1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (1, 0, 0, 0), 4: (0, 1, 0, 0), 5: (0, 0, 1, 0), 6: (0, 0, 0, 0), 7: (1, 0, 0, 0), None: (1, 0, 0, 0),
    }
    assert got[6].spans == "phone:5:19" and got[7].spans == "email:2:7" and got[1].spans == ""
    assert pii.find_personal_data(df.limit(0)).collect() == []
