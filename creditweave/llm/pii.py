"""Personal data by a semi-Markov conditional random field.

Plain patterns give the base spans. The field then reads the zones of a text
that hold digits or an at-sign, cut into units (runs of digits, of letters,
of blanks, single signs). A candidate is a run of at most ``MOST_UNITS``
units; whole-span features and its kind give it a score, and dynamic
programming over all segmentations of the zone chooses boundaries and kinds
together. Spans that meet no base span are added to those.

The weights are fitted here by the exact gradient of the log-likelihood, on
zones of a bounded sample of documents labelled by the base patterns, and on
generated zones that write the same kinds in other ways.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import hash_sample, map_rows

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
MOST_UNITS = 24
# Reach of a zone on either side of an at-sign.
REACH = 64

# The base patterns. A match can only begin where a run of its
# first class begins, which the look-behinds say, so that no run is read twice.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

DIGIT = re.compile("[0-9]")
AT = re.compile(r"@| ?[\[(] ?at ?[\])] ?")
NUMBER_ZONE = re.compile(r"[+(]?[0-9](?:[ ().\-/\[\]+]{0,3}[0-9])+")
UNIT = re.compile(r"[0-9]+|[^\W\d_]+| +|.", re.DOTALL)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base patterns, by kind, then start; ends are exclusive."""
    found = []
    if "@" in text:
        free = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                found.append((0, start, m.end()))
                free = m.end()
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                    found.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _digits(m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    found.append((3, *m.span()))
    return found


def zones(text: str) -> list[tuple[int, int]]:
    """Disjoint ranges of ``text`` that may hold personal data."""
    found = []
    if DIGIT.search(text):
        found = [m.span() for m in NUMBER_ZONE.finditer(text) if m.end() - m.start() >= 7]
    for m in AT.finditer(text):
        start, end = m.span()
        low, high = max(0, start - REACH), min(len(text), end + REACH)
        while start > low and not text[start - 1].isspace():
            start -= 1
        end_word = re.compile(r"(?: ?[\[(] ?dot ?[\])] ?|[^\s])*").match(text, end, high).end()
        found.append((start, end_word))
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


# -- the field ---------------------------------------------------------------------

FEATURES = (
    "bias", "has at", "has at word", "dot after at", "dot word after at", "letters only at ends", "blank inside",
    "plus first", "paren first", "digits 7 to 9", "digits 10", "digits 11 to 15", "digits 16 to 19", "digits other",
    "luhn of 16 to 19", "four octets", "three points", "other letters", "sign at end", "digit next", "letter next",
    "groups 3 3 4", "groups of 4", "other signs", "no digit", "password cue",
)


def features(zone: str, start: int, end: int) -> np.ndarray:
    """Features of the whole span ``zone[start:end]``."""
    s = zone[start:end]
    digits = _digits(s)
    n = len(digits)
    at = s.find("@")
    word = AT.search(s) if at < 0 else None
    after = s[(at if at >= 0 else word.start()) :] if at >= 0 or word else ""
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    octets = [int(g) for g in re.findall("[0-9]+", s)[:5] if len(g) < 4]
    before, behind = zone[start - 1 : start], zone[end : end + 1]
    letters = any(c.isalpha() for c in s)
    mail = bool(after)
    return np.array(
        [
            1, at >= 0, bool(word), "." in after, bool(re.search(r"[\[(] ?dot ?[\])]", after)),
            mail and s[0].isalnum() and s[-1].isalnum(), " " in s and mail,
            s[0] == "+", s[0] == "(", 7 <= n <= 9 and not mail, n == 10 and not mail, 11 <= n <= 15 and not mail,
            16 <= n <= 19 and not mail, not mail and (n < 7 or n > 19), 16 <= n <= 19 and luhn(digits),
            len(groups) == 4 and len(octets) == 4 and max(octets) <= 255,
            s.count(".") == 3 and not letters, letters and not mail, not s[-1].isalnum(),
            (before + behind).isdigit() or (before != "" and before.isdigit()), before.isalpha() or behind.isalpha(),
            groups[-3:] == [3, 3, 4], n >= 16 and all(g == 4 for g in groups), any(c in "/=:;,_%" for c in s) and not mail,
            n == 0 and not mail, "=" in zone[max(0, start - 2) : start],
        ],
        np.float64,
    )


@dataclass
class Lattice:
    """Candidates of one zone as ``(first unit, end unit)`` with their features."""

    bounds: list[int]
    spans: list[tuple[int, int]]
    table: np.ndarray


def lattice(zone: str) -> Lattice:
    units = [m.span() for m in UNIT.finditer(zone)]
    bounds = [u[0] for u in units] + [len(zone)]
    spans = []
    for i, (a, _) in enumerate(units):
        if not (zone[a].isalnum() or zone[a] in "+("):
            continue
        for j in range(i + 1, min(len(units), i + MOST_UNITS) + 1):
            last = zone[bounds[j] - 1]
            if last.isalnum() and bounds[j] - a >= 7:
                spans.append((i, j))
    table = np.array([features(zone, bounds[i], bounds[j]) for i, j in spans]).reshape(len(spans), len(FEATURES))
    return Lattice(bounds, spans, table)


class Field:
    """Weights ``(kind, feature)``; units outside of spans score nothing."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def decode(self, zone: str) -> list[tuple[int, int, int]]:
        """The best segmentation's spans as ``(kind, start, end)``."""
        grid = lattice(zone)
        if not grid.spans:
            return []
        scores = grid.table @ self.weights.T
        kind, top = scores.argmax(axis=1), scores.max(axis=1)
        n = len(grid.bounds) - 1
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j) in enumerate(grid.spans):
            ending[j].append(k)
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for k in ending[j]:
                value = best[grid.spans[k][0]] + top[k]
                if value > best[j]:
                    best[j], back[j] = value, k
        found, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                i = grid.spans[back[j]][0]
                found.append((int(kind[back[j]]), grid.bounds[i], grid.bounds[j]))
                j = i
        return found[::-1]


def likelihood(grid: Lattice, gold: dict[tuple[int, int], int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Log-likelihood of the gold spans and its gradient, by forward and backward sums."""
    n = len(grid.bounds) - 1
    scores = grid.table @ weights.T
    whole = np.logaddexp.reduce(scores, axis=1)
    ahead, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = back[n] = 0.0
    by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
    for k, (i, j) in enumerate(grid.spans):
        by_end[j].append(k)
        by_start[i].append(k)
    for j in range(1, n + 1):
        ways = [ahead[j - 1], *(ahead[grid.spans[k][0]] + whole[k] for k in by_end[j])]
        ahead[j] = np.logaddexp.reduce(ways)
    for i in range(n - 1, -1, -1):
        ways = [back[i + 1], *(back[grid.spans[k][1]] + whole[k] for k in by_start[i])]
        back[i] = np.logaddexp.reduce(ways)
    first, last = (np.array([s[x] for s in grid.spans]) for x in (0, 1))
    chance = np.exp(ahead[first][:, None] + scores + back[last][:, None] - ahead[n])
    gain, value = -chance, -ahead[n]
    for k, span in enumerate(grid.spans):
        if span in gold:
            gain[k, gold[span]] += 1
            value += scores[k, gold[span]]
    return value, gain.T @ grid.table


def written_otherwise(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A generated zone: a kind in another notation, or numbers of no kind."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 9)))
    case = rng.randrange(9)
    if case == 0:
        at, dot = rng.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("[at]", "."), ("(at)", ".")])
        text = f"{w()}.{d(2)}{at}{w()}{dot}{rng.choice(['com', 'org', 'net'])}"
        return text, [(0, 0, len(text))]
    if case == 1:
        text = rng.choice(["{}[.]{}[.]{}[.]{}", "{}(.){}(.){}(.){}"]).format(*(rng.randrange(256) for _ in range(4)))
        return text, [(1, 0, len(text))]
    if case == 2:
        body = "4" + d(14)
        digits = next(body + c for c in "0123456789" if luhn(body + c))
        sign = rng.choice([".", "/", "  "])
        text = sign.join(digits[i : i + 4] for i in range(0, 16, 4))
        return text, [(2, 0, len(text))]
    if case in (3, 4):
        text = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}) {} {}"]).format(d(3), d(3), d(4))
        return text, [(3, 0, len(text))]
    if case == 5:
        return d(rng.choice([7, 8, 9, 11, 12, 14, 16, 20, 24])), []
    if case == 6:
        return f"{d(4)}-{d(2)}-{d(2)} {d(2)}.{d(2)}", []
    if case == 7:
        return rng.choice(["{}.{}.{}", "{} {} {} {} {}", "{}/{}/{}"]).format(*(d(rng.randint(1, 5)) for _ in range(5))), []
    return f"{w()}@{w()}", []


def fit(zone_texts: list[str], seed: int = 11, generated: int = 500, rounds: int = 40, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Weights from labelled zones, by full gradients with momentum."""
    rng = random.Random(seed)
    made = [(z, [s for s in base_spans(z)]) for z in zone_texts] + [written_otherwise(rng) for _ in range(generated)]
    data = []
    for zone, spans in made:
        grid = lattice(zone)
        at = {b: i for i, b in enumerate(grid.bounds)}
        gold, free = {}, 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            key = (at.get(a), at.get(b))
            if a >= free and key in set(grid.spans):
                gold[key], free = kind, b
        if grid.spans:
            data.append((grid, gold))
    weights, speed = np.zeros((len(KINDS), len(FEATURES))), 0.0
    weights[:, 0] = -2.0
    for _ in range(rounds):
        gradient = sum(likelihood(grid, gold, weights)[1] for grid, gold in data) / len(data) - decay * weights
        speed = 0.8 * speed + rate * gradient
        weights = weights + speed
    return Field(weights)


def training_zones(docs: DataFrame, id_column: str, text_column: str, sample_rows: int) -> list[str]:
    """Up to four zones of each of the ``sample_rows`` rows of least hash."""
    ids = hash_sample(docs, id_column, sample_rows)

    def cut(rows):
        for (text,) in rows:
            for start, end in zones(text or "")[:4]:
                if end - start <= 200:
                    yield ((text[start:end]),)

    chosen = docs.join(F.broadcast(ids), id_column, "left_semi").select(text_column)
    return sorted({r[0] for r in map_rows(chosen, "zone string", cut).collect()})


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and those with the field's additions, by kind, then start."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for low, high in zones(text):
        if any(a <= low and high <= b for a, b in taken):
            continue
        for kind, a, b in field.decode(text[low:high]):
            if all(low + b <= x or y <= low + a for x, y in taken):
                added.append((kind, low + a, low + b))
    return base, sorted(base + added)


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = 4000, field: Field | None = None
) -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row.

    Counts and the SHA-256 are of the base spans; ``spans`` has those and the
    field's, as ``kind:start:end`` in code points. Null counts as empty text.
    Repeated rows and null ids are kept; other columns are not read.
    """
    model = field or fit(training_zones(docs, id_column, text_column, sample_rows))

    def rows(incoming: Iterator[tuple]):
        for key, text in incoming:
            base, spans = all_spans(text or "", model)
            counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
            yield key, *counts, hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(docs.select(id_column, text_column), schema, rows)
