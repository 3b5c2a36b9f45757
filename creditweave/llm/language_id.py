"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a segment, a run of bytes between white space,
in both directions and labels every byte with a probability per language.
A document's probabilities are the mean over all its bytes. A segment is
labelled once per worker and remembered, as texts repeat their words.

Training runs in numpy by backpropagation through time, on a bounded sample
of the labelled rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from creditweave.llm.common import map_rows
from creditweave.session import cut_lineage

UNKNOWN = "und"
# Unicode category L: numerals that are no digits, like circled or halved ones, are not letters.
LETTER = regex.compile(r"\p{L}")
HASHES = 1_000_000_007


@dataclass(frozen=True)
class Params:
    """Bounds of the training sample, and the network's shape."""

    # Rows and distinct segments of each language that are learnt from at most.
    sample_rows: int = 500
    sample_segments: int = 5000
    longest_segment: int = 24
    hidden: int = 12
    epochs: int = 12
    batch: int = 256
    rate: float = 0.01
    seed: int = 7
    # Segments a worker remembers, and bytes of text it handles at a time.
    cache_size: int = 300_000
    chunk_bytes: int = 2_000_000


def segments(text: str, longest: int) -> list[bytes]:
    """Lower-cased bytes between ASCII white space, with a space in front, cut at ``longest``."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if max(map(len, words), default=0) < longest:
        return [b" " + w for w in words]
    return [b" " + w[i : i + longest - 1] for w in words for i in range(0, len(w), longest - 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two gated recurrent layers, one per direction, and a softmax over both."""

    def __init__(self, languages: list[str], hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.languages, self.hidden = languages, hidden
        self.weights = {
            "in_ahead": scale(256, 3 * hidden),
            "in_back": scale(256, 3 * hidden),
            "state_ahead": scale(hidden, 3 * hidden),
            "state_back": scale(hidden, 3 * hidden),
            "out": scale(2 * hidden, len(languages)),
            "bias": np.zeros(len(languages), np.float32),
        }

    def _run(self, way: str, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, batch, hidden) of one direction over ``data`` (batch, time)."""
        h, rows = self.hidden, data.shape[0]
        inputs, recur = self.weights[f"in_{way}"], self.weights[f"state_{way}"]
        state = np.zeros((rows, h), np.float32)
        out = np.empty((data.shape[1], rows, h), np.float32)
        steps = range(data.shape[1]) if way == "ahead" else range(data.shape[1] - 1, -1, -1)
        for t in steps:
            x, u = inputs[data[:, t]], state @ recur
            gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, z, r, new, u[:, 2 * h :]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(axis=-1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=-1, keepdims=True)

    def label(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (time, batch, language) of every byte of equally long segments."""
        return self._softmax(np.concatenate([self._run("ahead", data), self._run("back", data)], axis=2))

    def gradients(self, data: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted cross-entropy of all bytes, and its gradient through time."""
        h, kept = self.hidden, {"ahead": [], "back": []}
        states = np.concatenate([self._run(way, data, kept[way]) for way in kept], axis=2)
        p = self._softmax(states)
        rows = np.arange(len(target))
        loss = float(-(np.log(p[:, rows, target] + 1e-9) * weight).sum())
        wrong = p.copy()
        wrong[:, rows, target] -= 1
        wrong *= weight[:, None]
        grads = {
            "out": np.tensordot(states, wrong, ([0, 1], [0, 1])),
            "bias": wrong.sum(axis=(0, 1)),
        }
        into = wrong @ self.weights["out"].T
        for way, part in (("ahead", into[:, :, :h]), ("back", into[:, :, h:])):
            recur = self.weights[f"state_{way}"]
            d_in = np.zeros_like(self.weights[f"in_{way}"])
            d_recur, d_state = np.zeros_like(recur), np.zeros((len(target), h), np.float32)
            for t, before, z, r, new, u in reversed(kept[way]):
                d = part[t] + d_state
                d_z = d * (before - new) * z * (1 - z)
                d_new = d * (1 - z) * (1 - new * new)
                d_r = d_new * u * r * (1 - r)
                through = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_in, data[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
                d_recur += before.T @ through
                d_state = d * z + through @ recur.T
            grads[f"in_{way}"], grads[f"state_{way}"] = d_in, d_recur
        return loss, grads


def train(examples: list[tuple[bytes, str, int]], params: Params) -> Network:
    """Fit to ``(segment, language, count)``; each language weighs the same in all."""
    languages = sorted({lang for _, lang, _ in examples})
    net = Network(languages, params.hidden, params.seed)
    total = Counter()
    for segment, lang, n in examples:
        total[lang] += n * len(segment)
    by_length = defaultdict(list)
    for segment, lang, n in sorted(examples):
        by_length[len(segment)].append((segment, languages.index(lang), n / total[lang]))
    batches = []
    for group in by_length.values():
        data = np.frombuffer(b"".join(g[0] for g in group), np.uint8).reshape(len(group), -1)
        target, weight = np.array([g[1] for g in group]), np.array([g[2] for g in group], np.float32)
        # Frequent words must not drown the rest.
        weight = np.sqrt(weight)
        mixed = np.random.default_rng(params.seed).permutation(len(group))
        for i in range(0, len(group), params.batch):
            some = mixed[i : i + params.batch]
            batches.append((data[some], target[some], weight[some]))
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    rng, step = np.random.default_rng(params.seed + 1), 0
    for epoch in range(params.epochs):
        rate = params.rate * (1 - epoch / params.epochs)
        for i in rng.permutation(len(batches)):
            data, target, weight = batches[i]
            _, grads = net.gradients(data, target, weight / (weight.sum() * data.shape[1]))
            step += 1
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                fixed = np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                net.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / fixed
    return net


class Labeller:
    """Pools a network's labels, remembering the segments it has read."""

    def __init__(self, net: Network, params: Params):
        self.net, self.params = net, params
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.sums = np.empty((0, len(self.net.languages)))

    def _learn(self, new: list[bytes]) -> None:
        if len(self.place) + len(new) > self.params.cache_size:
            self._forget()
        by_length = defaultdict(list)
        for s in new:
            by_length[len(s)].append(s)
        sums = [self.sums]
        for group in by_length.values():
            for i in range(0, len(group), 4096):
                some = group[i : i + 4096]
                data = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1)
                sums.append(self.net.label(data).sum(axis=0, dtype=np.float64))
                for s in some:
                    self.place[s] = len(self.place)
        self.sums = np.concatenate(sums)

    def pool(self, texts: list[str]) -> list[np.ndarray]:
        """Mean probabilities of all bytes of each text; zeros for a text without any."""
        cut = [segments(t, self.params.longest_segment) for t in texts]
        wanted = set().union(*cut)
        new = [s for s in wanted if s not in self.place]
        if len(self.place) + len(new) > self.params.cache_size:
            self._forget()
            new = list(wanted)
        if new:
            self._learn(sorted(new))
        out = []
        for parts in cut:
            at = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
            n = sum(map(len, parts))
            out.append(self.sums[at].sum(axis=0) / n if n else np.zeros(len(self.net.languages)))
        return out


def training_examples(labelled: DataFrame, params: Params, id_column: str, text_column: str, lang_column: str) -> list:
    """Segments of the sampled rows with their counts, the most frequent ones of each language.

    The sample is the ``sample_rows`` rows of least hash of each language,
    however rare it is; only their segments leave the executors,
    ``sample_segments`` a language at most.
    """
    hashed = F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(HASHES))
    rows_ = labelled.select(F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), hashed.alias("hash"))
    sizes = rows_.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # A share of the hashes that holds about twice as many goes first, so that few rows leave their tasks.
    near = rows_.join(sizes, "lang").where(F.col("hash") <= F.lit(2.0 * params.sample_rows * HASHES) / F.col("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "id"))
    ids = cut_lineage(near.withColumn("place", place).where(F.col("place") <= params.sample_rows).select(F.col("id").alias(id_column)).distinct())

    def tally(rows):
        seen = Counter()
        for text, lang in rows:
            seen.update((s, lang) for s in segments(text or "", params.longest_segment))
            if len(seen) > 500_000:
                yield from ((s, lang, n) for (s, lang), n in seen.items())
                seen.clear()
        yield from ((s, lang, n) for (s, lang), n in seen.items())

    # Spark sends the ids to all tasks as long as their file is small.
    chosen = labelled.join(ids, id_column, "left_semi").select(text_column, lang_column)
    counts = map_rows(chosen, "segment binary, lang string, n long", tally).groupBy("segment", "lang").agg(F.sum("n").alias("n"))
    often = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "segment"))
    top = counts.withColumn("place", often).where(F.col("place") <= params.sample_segments)
    return [(bytes(r[0]), r[1], r[2]) for r in top.select("segment", "lang", "n").collect()]


def identify(
    docs: DataFrame,
    params: Params = Params(),
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    held_out: Column | None = None,
) -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row.

    ``held_out`` marks rows that are not learnt from, by default those whose
    id, as text, has a CRC-32 divisible by five. Learning uses text and
    language of the others. Null text and text without a letter, and every
    text if nothing could be learnt, is ``und`` with score zero. Repeated rows
    and null ids (never learnt from) are kept; other columns are not read.
    """
    labels = labelled_rows(docs, params, id_column, text_column, lang_column, held_out)
    return labels.select(F.col(f"row.{id_column}").alias(id_column), "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, least_score: float, params: Params = Params(), text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``, all columns as they were."""
    labels = labelled_rows(docs, params, text_column=text_column, carry=docs.columns)
    return labels.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")


def labelled_rows(
    docs: DataFrame,
    params: Params,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    held_out: Column | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """``(row, held_out, lang_pred, score)``; ``row`` has the columns to ``carry``, or the id."""
    if held_out is None:
        held_out = F.crc32(F.col(id_column).cast("string")) % 5 == 0
    labelled = docs.where(~held_out & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    examples = training_examples(labelled, params, id_column, text_column, lang_column)
    net = train(examples, params) if examples else None
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def rows(incoming):
        net = shared.value
        labeller = Labeller(net, params) if net else None
        held: list[tuple] = []
        size = 0

        def flush():
            known = [bool(net) and LETTER.search(text) is not None for _, _, text in held]
            pooled = iter(labeller.pool([h[2] for h, k in zip(held, known) if k]) if any(known) else [])
            for (key, out, _), k in zip(held, known):
                if k:
                    p = next(pooled)
                    best = int(p.argmax())
                    yield key, out, net.languages[best], min(1.0, float(p[best]))
                else:
                    yield key, out, UNKNOWN, 0.0

        for key, out, text in incoming:
            held.append((key, out, text or ""))
            size += len(held[-1][2])
            if size >= params.chunk_bytes:
                yield from flush()
                held, size = [], 0
        yield from flush()

    row = F.struct(*[F.col(c) for c in carry or [id_column]])
    chosen = docs.select(row.alias("row"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_column)
    kind = T.StructType(chosen.schema["row"].dataType.fields)
    schema = T.StructType().add("row", kind).add("held_out", "boolean").add("lang_pred", "string").add("score", "double")
    return map_rows(chosen, schema, rows)
