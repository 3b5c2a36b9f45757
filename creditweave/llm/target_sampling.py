"""Documents drawn to be like a target text collection, by hashed word features.

Features are words and pairs of neighbours, counted in CRC-32 buckets. Bucket
totals of the documents and of the target give each bucket a gain, the mean
gain of a document's features is its weight, and Gumbel noise on the weights
draws without replacement: the highest sums win.

Hashing uses a head-tail vocabulary. Of frequent words the CRC state is
broadcast, so that the CRC of a pair goes on from its first word, and of
frequent pairs the bucket itself. Everything else, the tail, is hashed as it
comes. Both feed the same exact totals; the vocabulary decides about speed only.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import hash_sample, map_rows
from creditweave.llm.decontaminate import words_of
from creditweave.operators.ordering import numbered
from creditweave.session import cut_lineage

BUCKETS = 10_000
SHARE = 25  # of a hundred
LEAST_WORDS = 20
SEED = 7
# Rows the vocabulary is taken from, words and pairs it holds, and bytes of a word in it.
SAMPLE_ROWS = 2000
HEAD_WORDS = 16_384
HEAD_PAIRS = 65_536
LONGEST_KEPT = 40
# Features of the tail a worker remembers.
CACHE_SIZE = 200_000


@dataclass(frozen=True)
class Head:
    """Frequent words with their CRC states, and frequent pairs (by the places of their words) with buckets."""

    words: bytes
    states: np.ndarray
    pairs: np.ndarray
    buckets: np.ndarray

    @staticmethod
    def of(words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> Head:
        place = {w: i for i, w in enumerate(words)}
        inside = [(place[a], place[b], crc32(a + b" " + b) % buckets) for a, b in pairs if a in place and b in place]
        columns = np.array(inside, np.int64).reshape(-1, 3)
        states = np.fromiter(map(crc32, words), np.uint32, len(words))
        return Head(b" ".join(words), states, columns[:, :2].astype(np.uint16), columns[:, 2].astype(np.int32))


class States(dict):
    """CRC state of a word; the tail beyond the broadcast words is hashed and remembered for a while."""

    def __init__(self, words: list[bytes], states: list[int]):
        super().__init__(zip(words, states))
        self.most = len(self) + CACHE_SIZE

    def __missing__(self, word: bytes) -> int:
        state = crc32(word)
        if len(word) <= LONGEST_KEPT and len(self) < self.most:
            self[word] = state
        return state


class Pairs(dict):
    """Bucket of a pair: broadcast, or by a CRC that goes on from the first word's state."""

    def __init__(self, known: dict, states: States, buckets: int):
        super().__init__(known)
        self.states, self.buckets = states, buckets
        self.most = len(self) + CACHE_SIZE

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        first, second = pair
        bucket = crc32(second, crc32(b" ", self.states[first])) % self.buckets
        if len(first) + len(second) <= LONGEST_KEPT and len(self) < self.most:
            self[pair] = bucket
        return bucket


class Hasher:
    """Buckets of all features of a list of words."""

    def __init__(self, head: Head, buckets: int):
        words = head.words.split()
        self.buckets = buckets
        self.states = States(words, head.states.tolist())
        known = {(words[a], words[b]): n for (a, b), n in zip(head.pairs.tolist(), head.buckets.tolist())}
        self.pairs = Pairs(known, self.states, buckets)

    def features(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        if not n:
            return np.empty(0, np.uint16)
        out = np.empty(2 * n - 1, np.uint32)
        out[:n] = np.fromiter(map(self.states.__getitem__, words), np.uint32, n) % self.buckets
        out[n:] = np.fromiter(map(self.pairs.__getitem__, zip(words, words[1:])), np.uint32, n - 1)
        return out.astype(np.uint16)


def frequent_head(docs: DataFrame, id_column: str, text_column: str, buckets: int) -> Head:
    """The most frequent words and pairs of the ``SAMPLE_ROWS`` rows of least hash."""

    def tally(rows):
        one, two = Counter(), Counter()
        for (text,) in rows:
            words = [w for w in words_of(text) if len(w) <= LONGEST_KEPT]
            one.update(words)
            two.update(zip(words, words[1:]))
        yield from ((w, None, n) for w, n in one.most_common(HEAD_WORDS))
        yield from ((a, b, n) for (a, b), n in two.most_common(HEAD_PAIRS))

    ids = hash_sample(docs, id_column, SAMPLE_ROWS)
    sample = docs.join(F.broadcast(ids), id_column, "left_semi").select(text_column)
    counted = map_rows(sample, "a binary, b binary, n long", tally).groupBy("a", "b").agg(F.sum("n").alias("n"))
    # One task picks from the few tallies, so that no more than the head reaches the driver.
    counted = counted.coalesce(1)
    words = counted.where("b is null").orderBy(F.desc("n"), "a").limit(HEAD_WORDS).select("a").collect()
    pairs = counted.where("b is not null").orderBy(F.desc("n"), "a", "b").limit(HEAD_PAIRS).select("a", "b").collect()
    return Head.of([bytes(r.a) for r in words], [(bytes(r.a), bytes(r.b)) for r in pairs], buckets)


def hashed(texts: DataFrame, head, buckets: int) -> DataFrame:
    """``(id, n_words, n_features, features)``: buckets as packed 16-bit numbers, for ``(id, text)`` rows."""
    if not 0 < buckets <= 65_536:
        raise ValueError("buckets are numbered by 16 bits")

    def rows(incoming):
        hasher = Hasher(head.value, buckets)
        for key, text in incoming:
            words = words_of(text)
            found = hasher.features(words)
            yield key, len(words), len(found), found.tobytes()

    kind = texts.schema["id"].dataType.simpleString()
    return map_rows(texts, f"id {kind}, n_words long, n_features long, features binary", rows, batch=500)


def bucket_totals(features: DataFrame, buckets: int) -> np.ndarray:
    """Exact number of features in every bucket: one array a task, summed by bucket."""

    def rows(incoming):
        total = np.zeros(buckets, np.int64)
        for (packed,) in incoming:
            total += np.bincount(np.frombuffer(packed, np.uint16), minlength=buckets)
        full = np.flatnonzero(total)
        yield from zip(full.tolist(), total[full].tolist())

    counted = map_rows(features.select("features"), "bucket int, n long", rows).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # a row a bucket at most
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, target over source, cut down."""
    k, s, t = len(source), float(source.sum()), float(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + k) / ((x + 1.0) * (t + k)))) for x, y in pairs], np.int64)


def noise(key: object, seed: int) -> int:
    """Thousandths of a Gumbel draw that depends on seed and key alone, cut down."""
    digest = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def weighted(features: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` of every row."""

    def rows(incoming):
        for key, n_words, n_features, packed in incoming:
            total = int(gains[np.frombuffer(packed, np.uint16)].sum())
            weight = total // n_features if n_features else 0
            yield key, n_words, n_features, weight, weight + noise(key, seed)

    kind = features.schema["id"].dataType.simpleString()
    return map_rows(features, f"id {kind}, n_words long, n_features long, weight long, score long", rows)


def cutoff(eligible: DataFrame, n: int) -> int | None:
    """The ``n``-th highest score, from the counts of scores.

    Scores are whole and within some ten thousands of zero (logarithms of
    counts and of 32-bit draws), so their counts are a bounded table.
    """
    left = n
    for r in eligible.groupBy("score").count().orderBy(F.desc("score")).collect():
        left -= r["count"]
        if left <= 0:
            return r["score"]
    return None


def sample_like(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text_column: str = "text",
    buckets: int = BUCKETS,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every row of ``docs``.

    Words are lower-cased in A-Z. Of the N rows of at least ``least_words``
    words, ``share`` of a hundred (cut down) are drawn, those of the highest
    score, of equal ones those of smaller id; ``rank`` numbers them from one
    and is null for all others. Null and empty texts have no features and
    weight zero. Rows without id draw alike and come before ids at equal
    scores; repeated rows are drawn and ranked each for itself. Other columns
    are not read. Empty tables give no rows, or gains over nothing.
    """
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(frequent_head(docs, id_column, text_column, buckets))
    # Hashed once; the totals and the weights read two bytes a feature.
    features = cut_lineage(hashed(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), head, buckets))
    wanted = hashed(target.select(F.lit(None).cast("long").alias("id"), F.col(target_text_column).alias("text")), head, buckets)
    gains = bucket_gains(bucket_totals(features, buckets), bucket_totals(wanted, buckets))
    scored = weighted(features, gains, seed).withColumn("row", F.monotonically_increasing_id())
    scored = cut_lineage(scored)
    eligible = scored.where(F.col("n_words") >= least_words)
    drawn = share * eligible.count() // 100
    least = cutoff(eligible, drawn) if drawn else None
    # Only rows that may be drawn are put in order.
    rivals = eligible.where(F.col("score") >= least) if least is not None else eligible.where("false")
    ordered = rivals.select((-F.col("score")).alias("down"), "id", "row")
    ranks = numbered(ordered, ["down", "id", "row"], "rank", drawn).select(F.col("row").alias("_row"), "rank")
    return scored.join(ranks, F.col("row") == F.col("_row"), "left").select(
        F.col("id").alias(id_column), "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")
    )


def drawn_documents(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, all columns as they were."""
    ranked = sample_like(docs, target, id_column, text_column, **how)
    ids = ranked.where("rank is not null").select(F.col(id_column).alias("_id")).distinct()
    return docs.join(ids, docs[id_column].eqNullSafe(ids["_id"]), "left_semi")
