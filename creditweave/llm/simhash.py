"""SimHash near-copies by anchor-point covering.

A fingerprint's 64 bits are cut into three blocks; of two fingerprints that
differ in at most four bits, one block differs in at most one. Per block, the
words of a covering code are the anchors: every block lies within the covering
radius R of its home anchor, so a partner one bit away lies within R + 1 of
it. Each fingerprint is therefore sent to every anchor within R + 1, and
compared there with those that are at home.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import map_rows
from creditweave.llm.components import connected_components
from creditweave.session import cut_lineage

BLOCKS = ((0, 21), (21, 21), (42, 22))
# A block differs in at most so many bits in one of the blocks.
BLOCK_BITS = 1
LINK_BITS = 4
# Anchors with more fingerprints are dealt to several tasks.
ANCHOR_ROWS = 20_000
# Comparisons held at once.
PAIRS = 2_000_000
_LANES = np.uint64(0x0101010101010101)


# -- fingerprints --------------------------------------------------------------


def shingle_hashes(text: str | None, words_each: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words_each`` words, repeats included.

    Fewer words make one shingle of them all; no word makes none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(words_each, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], 42) for a, b in cuts), np.uint64, len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits; a bit is set where over half the hashes have it. None: zero."""
    n = len(hashes)
    if n == 0:
        return 0
    # Eight bit positions a byte apart are counted together, 255 hashes at a time.
    blocks = -(-n // 255)
    padded = np.zeros(blocks * 255, np.uint64)
    padded[:n] = hashes
    counts = np.empty(64, np.int64)
    for shift in range(8):
        lanes = ((padded >> np.uint64(shift)) & _LANES).reshape(blocks, 255).sum(axis=1, dtype=np.uint64)
        counts[shift::8] = lanes.view(np.uint8).reshape(blocks, 8).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_each: int = 4) -> DataFrame:
    """``(id, fp)``: the fingerprint as a signed long. Ids must be integers."""

    def rows(incoming):
        for key, text in incoming:
            value = fingerprint(shingle_hashes(text, words_each))
            yield key, value - (1 << 64) if value >> 63 else value

    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column)), "id long, fp long", rows)


# -- anchors ---------------------------------------------------------------------


class Covering:
    """The product of the Hamming code of 15 bits with ``length - 15`` free bits.

    Its words are the anchors: 2^11 times 2^(length - 15), covering radius 1.
    Error patterns up to radius + ``reach`` are tabled by syndrome, the nearest
    anchor's pattern first.
    """

    radius = 1

    def __init__(self, length: int, reach: int = BLOCK_BITS):
        self.columns = [i + 1 if i < 15 else 0 for i in range(length)]
        patterns: list[list[int]] = [[] for _ in range(16)]
        for weight in range(self.radius + reach + 1):
            for bits in combinations(range(length), weight):
                syndrome = 0
                for b in bits:
                    syndrome ^= self.columns[b]
                patterns[syndrome].append(sum(1 << b for b in bits))
        self.starts = np.cumsum([0] + [len(p) for p in patterns])
        self.patterns = np.array([e for p in patterns for e in p], np.int64)

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for bit, column in enumerate(self.columns):
            if column:
                out ^= ((words >> bit) & 1) * column
        return out

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index into ``words``, anchor, and whether it is that word's home."""
        syndromes = self.syndromes(words)
        sizes = np.diff(self.starts)[syndromes]
        index = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        anchor = words[index] ^ self.patterns[np.repeat(self.starts[syndromes], sizes) + place]
        return index, anchor, place == 0


def replicas(points: DataFrame) -> DataFrame:
    """``(anchor, fp, rep, home)``: every anchor of every fingerprint."""
    codes = {length: Covering(length) for _, length in BLOCKS}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 20_000):
                part = batch.slice(begin, 20_000)
                fp, rep = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for block, (shift, length) in enumerate(BLOCKS):
                    words = ((fp.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << length) - 1)).astype(np.int64)
                    index, anchor, home = codes[length].anchors(words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor | block << 32), pa.array(fp[index]), pa.array(rep[index]), pa.array(home)],
                        names=["anchor", "fp", "rep", "home"],
                    )

    return points.select("fp", "rep").mapInArrow(spread, "anchor long, fp long, rep long, home boolean")


def _forest(nodes: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Least index reachable from each of ``nodes`` over links ``a``-``b``."""
    label = np.arange(nodes) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _star(fp: np.ndarray, rep: np.ndarray, home: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over whole anchors, which begin at ``starts``.

    ``rep`` ascends within an anchor, so that the least index is the least id.
    """
    ends = np.append(starts[1:], len(fp))
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    homes = np.flatnonzero(home)
    sizes = (ends - starts)[owner[homes]]
    label = np.arange(len(fp))
    bounds = np.cumsum(sizes)
    begin = 0
    while begin < len(homes):
        base = bounds[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(bounds, base + PAIRS, side="right")))
        some, n = homes[begin:end], sizes[begin:end]
        left = np.repeat(some, n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[owner[some]], n)
        near = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= bits
        near &= label[left] != label[right]
        if near.any():
            label = _forest(len(fp), left[near], right[near], label)
        begin = end
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return rep[moved], rep[label[moved]]


def links(points: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """``(u, v)``: enough links to connect all fingerprints within ``bits``.

    Each anchor gives a spanning forest of its links, never all pairs. An
    anchor of many rows is dealt to several tasks by those at home in it; the
    others are repeated in each of its tasks.
    """
    if bits > LINK_BITS:
        raise ValueError("three blocks cover links of four bits at most")
    spread = replicas(points)
    crowded = spread.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ANCHOR_ROWS)
    shares = crowded.select("anchor", F.ceil(F.col("n") / ANCHOR_ROWS).cast("int").alias("shares"))
    salted = spread.join(shares, "anchor", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int"))
    # A member at home in one share is only compared against in the others.
    salted = salted.select(
        "anchor", "fp", "rep", "home", own[0].alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("salt"),
    ).withColumn("home", F.col("home") & (F.col("own") == F.col("salt")))
    dealt = (
        salted.select("anchor", "salt", "fp", "rep", "home")
        .repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt", "rep")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def whole(parts: list[np.ndarray]) -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*parts)]

        def emit(columns: list[np.ndarray], starts: np.ndarray) -> pa.RecordBatch:
            u, v = _star(columns[2], columns[3], columns[4], starts, bits)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        waiting, more = 0, 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            waiting, more = waiting + batch.num_rows, more + batch.num_rows
            if more < 50_000:
                continue
            more, columns = 0, whole(held)
            first = np.flatnonzero(_begins(columns))
            cut = first[-1]
            if cut:  # the last anchor may go on in the next batch
                yield emit([c[:cut] for c in columns], first[:-1])
            held = [[c[cut:] for c in columns]]
        if held:
            columns = whole(held)
            if len(columns[0]):
                yield emit(columns, np.flatnonzero(_begins(columns)))

    return dealt.mapInArrow(compare, "u long, v long")


def _begins(columns: list[np.ndarray]) -> np.ndarray:
    anchor, salt = columns[:2]
    return np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])))


def simhash_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = LINK_BITS, words_each: int = 4
) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row.

    Text is lower-cased in A-Z and cut at ASCII white space into words.
    Fingerprints link at ``bits`` or fewer differing bits; the component is
    the least id reachable over links. Null and empty text has fingerprint
    zero, linked like any other. Repeated rows give repeated results. Rows
    without id get the component of their fingerprint. Other columns are not
    read.
    """
    prints = cut_lineage(fingerprints(docs, id_column, text_column, words_each))
    # One point per fingerprint, however many copies have it.
    points = cut_lineage(prints.groupBy("fp").agg(F.min("id").alias("rep")))
    roots = connected_components(links(points.where("rep is not null"), bits))
    named = points.join(roots, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(named, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = LINK_BITS) -> DataFrame:
    """The rows of ``docs`` of the least id of each component, all columns as they were.

    Rows without id stay only if no row with an id is linked to them.
    """
    found = simhash_components(docs, id_column, text_column, bits)
    lost = found.where(~F.col(id_column).eqNullSafe(F.col("component_id"))).select(F.col(id_column).alias("_id"))
    return docs.join(lost, docs[id_column].eqNullSafe(lost["_id"]), "left_anti")
