"""Packing into training sequences by lexical retrieval.

A document is its token ids and an end id. Every full window of it is a
sequence of its own; the rest, its tail, is packed. Tails are range-partitioned
by a minimum hash of their ids, so that alike documents come near each other,
and cut into shards of bounded size. A shard is indexed as BM25 postings; a
seed tail opens a window, its best unused neighbours are retrieved and fill
it, and the last of them is cut where the window ends. Tails that end a shard
in a window not yet full go to a second round over all shards.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import map_rows
from creditweave.llm.token_counts import encoder, special_strings
from creditweave.session import cut_lineage

# Fixed value: the pre-token pattern of the word-end vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
# Texts with other characters are encoded whole: their normal forms, lower case
# or white space may not be what Python takes them for.
UNCOMMON = re.compile("[^\x00-\x1b\x20-ɏ‐-‧Ạ-ỹ]")
SEPARATORS = "\x1c\x1d\x1e\x1f"
LONGEST_KEPT, CACHE_SIZE = 64, 250_000
# A tail is cut at multiples of so many ids.
GRID = 32
WINDOW = 4096
SHARD_ROWS = 2000
# Beyond so many shards, a task packs several of them one after the other.
MOST_TASKS = 20_000
QUERY_TERMS = 16
NEIGHBOURS = 64
# BM25's usual constants.
K1, B = 1.2, 0.75


# -- ids -----------------------------------------------------------------------


class Kept(dict):
    """Values made once and remembered for short keys.

    When ``CACHE_SIZE`` are held they become the older half, from which what is
    still asked for comes back.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= CACHE_SIZE:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def byte_signs() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: itself if it prints, else the next one from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printing]
    return {b: b for b in printing} | {b: 256 + k for k, b in enumerate(others)}


class Ids:
    """Little-endian ids of texts, by remembered words and pre-tokens.

    No pre-token has white space in it, so that the words between it can be
    encoded each for itself.
    """

    def __init__(self, path: str):
        self.encoder = encoder(path)
        self.model, self.signs = self.encoder.model, byte_signs()
        special = special_strings(self.encoder)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PRE_TOKEN)
        self.pieces = Kept(self._merge)
        self.words = Kept(lambda word: b"".join(map(self.pieces.__getitem__, self.pattern.findall(word))))

    def _merge(self, piece: str) -> bytes:
        """Ids of one pre-token in normal form, by the merges alone."""
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.signs))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode(self, text: str) -> bytes:
        return np.array(self.encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        """Ids of a whole text, as the tokenizer gives them."""
        if text.isascii():
            rare = any(c in text for c in SEPARATORS)
        else:
            rare = UNCOMMON.search(text) is not None
        if rare or (self.special and self.special.search(text)):
            return self._encode(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.words.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def ids_of_worker(path: str) -> Ids:
    """What a worker process has remembered serves all tasks it runs."""
    return Ids(path)


# -- checksums of cut pieces ------------------------------------------------------


@lru_cache(maxsize=256)
def _shift(length: int) -> list[list[int]]:
    """Tables that carry a CRC-32 over ``length`` more bytes."""
    bits = []
    for i in range(32):
        c = 1 << i
        for _ in range(8 * length):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        bits.append(c)
    tables = []
    for byte in range(4):
        table = [0] * 256
        for v in range(256):
            for b in range(8):
                if v >> b & 1:
                    table[v] ^= bits[8 * byte + b]
        tables.append(table)
    return tables


def joined_crc(left: int, right: int, right_bytes: int) -> int:
    """CRC-32 of two strings on end, from theirs."""
    a, b, c, d = _shift(right_bytes)
    return a[left & 255] ^ b[left >> 8 & 255] ^ c[left >> 16 & 255] ^ d[left >> 24] ^ right


def grid_crcs(ids: bytes) -> bytes:
    """CRC-32 of each ``GRID`` ids, the last of what is left."""
    step = 4 * GRID
    return np.array([zlib.crc32(ids[i : i + step]) for i in range(0, len(ids), step)], "<u4").tobytes()


def piece_crc(crcs: np.ndarray, length: int, start: int, take: int) -> int:
    """CRC-32 of ``take`` ids at ``start`` of a tail of ``length``; both ends lie on the grid or at its end."""
    crc = 0
    for k in range(start // GRID, -(-(start + take) // GRID)):
        crc = joined_crc(crc, int(crcs[k]), 4 * min(GRID, length - k * GRID))
    return crc


# -- shards ----------------------------------------------------------------------


class Shard:
    """BM25 postings over the tails of one shard, each with what is left of it."""

    def __init__(self, tails: list[tuple]):
        self.tails = tails
        terms = [np.frombuffer(t[5], "<u2").reshape(-1, 2) for t in tails]
        owner = np.repeat(np.arange(len(tails)), [len(t) for t in terms])
        both = np.concatenate(terms) if terms else np.empty((0, 2), np.uint16)
        order = np.argsort(both[:, 0], kind="stable")
        self.term, self.owner = both[order, 0], owner[order]
        count = both[order, 1].astype(np.float64)
        size = np.array([t[3] for t in tails], np.float64)
        self.vocabulary, self.first, df = np.unique(self.term, return_index=True, return_counts=True)
        self.last = self.first + df
        self.idf = np.log1p((len(tails) - df + 0.5) / (df + 0.5))
        slot = np.repeat(np.arange(len(df)), df)
        self.weight = self.idf[slot] * count * (K1 + 1) / (count + K1 * (1 - B + B * size[self.owner] / max(1.0, size.mean())))
        self.terms = terms

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused tails that share the seed's most telling terms, best first."""
        mine = np.searchsorted(self.vocabulary, self.terms[seed][:, 0])
        telling = mine[np.argsort(-self.idf[mine] * self.terms[seed][:, 1], kind="stable")[:QUERY_TERMS]]
        spans = [slice(self.first[t], self.last[t]) for t in telling]
        if not spans:
            return np.empty(0, np.int64)
        owners = np.concatenate([self.owner[s] for s in spans])
        scores = np.bincount(owners, np.concatenate([self.weight[s] for s in spans]), len(self.tails))
        found = np.flatnonzero((scores > 0) & unused)
        return found[np.argsort(-scores[found], kind="stable")[:NEIGHBOURS]]

    def windows(self) -> Iterator[list[tuple[int, int, int]]]:
        """``(tail, start, length)`` lists of at most ``WINDOW`` ids each."""
        start = np.array([t[2] for t in self.tails], np.int64)
        left = np.array([t[3] for t in self.tails], np.int64)
        for seed in range(len(self.tails)):
            if not left[seed]:
                continue
            window, room = [], WINDOW

            def place(tail: int, room: int) -> int:
                take = int(left[tail]) if left[tail] <= room else room // GRID * GRID
                if take:
                    window.append((tail, int(start[tail]), take))
                    start[tail] += take
                    left[tail] -= take
                return room - take

            room = place(seed, room)
            if room >= GRID:
                near = self.neighbours(seed, left > 0)
                # Whole neighbours first, then the best of the rest is cut.
                for fits in (True, False):
                    for tail in near:
                        if room >= GRID and left[tail] and (left[tail] <= room) == fits:
                            room = place(tail, room)
            # Nothing alike is left: fill up with the next tails in order.
            later = seed + 1
            while room >= GRID and later < len(left):
                if left[later]:
                    room = place(later, room)
                later += 1
            yield window


def _term_counts(ids: np.ndarray) -> bytes:
    """``(term, count)`` pairs of a tail's ids, by term."""
    ordered = np.sort(ids.astype("<u2"))
    starts = np.empty(len(ordered), bool)
    starts[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=starts[1:])
    first = np.flatnonzero(starts)
    out = np.empty((len(first), 2), "<u2")
    out[:, 0] = ordered[first]
    out[:-1, 1] = first[1:] - first[:-1]
    out[-1:, 1] = len(ordered) - first[-1:]
    return out.tobytes()


def tokenized(docs: DataFrame, path: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """One row per document: CRCs of its full windows, and its tail with CRCs, terms and a sketch."""

    def rows(incoming):
        ids_of = ids_of_worker(path)
        end = np.array([end_id], "<u4").tobytes()
        task, n = TaskContext.get().partitionId(), 0
        for key, text in incoming:
            blob = ids_of.of(text or "") + end
            total = len(blob) // 4
            full = total // WINDOW
            crcs = [zlib.crc32(blob[4 * WINDOW * k : 4 * WINDOW * (k + 1)]) for k in range(full)]
            tail = blob[4 * WINDOW * full :]
            ids = np.frombuffer(tail, "<u4")
            # Least of the ids' scattered values: equal for alike tails.
            sketch = int((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).min()) if len(ids) else 0
            yield key, total, crcs, (task << 36) + n, full * WINDOW, len(ids), grid_crcs(tail), _term_counts(ids), sketch
            n += max(1, full)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"doc {kind}, doc_tokens long, full array<long>, first_sequence long, tail_start long, tail_length long, "
        "crcs binary, terms binary, sketch long"
    )
    return map_rows(docs.select(id_column, text_column), schema, rows, batch=500)


def _pack_round(tails: DataFrame, number: int, partitions: int, last: bool) -> DataFrame:
    """Pieces with their sequence; before the ``last`` round, those of short windows have none."""

    def rows(incoming):
        task, sequence = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def closed():
            nonlocal sequence
            shard = Shard(held)
            for window in shard.windows():
                short = not last and WINDOW - sum(w[2] for w in window) >= GRID
                name = None if short else (number << 58) + (task << 36) + sequence
                sequence += 1
                offset = 0
                for tail, start, take in window:
                    doc, tokens, _, length, crcs, terms, whole = held[tail][:7]
                    at = start - whole[0]
                    crc = piece_crc(np.frombuffer(crcs, "<u4"), whole[1], at, take)
                    spare = (crcs, terms) if short else (None, None)
                    yield doc, start, take, crc, tokens, name, offset, *spare, whole[0], whole[1]
                    offset += take

        for doc, tokens, start, length, crcs, terms, origin, whole in incoming:
            held.append((doc, tokens, start, length, crcs, terms, (origin, whole)))
            if len(held) >= SHARD_ROWS:
                yield from closed()
                held = []
        if held:
            yield from closed()

    kind = tails.schema["doc"].dataType.simpleString()
    schema = (
        f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "crcs binary, terms binary, origin long, whole long"
    )
    dealt = tails.repartitionByRange(partitions, "sketch", "doc", "start").sortWithinPartitions("sketch", "doc", "start")
    return map_rows(dealt.drop("sketch"), schema, rows, batch=500)


def pack(
    docs: DataFrame, path: str, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Pieces ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Each id of each document, its end id included, lies in exactly one piece;
    pieces of a sequence are gapless from offset 0 and fill ``WINDOW`` ids at
    most. Null text is empty: its end id alone. Repeated rows are packed each
    for itself, null ids too; other columns are not read. An empty table has
    no pieces.
    """
    rows = cut_lineage(tokenized(docs, path, end_id, id_column, text_column))
    full = rows.select(
        "doc", "doc_tokens", "first_sequence", F.posexplode("full").alias("k", "ids_crc32")
    ).select(
        "doc", (F.col("k") * WINDOW).cast("long").alias("start"), F.lit(WINDOW).cast("long").alias("length"), "ids_crc32",
        "doc_tokens", (F.col("first_sequence") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    tails = rows.where("tail_length > 0").select(
        "doc", "doc_tokens", F.col("tail_start").alias("start"), F.col("tail_length").alias("length"), "crcs", "terms",
        F.col("tail_start").alias("origin"), F.col("tail_length").alias("whole"), "sketch",
    )
    parts = [full]
    columns = full.columns
    for number in (1, 2):
        shards = max(1, -(-tails.count() // SHARD_ROWS))
        partitions = min(shards, MOST_TASKS)
        packed = cut_lineage(_pack_round(tails, number, partitions, last=number == 2))
        parts.append(packed.where("sequence_id is not null").select(columns))
        tails = packed.where("sequence_id is null").select(
            "doc", "doc_tokens", "start", "length", "crcs", "terms", "origin", "whole", F.col("offset").alias("sketch")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumnRenamed("doc", id_column)
