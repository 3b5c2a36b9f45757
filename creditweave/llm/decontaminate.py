"""Benchmark passages in documents, found in suffix arrays of the documents.

Documents are laid end to end in shards of bounded size, as numbers of the
benchmark's words (zero for all others). A shard's word suffixes are sorted as
deep as a window is long; each distinct window of the benchmark is then
binary-searched in every shard. Its interval holds all places where it stands
verbatim, and places that follow one another in step give the longest passage
shared with an item. Everything happens where the documents are read: no text
and no window is shuffled.

The benchmark is sent to the tasks in blocks of bounded size; each block is one
pass over the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from creditweave.session import cut_lineage

# A-Z lower-cased; ASCII that is no letter or digit becomes a space. Bytes of
# other characters stay, so that UTF-8 need not be decoded.
_ASCII = bytes((c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() else 32) for c in range(128))
FOLD = _ASCII + bytes(range(128, 256))
WINDOW = 10
# Words of a shard; a longer document is a shard of its own.
SHARD_WORDS = 1_000_000
# Bytes of benchmark text that are broadcast at a time.
BLOCK_BYTES = 16_000_000


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of letters and digits, and of anything beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass
class Block:
    """Distinct windows of some items: words by number, and the items of each window."""

    vocabulary: dict[bytes, int]
    # One row per window, filled up with zeros; ``length`` are its words.
    windows: np.ndarray
    length: np.ndarray
    # Item rows of window i: ``items[first[i] : first[i + 1]]``, and the place of the window in each.
    first: np.ndarray
    items: np.ndarray
    places: np.ndarray
    names: list[str]

    @staticmethod
    def of(rows: list[tuple[object, str | None]], window: int) -> Block:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, (_, text) in enumerate(rows):
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + window]), []).append((item, i))
        names = ["null" if key is None else str(key) for key, _ in rows]
        length = np.fromiter(map(len, found), np.int64, len(found))
        windows = np.zeros((len(found), window), np.int64)
        for i, ids in enumerate(found):
            windows[i, : len(ids)] = ids
        sizes = np.fromiter(map(len, found.values()), np.int64, len(found))
        flat = np.array([p for ps in found.values() for p in ps], np.int64).reshape(-1, 2)
        return Block(vocabulary, windows, length, np.concatenate(([0], np.cumsum(sizes))), flat[:, 0], flat[:, 1], names)


def suffix_array(ids: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` ordered by the ``depth`` numbers that begin there; ``ids`` ends with ``depth`` zeros.

    Ranks of ever longer prefixes are made of ranks of shorter ones, by one
    sort a doubling. ``starts`` has to hold every place of a number other than
    zero that lies behind another start before a zero.
    """
    rank = np.zeros(len(ids), np.int64)
    order = starts
    # As many numbers as fit beside one another in the first key.
    bits = max(1, int(ids.max(initial=0)).bit_length())
    known = max(1, min(depth, 62 // bits))
    key = np.zeros(len(starts), np.int64)
    for i in range(known):
        key = (key << bits) | ids[starts + i]
    while True:
        by_key = np.argsort(key, kind="stable")
        order, key = starts[by_key], key[by_key]
        fresh = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        if known >= depth:
            return order
        rank[order] = np.cumsum(fresh)
        step = min(known, depth - known)
        key = rank[starts] * (len(starts) + 1) + rank[starts + step]
        known += step


def search(ids: np.ndarray, order: np.ndarray, windows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval of ``order`` where each window stands: first row and end.

    All windows are searched at once. A row compares by its words up to the
    window's length, so the ends of an interval are two such searches.
    """
    bounds = []
    for upper in (False, True):
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(order), np.int64)
        while True:
            going = np.flatnonzero(low < high)
            if not len(going):
                break
            middle = (low[going] + high[going]) // 2
            at = order[middle]
            undecided = np.arange(len(going))
            right = np.full(len(going), upper)
            for d in range(windows.shape[1]):
                undecided = undecided[length[going[undecided]] > d]
                if not len(undecided):
                    break
                own, wanted = ids[at[undecided] + d], windows[going[undecided], d]
                differs = own != wanted
                right[undecided[differs]] = (own < wanted)[differs]
                undecided = undecided[~differs]
            low[going[right]] = middle[right] + 1
            high[going[~right]] = middle[~right]
        bounds.append(low)
    return bounds[0], bounds[1]


class Shard:
    """Documents as numbers of the block's words, a zero behind each."""

    def __init__(self, texts: list[list[bytes]], block: Block):
        depth = block.windows.shape[1]
        number = block.vocabulary.get
        flat: list[int] = []
        ends = []
        for words in texts:
            flat.extend([number(w, 0) for w in words])
            flat.append(0)
            ends.append(len(flat))
        self.ids = np.concatenate((np.array(flat, np.int64), np.zeros(depth, np.int64)))
        self.ends = np.array(ends, np.int64)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))

    def matches(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """``(window, place)`` of every occurrence."""
        none = np.empty(0, np.int64)
        if not len(block.windows):
            return none, none
        starts = np.flatnonzero(self.ids)
        # Where fewer known words follow than the shortest window has, none can stand.
        zeros = np.flatnonzero(self.ids == 0)
        run = zeros[np.searchsorted(zeros, starts)] - starts
        order = suffix_array(self.ids, starts, block.windows.shape[1])
        able = np.zeros(len(self.ids), bool)
        able[starts[run >= block.length.min()]] = True
        order = order[able[order]]
        first, end = search(self.ids, order, block.windows, block.length)
        size = end - first
        window = np.repeat(np.arange(len(size)), size)
        return window, order[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def rows(self, block: Block) -> Iterator[tuple[list[tuple[int, int]], list[str], int]]:
        """Per document: spans of hit words, items found, words of the longest shared passage."""
        window, place = self.matches(block)
        hit = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(hit, place, 1)
        np.add.at(hit, place + block.length[window], -1)
        step = np.diff(np.concatenate(([0], (np.cumsum(hit) > 0).astype(np.int8))))
        begin, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        doc = np.searchsorted(self.ends, begin, side="right")
        spans: dict[int, list[tuple[int, int]]] = {}
        base = np.concatenate(([0], self.ends))
        for d, a, b in zip(doc.tolist(), (begin - base[doc]).tolist(), (stop - base[doc]).tolist()):
            spans.setdefault(d, []).append((a, b))
        items, longest = self._items(block, window, place)
        for d in range(len(self.sizes)):
            yield spans.get(d, []), items.get(d, []), longest.get(d, 0)

    def _items(self, block: Block, window: np.ndarray, place: np.ndarray) -> tuple[dict[int, list[str]], dict[int, int]]:
        """Each occurrence meets the items of its window, in lots of bounded size."""
        items: dict[int, set[int]] = {}
        longest: dict[int, int] = {}
        doc = np.searchsorted(self.ends, place, side="right")
        by_place = np.argsort(place, kind="stable")
        window, place, doc = window[by_place], place[by_place], doc[by_place]
        many = block.first[window + 1] - block.first[window]
        lot = np.cumsum(many) // 4_000_000
        # Lots end with documents, so that no passage is cut in two.
        lot = lot[np.searchsorted(doc, doc)] if len(doc) else lot
        for edge in np.unique(lot):
            of = np.flatnonzero(lot == edge)
            n = many[of]
            pick = np.repeat(block.first[window[of]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            item, at = block.items[pick], np.repeat(place[of], n)
            d, words = np.repeat(doc[of], n), np.repeat(block.length[window[of]], n)
            # Occurrences in step lie on one diagonal of document and item.
            diagonal = at - block.places[pick]
            order = np.lexsort((at, diagonal, item, d))
            d, item, diagonal, at, words = d[order], item[order], diagonal[order], at[order], words[order]
            fresh = np.ones(len(d), bool)
            fresh[1:] = (d[1:] != d[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
            first = np.flatnonzero(fresh)
            last = np.concatenate((first[1:], [len(d)])) - 1
            for k, i, n_words in zip(d[first].tolist(), item[first].tolist(), (at[last] + words[last] - at[first]).tolist()):
                items.setdefault(k, set()).add(i)
                longest[k] = max(longest.get(k, 0), n_words)
        return {k: sorted({block.names[i] for i in found}) for k, found in items.items()}, longest


def benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks that fit the driver and a broadcast."""
    spark = benchmark.sparkSession
    chosen = cut_lineage(benchmark.select(F.col(id_column).alias("item"), F.col(text_column).alias("text")).where("text is not null"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, blocks)))
    for b in range(blocks):
        yield spark.sparkContext.broadcast(Block.of([tuple(r) for r in chosen.where(dealt == b).collect()], window))


OUT = pa.schema(
    [
        ("row", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int64()),
    ]
)


def _scan(texts: DataFrame, block, shard_words: int, id_kind: str) -> DataFrame:
    """One pass of the documents over one block of the benchmark."""

    def flush(ids: list[pa.Array], words: list[list[bytes]]) -> pa.RecordBatch:
        rows = list(Shard(words, block.value).rows(block.value))
        columns = [
            pa.array([len(w) for w in words], pa.int64()),
            pa.array([[{"begin": a, "end": b} for a, b in r[0]] for r in rows], OUT.field("spans").type),
            pa.array([r[1] for r in rows], OUT.field("items").type),
            pa.array([r[2] for r in rows], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*ids)] + columns, ["row", "id", *OUT.names[1:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        words: list[list[bytes]] = []
        held = 0
        for batch in batches:
            row, key, text = batch.columns
            begin = 0
            for i in range(batch.num_rows):
                words.append(words_of(text[i].as_py()))
                held += len(words[-1]) + 1
                if held >= shard_words:
                    ids.append((row.slice(begin, i + 1 - begin), key.slice(begin, i + 1 - begin)))
                    yield flush(ids, words)
                    ids, words, held, begin = [], [], 0, i + 1
            if begin < batch.num_rows:
                ids.append((row.slice(begin), key.slice(begin)))
        if words:
            yield flush(ids, words)

    schema = f"row long, id {id_kind}, n_words long, spans array<struct<begin: long, end: long>>, items array<string>, longest long"
    return texts.mapInArrow(scan, schema)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(id, n_words, spans, n_hit, items, longest)`` of every row of ``docs``.

    Words are lower-cased in A-Z. A window is ``window`` consecutive words of
    an item, or the whole of a shorter one. ``spans`` are the maximal runs of
    words inside occurrences of windows (first word, end), ``items`` the names
    of items with such windows, sorted as strings, and ``longest`` the words of
    the longest passage that stands verbatim in an item and consists of
    windows. Null and empty texts have no words, on either side; an item
    without id is named ``null``. Repeated rows give repeated results, repeated
    items count once. Other columns are not read. Empty tables give no rows,
    or no hits.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    blocks = list(benchmark_blocks(benchmark, item_column, item_text_column, window, block_bytes))
    if not blocks:
        blocks = [spark.sparkContext.broadcast(Block.of([], window))]
    if len(blocks) > 1:  # rows keep their numbers from one pass to the next
        texts = cut_lineage(texts)
    passes = [_scan(texts, block, shard_words, kind) for block in blocks]
    found = passes[0] if len(passes) == 1 else _merged(passes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(F.col("id").alias(id_column), "n_words", "spans", n_hit.alias("n_hit"), "items", "longest")


def _merged(passes: list[DataFrame]) -> DataFrame:
    """Findings of several blocks as one, by row number: only findings are shuffled, never texts."""
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p.where("size(spans) > 0"))
    grouped = every.groupBy("row").agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("longest").alias("longest"),
    )
    empty = F.expr("cast(array() as array<struct<begin: bigint, end: bigint>>)")

    def joined(done, span):
        last = F.try_element_at(done, F.lit(-1))
        meets = (F.size(done) > 0) & (last["end"] >= span["begin"])
        grown = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(meets, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(done, F.array(F.struct(span["begin"].alias("begin"), span["end"].alias("end"))))
        )

    return grouped.withColumn("spans", F.aggregate("all", empty, joined)).drop("all")


def contamination(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id, n_words, n_hit, n_items, items_sha256, contaminated, longest)`` of what ``find_passages`` found."""
    joined = F.array_join("items", ",")
    return found.select(
        id_column, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "longest",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a word of a benchmark passage, all columns as they were.

    Rows that share an id go together; rows without id go if one of them is hit.
    """
    found = find_passages(docs, benchmark, id_column, text_column, **how)
    lost = cut_lineage(found.where("n_hit > 0").select(F.col(id_column).alias("_id")).distinct())
    return docs.join(lost, docs[id_column].eqNullSafe(lost["_id"]), "left_anti")
