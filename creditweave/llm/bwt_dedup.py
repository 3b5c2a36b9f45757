"""Repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``SPAN`` bytes over it also starts in a document
with a smaller id. The work is dealt so that equal strings meet in one task,
and most text, which repeats nothing, stays where it is:

1. Every string is named by its marker, the least hash of the ``MARK``-byte
   strings in it; equal strings have equal markers. Parts (documents of one
   scan task, ``PART_BYTES`` of text) exchange sorted lists of their markers,
   and learn which ones occur in more than one document.
2. Neighbouring strings of one repeated marker make a piece. A part's distinct
   pieces are dealt to buckets by marker, as the Burrows-Wheeler transform of
   a sorted collection: a shard.
3. A bucket merges its shards by refining their interleave, two symbols a round:
   rows that agree in so many symbols step back along their own transform to the
   suffixes that are two symbols longer, and are counted into order by these.
   No text is rebuilt and no suffix sorted again. An interval of one row is done,
   its common prefix known; intervals that remain at ``SPAN`` symbols are the
   repeated strings, and each gets the least id of its documents.
4. The ids go back to the parts, with the places of their pieces, and what is
   covered is removed.

A marker that very many pieces share is dealt by whole strings instead, so
that no bucket is larger than its share; equal strings still meet.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import map_rows
from creditweave.session import cut_lineage

SPAN = 50
MARK = 24
PART_BYTES = 16_000_000
BUFFER = 1 << 20
# Strings in one piece, at most, and symbols whose suffixes a part sorts at once:
# few enough for a core's own cache, whatever the other cores do.
PIECE = 64
LOT = 100_000
# Markers compared in one range, bytes of pieces in one bucket.
RANGE_MARKERS = 1_000_000
BUCKET_BYTES = 2_000_000
# Documents that make a marker crowded.
CROWDED = 4000
NO_ID = -(1 << 63)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
KEY_BITS = 40


# -- markers ---------------------------------------------------------------------


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Marker:
    """Markers of all strings of a buffer of documents laid end to end."""

    def __init__(self):
        n = BUFFER + SPAN + 1
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def _least(self, data: np.ndarray) -> np.ndarray:
        values = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)])))
        h = (values[MARK:] - values[:-MARK]) * self.down[: len(data) - MARK + 1]
        h = _mixed(h)
        width, step = SPAN - MARK + 1, 1
        while step * 2 <= width:
            h = np.minimum(h[:-step], h[step:])
            step *= 2
        return np.minimum(h[: len(h) - (width - step)], h[width - step :])

    def runs(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marker key, first start and number of starts of each run of equal markers within a document."""
        keys, firsts, counts = [], [], []
        for a in range(0, len(data) - SPAN + 1, BUFFER):
            least = self._least(data[a : a + BUFFER + SPAN - 1])[:BUFFER]
            start = np.arange(a, a + len(least))
            low, high = np.searchsorted(ends, [a, a + len(least) - 1], side="right")
            doc = np.repeat(np.arange(low, high + 1), np.diff(np.minimum(ends[low : high + 1], a + len(least)), prepend=a))
            inside = start + SPAN <= ends[doc]
            edge = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
            first = np.flatnonzero(np.concatenate(([True], edge)))
            count = np.diff(np.append(first, len(least)))
            good = inside[first]
            keys.append(least[first[good]])
            firsts.append(start[first[good]])
            counts.append(count[good])
        if not keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        # Least values crowd at the low end; mixed again they fill all ranges alike.
        return _mixed(np.concatenate(keys)) >> np.uint64(64 - KEY_BITS), np.concatenate(firsts), np.concatenate(counts)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


# -- packed columns ----------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, planes of equal significance together, compressed."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T) if len(a) else np.empty(0, np.uint8)
        out.append(struct.pack("<2sI", a.dtype.str[1:].encode(), len(a)) + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        kind, n = struct.unpack_from("<2sI", data, at)
        at += 6
        kind = np.dtype("<" + kind.decode())
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n) if n else np.empty(0, kind))
        at += n * kind.itemsize
    return out


def _ascending(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


# -- shards ------------------------------------------------------------------------


def _eights(symbols: np.ndarray) -> np.ndarray:
    """Eight symbols from each place, the first one most significant."""
    padded = np.concatenate((symbols, np.zeros(8, np.uint8)))
    out = np.zeros(len(symbols), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(symbols)]
    return out


def sorted_suffixes(eights: np.ndarray, stop: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Places of a text in the order of their suffixes, each block of places on its own.

    ``block`` numbers ascend. Each round takes some more symbols of the suffixes
    that agree with another one so far, as many as fit beside the number of
    their interval. Equal whole suffixes follow the text.
    """
    rows = np.arange(len(stop))
    order, block = rows.copy(), block.astype(np.uint64)
    width = max(1, min(8, (64 - len(order).bit_length()) // 8))
    bits = np.uint64(8 * width)
    # The first n symbols of a key.
    masks = np.array([((1 << 8 * n) - 1) << 8 * (width - n) for n in range(width + 1)], np.uint64)
    at = 0
    while len(rows):
        suffix = order[rows]
        left = np.minimum(stop[suffix] - suffix - at, width)
        key = (eights[np.minimum(suffix + at, len(eights) - 1)] >> (np.uint64(64) - bits)) & masks[np.maximum(left, 0)]
        if width < 8:
            key |= block << bits
        sort = np.argsort(key)
        order[rows], key, left = suffix[sort], key[sort], left[sort]
        opens = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(opens)
        size = np.diff(np.append(first, len(rows)))
        block = np.repeat(np.arange(len(first), dtype=np.uint64), size)
        tied = np.repeat(size > 1, size)
        ended = tied & (left < width)
        if ended.any():
            same = order[rows[ended]]
            order[rows[ended]] = same[np.lexsort((same, block[ended]))]
        tied &= left == width
        rows, block = rows[tied], block[tied]
        at += width
    return order


def transforms(shards: list[list[bytes]]) -> list[np.ndarray]:
    """Burrows-Wheeler transforms of collections of sorted, distinct strings.

    Symbols are bytes + 1, terminators 0 in the order of their strings. The
    suffixes of all collections are sorted together, each in its own interval.
    """
    pieces = [p for shard in shards for p in shard]
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    stop = np.cumsum(lengths + 1) - 1
    symbols = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
    sizes = [sum(map(len, shard)) + len(shard) for shard in shards]
    block = np.repeat(np.arange(len(shards)), sizes)
    order = sorted_suffixes(_eights(symbols), np.repeat(stop, lengths + 1), block)
    return np.split(np.concatenate((np.zeros(1, np.uint8), symbols))[order], np.cumsum(sizes)[:-1])


def backward(shards: list[np.ndarray]) -> np.ndarray:
    """Of each row of the transforms, laid end to end, the row of the suffix that is one symbol longer."""
    size, at = sum(map(len, shards)), 0
    back = np.empty(size, np.int32 if size < 1 << 31 else np.int64)
    for made in shards:
        back[at + np.argsort(made, kind="stable")] = np.arange(at, at + len(made))
        at += len(made)
    return back


def least_ids(shards: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray) -> np.ndarray:
    """For each string of ``SPAN`` in each piece, in order, the least id of all that are equal.

    ``shards`` are transforms with the lengths of their pieces, ``ids`` one per
    piece, shard by shard.
    """
    made, lengths = [t for t, _ in shards], np.concatenate([n for _, n in shards]).astype(np.int64)
    count = lengths - SPAN + 1
    begin = np.cumsum(count) - count
    back, symbols = backward(made), np.concatenate(made)
    offsets = np.cumsum([0] + [len(t) for t in made])
    # The rows at which strings end, read back from the terminators, a symbol a step.
    end = np.empty(count.sum(), back.dtype)
    row = np.concatenate([np.arange(o, o + len(n)) for o, (_, n) in zip(offsets, shards)])
    string, low = begin + count - 1, begin
    while len(row):
        end[string] = row
        going = string > low
        row, string, low = back[row[going]], string[going] - 1, low[going]
    # The interleave of no symbols: all rows agree, shard after shard in its own order.
    string = np.full(len(back), -1, back.dtype)
    string[end] = np.arange(len(end))
    row = np.flatnonzero(string >= 0)
    string, block = string[row], np.zeros(len(row), np.int32)
    before, further, depth = (symbols[back].astype(np.uint16) << 8) | symbols, back[back], 0
    while depth < SPAN and len(row):
        if SPAN - depth == 1:
            before, further = symbols, back
        key = before[row]
        sort = np.argsort(key, kind="stable")  # by counting, as keys are short
        key, block, row, string = key[sort], block[sort], further[row[sort]], string[sort]
        opens = np.concatenate(([True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])))
        tied = ~(opens & np.append(opens[1:], True))
        row, string, block = row[tied], string[tied], np.cumsum(opens[tied], dtype=np.int32)
        depth += 2
    out = np.repeat(ids, count)
    if len(string):
        first = np.flatnonzero(np.diff(block, prepend=0))
        out[string] = np.repeat(np.minimum.reduceat(out[string], first), np.diff(np.append(first, len(string))))
    return out


# -- parts -------------------------------------------------------------------------


def _end_to_end(docs: list[tuple[int | None, bytes]]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Texts of documents as one, their ids and where they end."""
    texts = [zstandard.ZstdDecompressor().decompress(z) for _, z in docs]
    ids = np.array([NO_ID if k is None else k for k, _ in docs], np.int64)
    return b"".join(texts), ids, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))


class Part:
    """Documents of one part laid end to end, and the pieces that hold repeated markers."""

    def __init__(self, docs: list[tuple[int | None, bytes]], buckets: int, known: list[bytes], marker: Marker):
        self.text, self.ids, self.ends = _end_to_end(docs)
        lists = [_unpack(b) for b in known]
        keys = np.concatenate([np.cumsum(k) for k, _ in lists]) if lists else np.empty(0, np.uint64)
        crowded = np.concatenate([c for _, c in lists]) if lists else np.empty(0, np.uint8)
        by_key = np.argsort(keys)
        keys, crowded = keys[by_key], crowded[by_key]
        key, first, count = marker.runs(np.frombuffer(self.text, np.uint8), self.ends)
        at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
        hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
        key, first, count, crowd = key[hit], first[hit], count[hit], crowded[at[hit]].astype(bool)
        # Runs are cut into pieces: single strings of crowded markers, else of PIECE strings.
        size = np.where(crowd, 1, PIECE)
        parts = -(-count // size)
        owner = np.repeat(np.arange(len(key)), parts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        self.first = first[owner] + place * size[owner]
        self.count = np.minimum(size[owner], count[owner] - place * size[owner])
        self.doc = np.searchsorted(self.ends, self.first, side="right")
        single, bucket = crowd[owner], (key[owner] % np.uint64(buckets)).astype(np.int64)
        text = self.text
        pieces = [text[a:b] for a, b in zip(self.first.tolist(), (self.first + self.count + SPAN - 1).tolist())]
        number = {piece: k for k, piece in enumerate(dict.fromkeys(pieces))}
        self.distinct = list(number)
        self.piece = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        self.bucket = np.empty(len(number), np.int64)
        self.bucket[self.piece] = bucket
        alone = np.zeros(len(number), bool)
        alone[self.piece] = single
        for k in np.flatnonzero(alone).tolist():
            self.bucket[k] = xxhash.xxh64_intdigest(self.distinct[k]) % buckets

    def shards(self) -> Iterator[tuple[int, list[int]]]:
        """Bucket and numbers of its pieces, in the order of their bytes."""
        dealt = defaultdict(list)
        for k, bucket in enumerate(self.bucket.tolist()):
            dealt[bucket].append(k)
        for bucket, numbers in sorted(dealt.items()):
            numbers.sort(key=self.distinct.__getitem__)
            yield bucket, numbers

    def extremes(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest document id of each piece."""
        low = np.full(len(self.distinct), np.iinfo(np.int64).max)
        high = np.full(len(self.distinct), NO_ID)
        np.minimum.at(low, self.piece, self.ids[self.doc])
        np.maximum.at(high, self.piece, self.ids[self.doc])
        return low, high

    def places(self, shards: list[tuple[int, list[int]]]) -> bytes:
        """Where pieces are, how many strings they have, and their ranks over all shards."""
        rank = np.empty(len(self.distinct), np.uint32)
        rank[[k for _, numbers in shards for k in numbers]] = np.arange(len(rank))
        buckets = np.array([b for b, _ in shards], np.int64)
        sizes = np.array([len(numbers) for _, numbers in shards], np.int64)
        return _pack(_ascending(self.first), self.count.astype(np.uint16), rank[self.piece], buckets, sizes)


def removed(ids: np.ndarray, ends: np.ndarray, places: bytes, found: dict[int, list[np.ndarray]]) -> np.ndarray:
    """Mask over a part's text, from each bucket's ``(rank of piece, least ids of its strings)``."""
    first, count, rank, buckets, sizes = _unpack(places)
    first, count = np.cumsum(first), count.astype(np.int64)
    strings = np.zeros(sizes.sum(), np.int64)
    strings[rank] = count
    begin = np.full(len(strings), -1, np.int64)
    values, at = [], 0
    for bucket, offset in zip(buckets.tolist(), (np.cumsum(sizes) - sizes).tolist()):
        if bucket in found:
            ranks, low = found[bucket]
            n = strings[offset + ranks.astype(np.int64)]
            begin[offset + ranks.astype(np.int64)] = at + np.cumsum(n) - n
            values.append(low)
            at += len(low)
    length = int(ends[-1])
    cover = np.zeros(length + 1, np.int32)
    told = np.flatnonzero(begin[rank] >= 0)
    if len(told):
        low, n, first = np.concatenate(values), count[told], first[told]
        mine = ids[np.searchsorted(ends, first, side="right")]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        earlier = low[np.repeat(begin[rank[told]], n) + step] < np.repeat(mine, n)
        start = (np.repeat(first, n) + step)[earlier]
        cover[:length] += np.bincount(start, minlength=length).astype(np.int32)
        cover -= np.bincount(start + SPAN, minlength=length + 1).astype(np.int32)
    return np.cumsum(cover[:-1]) > 0


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[object, list[tuple]]]:
    """Neighbouring rows by their first value."""
    held: list[tuple] = []
    for row in rows:
        if held and held[0][0] != row[0]:
            yield held[0][0], held
            held = []
        held.append(row)
    if held:
        yield held[0][0], held


# -- the steps ---------------------------------------------------------------------


def compressed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(part, doc, body, size)``: documents by parts, texts compressed."""

    def rows(incoming):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        part, filled = TaskContext.get().partitionId() << 24, 0
        for key, text in incoming:
            body = (text or "").encode("utf-8", "surrogatepass")
            if filled and filled + len(body) > PART_BYTES:
                part, filled = part + 1, 0
            filled += len(body)
            yield part, key, squeeze(body), len(body)

    return map_rows(docs.select(F.col(id_column).cast("long"), text_column), "part long, doc long, body binary, size long", rows, batch=500)


def marker_lists(texts: DataFrame, ranges: int) -> DataFrame:
    """``(range, part, markers)``: each part's markers with their documents, by ranges of keys."""

    def rows(incoming):
        marker = Marker()
        for part, held in _grouped(incoming):
            keys, docs, before = [], [], 0
            for batch in _batches(held):
                bodies = [zstandard.ZstdDecompressor().decompress(r[1]) for r in batch]
                ends = np.cumsum(np.fromiter(map(len, bodies), np.int64, len(bodies)))
                key, first, _ = marker.runs(np.frombuffer(b"".join(bodies), np.uint8), ends)
                keys.append(key)
                docs.append(np.searchsorted(ends, first, side="right") + before)
                before += len(bodies)
            key, doc = np.concatenate(keys), np.concatenate(docs)
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            if not len(key):
                continue
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            another = fresh | np.concatenate(([True], doc[1:] != doc[:-1]))
            first = np.flatnonzero(fresh)
            n = np.minimum(np.add.reduceat(another.astype(np.int64), first), 65535).astype(np.uint16)
            key = key[first]
            bounds = np.searchsorted(key, [r * (1 << KEY_BITS) // ranges for r in range(ranges + 1)])
            for r, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if a < b:
                    yield r, part, _pack(_ascending(key[a:b]), n[a:b])

    return map_rows(texts.select("part", "body"), "range int, part long, markers binary", rows, batch=100)


def _batches(held: list[tuple]) -> Iterator[list[tuple]]:
    """Rows in lots of about a buffer of compressed text."""
    lot, size = [], 0
    for row in held:
        lot.append(row)
        size += len(row[1])
        if size > BUFFER // 2:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def repeated_markers(lists: DataFrame) -> DataFrame:
    """``(part, known, n)``: those of a part's markers that occur in several documents."""

    def rows(incoming):
        for _, held in _grouped(incoming):
            unpacked = [_unpack(r[2]) for r in held]
            keys = [np.cumsum(k) for k, _ in unpacked]
            every = np.concatenate(keys)
            counts = np.concatenate([n for _, n in unpacked]).astype(np.int64)
            order = np.argsort(every)
            ordered = every[order]
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            total = np.repeat(np.add.reduceat(counts[order], first), np.diff(np.append(first, len(ordered))))
            documents = np.empty(len(every), np.int64)
            documents[order] = total
            at = 0
            for (_, part, _), key in zip(held, keys):
                mine = documents[at : at + len(key)]
                at += len(key)
                hit = mine > 1
                if hit.any():
                    yield part, _pack(_ascending(key[hit]), (mine[hit] >= CROWDED).astype(np.uint8)), int(hit.sum())

    dealt = lists.repartition("range").sortWithinPartitions("range", "part")
    return map_rows(dealt.select("range", "part", "markers"), "part long, known binary, n long", rows, batch=100)


def _with_documents(texts: DataFrame, told: DataFrame) -> DataFrame:
    """What each part is told, ``(part, bucket, body)``, and then its documents, in one stretch of rows.

    Documents are in the same order each time, those of one id too.
    """
    none = F.lit(None).cast("long")
    rows = told.select("part", F.lit(0).alias("kind"), none.alias("doc"), "bucket", "body")
    rows = rows.unionByName(texts.select("part", F.lit(1).alias("kind"), "doc", F.lit(0).alias("bucket"), "body"))
    return rows.repartition("part").sortWithinPartitions("part", "kind", "doc", "body")


def shard_transforms(dealt: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, part, shard)``: transforms of each part's pieces; below bucket 0, places of the pieces."""

    def rows(incoming):
        marker = Marker()
        for name, held in _grouped(incoming):
            if held[0][1] != 0:
                continue
            part = Part([(r[2], r[4]) for r in held if r[1] == 1], buckets, [r[4] for r in held if r[1] == 0], marker)
            shards = list(part.shards())
            low, high = part.extremes()
            yield -1 - (hash(name) & 0x3FFFFFFF), name, part.places(shards)
            for lot in _lots((bucket, numbers, [part.distinct[k] for k in numbers]) for bucket, numbers in shards):
                for (bucket, numbers, pieces), made in zip(lot, transforms([pieces for _, _, pieces in lot])):
                    lengths = np.fromiter(map(len, pieces), np.uint32, len(pieces))
                    yield bucket, name, _pack(made, lengths, low[numbers], high[numbers])

    return map_rows(dealt, "bucket int, part long, shard binary", rows, batch=100)


def _lots(shards: Iterator[tuple[int, list[int], list[bytes]]]) -> Iterator[list[tuple[int, list[int], list[bytes]]]]:
    """Shards together until they have ``LOT`` symbols."""
    lot, size = [], 0
    for shard in shards:
        lot.append(shard)
        size += sum(map(len, shard[2]))
        if size >= LOT:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def merged(shards: DataFrame) -> DataFrame:
    """``(part, bucket, body)``: pieces of a part that hold something to remove, with the least ids of
    their strings. Places of pieces pass through, as bucket -1."""

    def rows(incoming):
        for bucket, held in _grouped(incoming):
            if bucket < 0:
                for _, part, places in held:
                    yield part, -1, places
                continue
            unpacked = [_unpack(r[2]) for r in held]
            least = least_ids([(t, n) for t, n, _, _ in unpacked], np.concatenate([low for _, _, low, _ in unpacked]))
            at = 0
            for (_, part, _), (_, lengths, _, high) in zip(held, unpacked):
                n = lengths.astype(np.int64) - SPAN + 1
                mine = least[at : at + n.sum()]
                at += len(mine)
                tell = np.minimum.reduceat(mine, np.cumsum(n) - n) < high
                if tell.any():
                    yield part, bucket, _pack(np.flatnonzero(tell).astype(np.uint32), mine[np.repeat(tell, n)])

    dealt = shards.repartition("bucket").sortWithinPartitions("bucket", "part")
    return map_rows(dealt, "part long, bucket int, body binary", rows, batch=100)


def applied(dealt: DataFrame, id_column: str) -> DataFrame:
    """Removes what is covered, document by document."""

    def rows(incoming):
        for _, held in _grouped(incoming):
            docs = [(r[2], r[4]) for r in held if r[1] == 1]
            text, ids, ends = _end_to_end(docs)
            found = {r[3]: r[4] for r in held if r[1] == 0}
            places = found.pop(-1, None)
            gone = np.zeros(len(text), bool) if places is None else removed(ids, ends, places, {b: _unpack(z) for b, z in found.items()})
            data, begin = np.frombuffer(text, np.uint8), 0
            for (name, _), end in zip(docs, ends.tolist()):
                mask = gone[begin:end]
                edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                kept = data[begin:end][~mask].tobytes() if spans else text[begin:end]
                yield name, end - begin, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()
                begin = end

    schema = f"{id_column} long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    return map_rows(dealt, schema, rows, batch=500)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, spans, kept_sha256)`` of every row.

    Texts are UTF-8 bytes, null is empty. A byte is removed if a string of
    ``SPAN`` bytes over it also starts in a document with a smaller id;
    ``spans`` are the maximal removed runs, ends exclusive. Rows that share an
    id remove nothing from each other; null ids are below all others. Other
    columns are not read. An empty table gives an empty result.
    """
    texts = cut_lineage(compressed(docs, id_column, text_column))
    size = texts.agg(F.sum("size")).first()[0] or 0
    lists = marker_lists(texts, max(1, size // 14 // RANGE_MARKERS))
    known = cut_lineage(repeated_markers(lists))
    markers = known.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, markers * (SPAN + 14) // BUCKET_BYTES)
    told = known.select("part", F.lit(0).alias("bucket"), F.col("known").alias("body"))
    found = cut_lineage(merged(shard_transforms(_with_documents(texts, told), buckets)))
    return applied(_with_documents(texts, found), id_column)
