"""Token counts by a two-tier lookup on the map side.

A text is cut into pre-tokens, whose token counts add up. Tier one is a compact
table of the counts of frequent pre-tokens, broadcast to every worker. Tier
two encodes what it lacks, once per worker, and keeps the count in a bounded
cache. No pre-token of the texts is shuffled; the table comes from the tallies of
a bounded sample.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from creditweave.llm.common import hash_sample, map_rows

# Fixed value: the pre-token pattern of byte-level vocabularies, with the
# encoder's notion of white space spelled out.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Outside of these blocks a text's characters are looked up one by one.
RARE = regex.compile("[^\\x00-\u024f\u1e00-\u206f]")
# Rows the frequent table is taken from, and its size. They affect speed only.
SAMPLE_ROWS = 2000
TABLE_SIZE = 32_768
# Longer pre-tokens are encoded whenever they occur.
LONGEST_KEPT = 64
CACHE_SIZE = 300_000


@lru_cache(maxsize=2)
def encoder(path: str) -> Tokenizer:
    """The tokenizer at ``path``, once per process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def special_strings(tokenizer: Tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


class Pieces:
    """Cuts texts where the tokenizer at ``path`` cuts them."""

    def __init__(self, path: str):
        special = special_strings(encoder(path))
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PRE_TOKEN)

    @staticmethod
    def unsettled(text: str) -> bool:
        """Whether the encoder may class a character of ``text`` otherwise than we do,
        its Unicode tables being older or newer: those not yet assigned in Python's."""
        return bool(RARE.search(text)) and any(unicodedata.category(c) == "Cn" for c in set(text))

    def cut(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of ``text`` and how many special strings stand between them."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text), 0
        plain = self.special.split(text)
        return [p for t in plain for p in self.pattern.findall(t)], len(plain) - 1


@dataclass(frozen=True)
class FrequentTable:
    """Pre-tokens, joined by a character none of them has, and a byte of count for each."""

    joined: str
    counts: bytes

    @staticmethod
    def pack(pairs: list[tuple[str, int]]) -> FrequentTable:
        pairs = [(p, n) for p, n in pairs if "\x00" not in p and n < 256]
        return FrequentTable("\x00".join(p for p, _ in pairs), bytes(n for _, n in pairs))

    def unpack(self) -> dict[str, int]:
        return dict(zip(self.joined.split("\x00"), self.counts)) if self.counts else {}


class Lengths(dict):
    """Token count of a pre-token; both tiers in one hash table."""

    def __init__(self, table: FrequentTable, path: str):
        self.frequent = table.unpack()
        self.encoder = encoder(path)
        super().__init__(self.frequent)

    def __missing__(self, piece: str) -> int:
        n = len(self.encoder.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= len(self.frequent) + CACHE_SIZE:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def frequent_table(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> FrequentTable:
    """Counts of the most frequent pre-tokens of the ``SAMPLE_ROWS`` rows of least hash."""

    def tally(rows):
        pieces, seen = Pieces(path), Counter()
        for (text,) in rows:
            seen.update(p for p in pieces.cut(text or "")[0] if len(p) <= LONGEST_KEPT)
        yield from seen.most_common(TABLE_SIZE)

    ids = hash_sample(docs, id_column, SAMPLE_ROWS)
    sample = docs.join(F.broadcast(ids), id_column, "left_semi").select(text_column)
    counted = map_rows(sample, "piece string, n long", tally).groupBy("piece").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "piece").limit(TABLE_SIZE).select("piece").collect()
    count = encoder(path).encode
    return FrequentTable.pack([(r[0], len(count(r[0], add_special_tokens=False).ids)) for r in top])


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row.

    Counts are those of the byte-level tokenizer file at ``path`` without
    added special tokens; special strings inside a text count as it counts
    them by default. Null counts as empty text: no bytes, no tokens. Repeated
    rows and null ids are kept as they are; other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_table(docs, path, id_column, text_column))

    def rows(incoming):
        pieces, lengths = Pieces(path), Lengths(table.value, path)
        for key, text in incoming:
            text = text or ""
            if pieces.unsettled(text):
                n = len(encoder(path).encode(text, add_special_tokens=False).ids)
            else:
                cut, special = pieces.cut(text)
                n = sum(map(lengths.__getitem__, cut)) + special
            yield key, len(text.encode("utf-8", "surrogatepass")), n, n > limit

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(id_column, F.col(text_column))
    return map_rows(chosen, f"{id_column} {kind}, n_bytes long, n_tokens long, over_limit boolean", rows)
