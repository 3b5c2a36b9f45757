"""Packing: ids against the library, pieces by an exact round trip."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from creditweave.llm import packing
from creditweave.llm.token_counts import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def want_ids(text):
    return encoder(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def verify(got, texts):
    """Every id in one piece, checksums right, sequences gapless; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        ids, at = np.array(want_ids(texts[key]), "<u4"), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)
    pad = used = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        used += at
        pad += 0 if at & (at - 1) == 0 else 4096 - at
    return pad / (used + pad)


def test_pieces_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 60)
    rng = random.Random(3)
    words = [f"w{rng.randrange(900)}" for _ in range(3000)]
    texts = {1: None, 2: "", 3: " \n", 4: "It's <|endoftext|> ÉCOLE ﬁ", 5: "x" * 300_000, 6: " ".join(words * 20)}
    for k in range(10, 700):
        texts[k] = " ".join(rng.choices(words, k=rng.choice([1, 50, 300, 3000])))
    texts |= {1000 + k: texts[20] for k in range(300)}
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in texts.items()], "doc_id long, text string, start int, doc string")
    assert verify(packing.pack(df, PATH).collect(), texts) < 0.02


def test_ids_of_common_and_rare_characters():
    ids = packing.Ids(PATH)
    assert all(ids.of(t) == np.array(want_ids(t)[:-1], "<u4").tobytes() for t in samples())


def samples():
    for c in [*range(1, 0x370), *range(0x1E00, 0x2070), *range(0x3040, 0x3060), 0x1F600]:
        ch = chr(c)
        yield f"a{ch}{ch}B {ch}1{ch} 'S{ch}"


def test_joined_checksums():
    data = random.Random(1).randbytes(4 * 1000)
    crcs = np.frombuffer(packing.grid_crcs(data), "<u4")
    for start, take in [(0, 1000), (32, 968), (64, 32), (992, 8), (0, 32)]:
        assert packing.piece_crc(crcs, 1000, start, take) == zlib.crc32(data[4 * start : 4 * (start + take)])


def test_neighbours_are_alike(spark):
    def tail(k, ids):
        return k, len(ids), 0, len(ids), b"", packing._term_counts(np.array(ids, "<u4")), (0, len(ids))

    shard = packing.Shard([tail(0, [1, 2, 3, 9]), tail(1, [7, 8, 9]), tail(2, [1, 2, 4, 9]), tail(3, [9, 10])])
    found = shard.neighbours(0, np.array([False, True, True, True]))
    assert list(found)[0] == 2 and 0 not in found


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    got = packing.pack(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 2), (1, 3), (1, 3)]
    assert packing.pack(df.limit(0), PATH).collect() == []


@pytest.mark.parametrize("text", ["", "<|startoftext|>x"])
def test_special_strings(text):
    assert packing.Ids(PATH).of(text) == np.array(want_ids(text)[:-1], "<u4").tobytes()


def test_term_counts_by_term():
    for ids in ([], [5], [5, 5, 5], [7, 3, 7, 1, 49000, 3]):
        pairs = np.frombuffer(packing._term_counts(np.array(ids, "<u4")), "<u2").reshape(-1, 2)
        assert [tuple(map(int, p)) for p in pairs] == sorted((t, ids.count(t)) for t in set(ids))
