"""Token counts against the library, text by text."""

import random

import public_tokenizers

from creditweave.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")


def want(text):
    return len(tc.encoder(PATH).encode(text or "", add_special_tokens=False).ids)


def test_texts_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(tc, "CACHE_SIZE", 50)
    rng = random.Random(1)
    parts = ["the", " the", "'s", "'ll", "<|endoftext|>", "<|", "\n", "  ", "\t", "\x1c", "　", "é", "ß", "日本", "٣", "😀", "͸", "123", "!?", "𞤀"]
    texts = [None, "", "<|endoftext|>", "x" * 300_000, " " * 5000, "\x00a\x00"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(800)]
    df = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in tc.token_counts(df, PATH).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        n = want(t)
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 512)


def test_every_settled_character_is_cut_as_the_library_cuts_it():
    pieces, library = tc.Pieces(PATH), tc.encoder(PATH).pre_tokenizer
    for c in [*range(0x3000), *range(0xA000, 0xD800, 7), *range(0x10000, 0x32000, 5)]:
        text = f"a{chr(c)}{chr(c)}b {chr(c)}1{chr(c)}"
        if not pieces.unsettled(text):
            assert [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)] == pieces.pattern.findall(text), hex(c)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in tc.token_counts(df, PATH).collect()) == [(0, 1), (1, 2), (1, 2)]
    assert tc.token_counts(df.limit(0), PATH).collect() == []
