"""The operators applied to the whole documents table: name -> (spark, folder)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from creditweave.llm import (
    bwt_dedup,
    decontaminate,
    exact_dedup,
    fill_middle,
    language_id,
    licenses,
    mixing,
    order_minhash,
    packing,
    pii,
    simhash,
    target_sampling,
    token_counts,
)
from creditweave.llm.common import documents


def benchmark(spark, d):
    """The benchmark table below the folder, through Spark's own reader."""
    return spark.read.parquet(f"{d}/benchmark.parquet")


def op1_exact_dedup(spark, d):
    return exact_dedup.exact_dedup(documents(spark, d))


def op2_simhash(spark, d):
    return simhash.simhash_components(documents(spark, d))


def op3_mixing(spark, d):
    return mixing.mix(documents(spark, d))


def op4_language_id(spark, d):
    return language_id.identify(documents(spark, d))


def op5_token_counts(spark, d):
    return token_counts.token_counts(documents(spark, d), public_tokenizers.path("byte_bpe_50k.json"))


def op6_suffix_dedup(spark, d):
    removed = bwt_dedup.remove_repeats(documents(spark, d))
    return removed.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op7_personal_data(spark, d):
    return pii.find_personal_data(documents(spark, d))


def op8_packing(spark, d):
    return packing.pack(documents(spark, d), public_tokenizers.path("word_bpe_49k.json"))


def op9_licenses(spark, d):
    return licenses.scan(documents(spark, d))


def op10_fingerprints(spark, d):
    return order_minhash.fingerprints(documents(spark, d))


def op11_fill_middle(spark, d):
    cut = fill_middle.restored(fill_middle.fill_middle(documents(spark, d)))
    digests = {f"{c}_sha256": F.sha2(F.col(c).cast("binary"), 256) for c in ("output", "restored")}
    return cut.withColumns(digests).drop("output", "restored")


def op12_decontaminate(spark, d):
    return decontaminate.contamination(decontaminate.find_passages(documents(spark, d), benchmark(spark, d)))


def op13_target_sampling(spark, d):
    return target_sampling.sample_like(documents(spark, d), benchmark(spark, d)).drop("n_words")


QUERIES = {
    f.__name__: f
    for f in [
        op1_exact_dedup,
        op2_simhash,
        op3_mixing,
        op4_language_id,
        op5_token_counts,
        op6_suffix_dedup,
        op7_personal_data,
        op8_packing,
        op9_licenses,
        op10_fingerprints,
        op11_fill_middle,
        op12_decontaminate,
        op13_target_sampling,
    ]
}
