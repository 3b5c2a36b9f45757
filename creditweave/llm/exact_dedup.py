"""Exact copies by a tree-merge of digest runs.

Every input partition is one run of ``(digest, identifier, count)``. Rounds of
a tree join ``fan_in`` runs into one: a round exchanges the entries of the
runs that meet by digest and merges equal ones, keeping one identifier and the
sum of the counts. Merging starts before each exchange, so a text that fills a
third of the table is one entry per run from the first round on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import ascii_lower
from creditweave.session import cut_lineage

KEY = ["digest", "proof"]


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, digest, proof, row, run)`` of every row.

    The digest is SHA-256 of the normalised text. The proof, a second hash
    with the length, is part of every comparison: entries are merged only
    where both agree. ``row`` tells repeated rows apart.
    """
    text = ascii_lower(F.col(text_column))
    return docs.select(F.col(id_column).alias("id"), text.alias("text")).select(
        "id",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.xxhash64(F.octet_length("text"), "text").alias("proof"),
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
    )


def merge_round(runs: DataFrame, fan_in: int) -> DataFrame:
    """Join each ``fan_in`` neighbouring runs into one, in the order of digests."""
    return (
        runs.groupBy(F.floor(F.col("run") / fan_in).cast("int").alias("run"), *KEY)
        .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
        .sortWithinPartitions("run", *KEY)
    )


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest", fan_in: int = 16
) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` of every row.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. Of equal texts the row with the ``largest`` (or ``smallest``) id
    stays; of repeated rows with that id, exactly one. Null ids are lowest.
    Other columns are not read. An empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    leaves = cut_lineage(digests(docs, id_column, text_column))
    order = F.col("id") if keep == "largest" else -F.col("id")
    best = F.struct(order.alias("order"), F.col("row").alias("row"), F.col("id").alias("id"))
    runs = leaves.select("run", *KEY, best.alias("best"), F.lit(1).cast("long").alias("n"))
    width = (leaves.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        runs, width = merge_round(runs, fan_in), -(-width // fan_in)
        if width == 1:
            break
    winners = runs.select(*KEY, F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "n")
    return leaves.join(winners, KEY).select(
        F.col("id").alias(id_column),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were; rows that share id and text become one."""
    decided = exact_dedup(docs, id_column, text_column, keep)
    lost = cut_lineage(
        decided.where("not kept").select(
            F.col(id_column).alias("_id"), F.col("text_sha256").alias("_sha"), F.col("keep_id").eqNullSafe(F.col(id_column)).alias("_again")
        )
    )
    marked = docs.withColumn("_sha", F.sha2(ascii_lower(F.col(text_column)).cast("binary"), 256))
    same = marked[id_column].eqNullSafe(lost["_id"]) & (marked["_sha"] == lost["_sha"])
    left = marked.join(lost.where("not _again"), same, "left_anti")
    if not lost.where("_again").isEmpty():
        left = left.dropDuplicates([id_column, "_sha"])
    return left.drop("_sha")
