"""Document fingerprints by order MinHash, in built-in expressions.

The k-mers are runs of words, each marked by its occurrence number, so that
repeats count. A hash deals them to bins; every bin selects its least ones,
puts them back into text order and hashes the tuple. Two texts agree in a bin
when they share these k-mers in the same order, which follows edits where the
mere set of k-mers would not.

Arrays of longs carry the work: a k-mer's hash and position, then the bin,
hash and position of its numbered form, each packed into one long, so that
sorting is sorting of primitive longs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

KMER = 3
BINS = 64
SELECTED = 2
# Bits of a position; further words all count as the last one.
PLACE_BITS = 26
HASH_BITS = 31
# Bits of a bin's tuple hash in the signature.
TUPLE_BITS = 24
NO_ID = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1).cast("long")


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(_mask(PLACE_BITS))


def _occurrence(places: Column, x: Column, i: Column) -> Column:
    """How many equal k-mers stand before the ``i``-th of the sorted ``places``.

    Equal ones are neighbours; the first of them is found by halving steps.
    """
    kmer = lambda packed: F.shiftright(packed, PLACE_BITS)
    steps = F.array(*[F.lit(1 << b) for b in range(PLACE_BITS - 1, -1, -1)])
    same = lambda back: (i >= back) & (kmer(F.get(places, i - back)) == kmer(x))
    counted = F.aggregate(steps, F.lit(0), lambda n, step: F.when(same(n + step), n + step).otherwise(n))
    return F.when(same(F.lit(1)), counted).otherwise(F.lit(0))


def _numbered(places: Column) -> Column:
    """Sorted ``bin | hash | position`` of the numbered k-mers."""

    def number(x: Column, i: Column) -> Column:
        value = F.xxhash64(F.shiftright(x, PLACE_BITS), _occurrence(places, x, i))
        kept = value.bitwiseAND(_mask(HASH_BITS + (BINS - 1).bit_length()))
        return F.shiftleft(kept, PLACE_BITS).bitwiseOR(_place(x))

    return F.sort_array(F.transform(places, number))


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS + HASH_BITS)


def _signature_of(chosen: Column) -> Column:
    """``bin | tuple hash`` for each bin of the selected k-mers, which are sorted by bin."""

    def tuple_hash(x: Column, i: Column) -> Column:
        members = F.filter(F.slice(chosen, i + 1, F.lit(SELECTED)), lambda y: _bin(y) == _bin(x))
        ordered = F.sort_array(F.transform(members, lambda y: F.shiftleft(_place(y), HASH_BITS).bitwiseOR(
            F.shiftright(y, PLACE_BITS).bitwiseAND(_mask(HASH_BITS)))))
        hashed = F.xxhash64(F.transform(ordered, lambda y: y.bitwiseAND(_mask(HASH_BITS))))
        opens = (i == 0) | (_bin(F.get(chosen, i - 1)) != _bin(x))
        return F.when(opens, F.shiftleft(_bin(x), TUPLE_BITS).bitwiseOR(hashed.bitwiseAND(_mask(TUPLE_BITS))))

    return F.filter(F.transform(chosen, tuple_hash), lambda s: s.isNotNull())


def signature(text: Column) -> Column:
    """The text's signature: one long per bin that has a k-mer."""
    words = F.transform(F.split(text, "[ \\t-\\r]+"), lambda w: F.xxhash64(w))
    last = F.lit((1 << PLACE_BITS) - 1)

    def places(w: Column) -> Column:
        def packed(x: Column, i: Column) -> Column:
            kmer = F.xxhash64(x, *[F.get(w, i + k) for k in range(1, KMER)])
            return F.shiftleft(kmer, PLACE_BITS).bitwiseOR(F.least(i, last).cast("long"))

        return F.sort_array(F.transform(w, packed))

    def least(sorted_: Column) -> Column:
        return F.filter(sorted_, lambda x, i: (i < SELECTED) | (_bin(F.get(sorted_, i - SELECTED)) != _bin(x)))

    return let(words, lambda w: let(places(w), lambda p: let(_numbered(p), lambda n: let(least(n), _signature_of))))


def as_text(signature_: Column) -> Column:
    """Eight hex digits per bin: two of the bin, six of its tuple."""
    return F.array_join(F.transform(signature_, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of bins that agree, of those that either text fills, as a share of k-mers."""
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, TUPLE_BITS))
    agree = F.size(F.array_intersect(a, b)) / F.size(F.array_union(bins(a), bins(b)))
    return F.pow(agree, F.lit(1.0 / SELECTED))


# -- a document and the next one ------------------------------------------------------


def _bucket(key: Column, splits: list[float]) -> Column:
    """How many of the ascending ``splits`` are at most ``key``, by halving steps."""
    if not splits:
        return F.lit(0)
    table = F.array(*[F.lit(int(s)).cast("long") for s in splits])
    steps = F.array(*[F.lit(1 << b) for b in range(len(splits).bit_length() - 1, -1, -1)])
    reached = lambda n: (n <= len(splits)) & (F.get(table, n - 1) <= key)
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(reached(n + step), n + step).otherwise(n))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs (key, text, signature)`` with ``next_text`` and ``next_signature`` by ascending key.

    Keys are dealt to ranges of about equal counts, each ordered for itself.
    The first row of a range is also sent to the range before it, where it
    stands last: ``buckets`` rows, however large the table.
    """
    spark: SparkSession = docs.sparkSession
    shares = [i / buckets for i in range(1, buckets)]
    splits = sorted(set(docs.stat.approxQuantile("key", shares, 0.2 / buckets))) if shares else []
    placed = docs.withColumn("bucket", _bucket(F.col("key"), splits))
    firsts = sorted((r[0], r[1]) for r in placed.groupBy("bucket").agg(F.min("key")).collect())
    if not firsts:
        return docs.withColumn("next_text", F.col("text")).withColumn("next_signature", F.col("signature"))
    follows = [(firsts[(i + 1) % len(firsts)][1], bucket) for i, (bucket, _) in enumerate(firsts)]
    guests = F.broadcast(spark.createDataFrame(follows, "key long, bucket int"))
    both = placed.withColumn("guest", F.lit(False)).unionByName(
        docs.join(guests, "key").withColumn("guest", F.lit(True))
    )
    order = Window.partitionBy("bucket").orderBy("guest", "key", F.xxhash64("text"))
    return (
        both.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_signature", F.lead("signature").over(order))
        .where("not guest")
        .drop("guest", "bucket")
    )


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", buckets: int | None = None
) -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row.

    The edited text has the last half of its code points, rounded down,
    replaced by the first as many (or all) of the next document's by id; after
    the last comes the first. Null counts as empty text, which has one empty
    word. Null ids come first; of repeated rows each is the next one's
    predecessor. ``near_*`` are rounded to six digits. Other columns are not read.
    """
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(text_column, F.lit(""))
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID))
    plain = docs.select(F.col(id_column).alias("id"), key.alias("key"), text.alias("text"))
    paired = with_next(plain.withColumn("signature", signature(F.col("text"))), buckets)
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.char_length("text") - half)
    edited = paired.select(
        "id", "signature", "next_signature", F.char_length("text").cast("long").alias("n_chars"),
        F.concat(kept, F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    signed = edited.withColumn("edited_signature", signature(F.col("edited")))
    return signed.select(
        F.col("id").alias(id_column),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        F.round(likeness(F.col("signature"), F.col("edited_signature")), 6).alias("near_edited"),
        F.round(likeness(F.col("signature"), F.col("next_signature")), 6).alias("near_next"),
    )
