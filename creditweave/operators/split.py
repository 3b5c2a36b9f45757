"""Stratified splits that are the same wherever and however often they run.

Membership is decided by a hash of the id, so no random state is involved,
and exact sizes come from selecting one threshold per stratum instead of
sorting the table: count rows per hash prefix, find the prefix where the quota
runs out, count again inside of it by a longer one, and order only the rows of
the last prefix, which are few at any table size. What reaches the driver
is one row per stratum; the split itself is then a comparison with literals,
a narrow step that costs nothing however often it is read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from creditweave.settings import ID, TARGET

# Hex digits of the hash by which a prefix grows, 16**4 per stratum and pass,
# and the rows of the last prefix that one task may order.
DIGITS = 4
ORDERED_ROWS = 100_000


def hash_rank(salt: str, key: str = ID) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(salt)))


def _known(target: str, strata: tuple) -> Column:
    """Values outside the accepted strata share one stratum of their own."""
    return F.when(F.col(target).isin(list(strata)), F.col(target))


def quotas(sizes: dict, share: float) -> dict:
    """Rows to select per stratum: the total is rounded up, then shared out in
    proportion, with left-over rows going to the largest remainders."""
    total = sum(sizes.values())
    wanted = ceil(share * total)
    exact = {s: wanted * n / total for s, n in sizes.items()}
    taken = {s: int(x) for s, x in exact.items()}
    by_remainder = sorted(sizes, key=lambda s: (taken[s] - exact[s], s is not None, s))
    for s in by_remainder[: wanted - sum(taken.values())]:
        taken[s] += 1
    return taken


def _match(column: str, value) -> Column:
    return F.col(column).isNull() if value is None else F.col(column) == value


def _pick(column: str, values: dict) -> Column:
    """The literal that belongs to the row's stratum."""
    picked = F.lit(None)
    for stratum, value in values.items():
        picked = F.when(_match(column, stratum), F.lit(value)).otherwise(picked)
    return picked


def _last_selected(hashed: DataFrame, share: float) -> dict:
    """Per stratum, hash and id of the last row within the quota."""
    sizes = {r[0]: r[1] for r in hashed.groupBy("stratum").count().collect()}
    wanted = {s: q for s, q in quotas(sizes, share).items() if q > 0} if sizes else {}
    if not wanted:
        return {}
    prefixes, digits = dict.fromkeys(wanted, ""), 0
    upto = Window.partitionBy("stratum").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        digits += DIGITS
        inside = F.col("hash").startswith(_pick("stratum", prefixes))
        counts = hashed.where(inside).groupBy("stratum", F.substring("hash", 1, digits).alias("prefix")).count()
        quota = _pick("stratum", wanted)
        cuts = (
            counts.withColumn("upto", F.sum("count").over(upto))
            .where((F.col("upto") >= quota) & (F.col("upto") - F.col("count") < quota))
            .select("stratum", "prefix", "count", (quota - F.col("upto") + F.col("count")).alias("needed"))
            .collect()
        )
        prefixes = {r["stratum"]: r["prefix"] for r in cuts}
        wanted = {r["stratum"]: r["needed"] for r in cuts}
        if digits >= 32 or max(r["count"] for r in cuts) <= ORDERED_ROWS:
            break
    nth = F.row_number().over(Window.partitionBy("stratum").orderBy("hash", "id"))
    last = (
        hashed.where(F.col("hash").startswith(_pick("stratum", prefixes)))
        .withColumn("nth", nth)
        .where(F.col("nth") == _pick("stratum", wanted))
        .collect()
    )
    return {r["stratum"]: (r["hash"], r["id"]) for r in last}


def select_share(
    df: DataFrame,
    share: float,
    salt: str,
    flag: str = "selected",
    key: str = ID,
    target: str = TARGET,
    strata: tuple = (0, 1),
    among: str | None = None,
) -> DataFrame:
    """Add a boolean column that is true for exactly ``share`` of each stratum.

    A few passes over key and target come before; nothing wider than a count
    per hash prefix is shuffled. ``key`` has to be unique. With ``among``, only
    rows where that column is true take part.
    """
    taking_part = F.lit(True) if among is None else F.col(among)
    hashed = df.where(taking_part).select(
        F.col(key).alias("id"), _known(target, strata).alias("stratum"), hash_rank(salt, key).alias("hash")
    )
    last = _last_selected(hashed, share)
    marked = df.withColumns({"_stratum": _known(target, strata), "_hash": hash_rank(salt, key)})
    last_hash = _pick("_stratum", {s: h for s, (h, _) in last.items()})
    last_id = _pick("_stratum", {s: i for s, (_, i) in last.items()})
    within = (F.col("_hash") < last_hash) | ((F.col("_hash") == last_hash) & (F.col(key) <= last_id))
    return marked.withColumn(flag, taking_part & F.coalesce(within, F.lit(False))).drop("_stratum", "_hash")


def holdout_split(mart: DataFrame, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``fold``: train, calibration or evaluation.

    The holdout is a fifth of the rows; half of it fits the calibrator and the
    other half measures. Both steps are stratified by the target.
    """
    tested = select_share(mart, test_share, f"holdout-{seed}", "_test")
    halved = select_share(tested, 0.5, f"evaluation-{seed}", "_eval", among="_test")
    fold = F.when(F.col("_eval"), "evaluation").when(F.col("_test"), "calibration").otherwise("train")
    return halved.withColumn("fold", fold).drop("_test", "_eval")
