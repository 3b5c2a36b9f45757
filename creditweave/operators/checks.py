"""Data checks. Each returns the offending rows; an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from creditweave.functions.numbers import summable
from creditweave.sources.schemas import struct


# -- rules on one row: true where the row is at fault -----------------------


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: list) -> Column:
    """Nulls pass."""
    return ~F.col(column).isin(values)


def outside(column: str, low: float | None, high: float | None) -> Column:
    """Beyond a closed, maybe open-ended range. Nulls pass; NaN does not,
    although it compares above every number."""
    c = F.col(column)
    bad = F.isnan(c.cast("double"))
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return bad


def not_summable(column: str) -> Column:
    """Amounts that are infinite, NaN or too large to be summed in full. Nulls pass."""
    return ~summable(F.col(column))


# -- checks: offending rows ---------------------------------------------------


def not_null(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``(key, column_name)`` for every null, all columns in one pass."""
    names = [F.when(is_missing(c), F.lit(c)) for c in columns]
    return df.select(key, F.explode(F.array_compact(F.array(*names))).alias("column_name"))


def unique(df: DataFrame, key: str) -> DataFrame:
    """``(key, n)`` for every non-null key seen more than once."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1")


def accepted_values(df: DataFrame, key: str, column: str, values: list) -> DataFrame:
    """``(key, column)`` where the value is not accepted; nulls pass."""
    return df.where(not_accepted(column, values)).select(key, column)


def accepted_range(
    df: DataFrame, key: str, ranges: dict[str, tuple[float | None, float | None]]
) -> DataFrame:
    """``(key, column_name, value)`` outside closed, maybe open-ended ranges."""
    rows = [
        F.when(
            outside(c, low, high),
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")),
        )
        for c, (low, high) in ranges.items()
    ]
    found = df.select(key, F.explode(F.array_compact(F.array(*rows))).alias("bad"))
    return found.select(key, "bad.column_name", "bad.value")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``(child_key, n)`` for non-null keys that the parent lacks.

    Child rows are counted per key first, so a frequent key is shuffled once
    per map task and not once per row.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return keys.join(known, child_key, "left_anti")


def contract_breaks(df: DataFrame, contract: str | T.StructType) -> list[tuple[str, str | None, str | None]]:
    """``(column, expected type, actual type)`` wherever the schemas differ.

    Names and types count; nullability does not, as files never keep it.
    """
    wanted = struct(contract) if isinstance(contract, str) else contract
    expected = {f.name: f.dataType.simpleString() for f in wanted}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    names = [*expected, *[n for n in actual if n not in expected]]
    return [(n, expected.get(n), actual.get(n)) for n in names if expected.get(n) != actual.get(n)]


def contract(df: DataFrame, wanted: str | T.StructType) -> DataFrame:
    """Contract breaks as rows, with how many values each one touches.

    A missing column counts as every row of the table.
    """
    breaks = contract_breaks(df, wanted)
    schema = "column_name string, expected_type string, actual_type string, values_affected bigint"
    if not breaks:
        return df.sparkSession.createDataFrame([], schema)
    counts = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(expected).cast("string").alias("expected_type"),
            F.lit(actual).cast("string").alias("actual_type"),
            (F.count(F.lit(1)) if actual is None else F.count(F.col(name))).alias("values_affected"),
        )
        for name, expected, actual in breaks
    ]
    return df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


# -- gates ----------------------------------------------------------------------


class CheckFailed(Exception):
    """A gate found offending rows."""

    def __init__(self, name: str, rows: int):
        super().__init__(f"{name}: {rows} offending rows")
        self.name, self.rows = name, rows


def require_empty(name: str, offending: DataFrame) -> None:
    """Raise with the number of offending rows, if there are any."""
    rows = offending.count()
    if rows:
        raise CheckFailed(name, rows)


def require_rows(table: str, df: DataFrame, rules: dict[str, Column]) -> None:
    """Raise if any row breaks any rule; all rules are counted in one pass."""
    refuse(table, df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()]).first().asDict())


def refuse(table: str, counts: dict[str, int]) -> None:
    """Raise if any rule counted rows at fault."""
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise CheckFailed(f"{table} {', '.join(broken)}", sum(broken.values()))


def write_observed(df: DataFrame, path: str, rules: dict, mode: str = "overwrite", **options) -> dict:
    """Write ``df`` and count on the way, for each rule, the rows it is true of."""
    if not rules:
        df.write.mode(mode).parquet(path, **options)
        return {}
    seen = Observation()
    named = {f"rule_{i}": rule for i, rule in enumerate(rules.values())}
    df.observe(seen, *[F.count_if(r).alias(n) for n, r in named.items()]).write.mode(mode).parquet(path, **options)
    return {rule: seen.get[n] for rule, n in zip(rules, named)}


def part_of(key: str, part: int, parts: int) -> Column:
    """Rows of one of ``parts`` shares of the keys; equal keys, also null ones, are in one share."""
    return F.pmod(F.xxhash64(key), F.lit(parts)) == part if parts > 1 else F.lit(True)


def repeated_keys(df: DataFrame, keys: tuple[str, ...], parts: int = 1) -> dict[str, int]:
    """How many values each key column has more than once, nulls apart; all columns in one shuffle.

    With ``parts``, share after share of each key's values, so that only one share is on disk at a time.
    """
    if parts > 1:
        shares = {k: [df.where(part_of(k, i, parts)).select(k) for i in range(parts)] for k in keys}
        return {k: sum(repeated_keys(share, (k,))[k] for share in shares[k]) for k in keys}
    if not keys:
        return {}
    # A grouping set leaves all other columns null: ``grouping`` tells that from values that are.
    sets = [[F.col(k)] for k in keys]
    own = [F.grouping(k).alias(f"_of_{i}") for i, k in enumerate(keys)]
    counted = df.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"), *own)
    twice = [
        F.count_if((F.col(f"_of_{i}") == 0) & F.col(k).isNotNull() & (F.col("_n") > 1)).alias(f"_twice_{i}") for i, k in enumerate(keys)
    ]
    return dict(zip(keys, counted.agg(*twice).first()))


def require_contract(name: str, df: DataFrame, wanted: str | T.StructType) -> None:
    breaks = contract_breaks(df, wanted)
    if breaks:
        raise CheckFailed(f"{name} contract {breaks}", len(breaks))


# -- equal content ------------------------------------------------------------


def content(df: DataFrame) -> tuple:
    """A fingerprint of the rows of ``df`` whatever their order: their number and the sums of two 64-bit row hashes.

    One aggregate of three numbers, folded map-side. Equal tables have equal
    fingerprints; two that differ share one with a chance of about 2**-128.
    Nulls are told from values and by their place.
    """
    columns = [F.col(c) for c in sorted(df.columns)]
    gaps = [c.isNull() for c in columns]
    hashes = [F.xxhash64(F.lit(salt), *columns, *gaps).cast("decimal(38,0)") for salt in (1, 2)]
    return tuple(df.agg(F.count(F.lit(1)), *[F.sum(h) for h in hashes]).first())


def changed_rows(before: DataFrame, after: DataFrame) -> int:
    """Rows that only one of two tables has. Only tables whose content differs are compared row by row."""
    if content(before) == content(after):
        return 0
    return before.exceptAll(after).unionAll(after.exceptAll(before)).count()
