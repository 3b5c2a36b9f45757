"""Global order without a global task.

A window without partition keys sends every row to one task. Here split points
taken from a sample cut the order into ranges; rows are numbered per range,
after one shuffle by the range's number, and only one total per range takes
part in a global running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from creditweave.session import cut_lineage

RANGE = "_range"
# Rows meant for a range, unless that gives more ranges than are planned for.
RANGE_ROWS = 50_000
MOST_RANGES = 1000
# Sampled rows for each range.
SAMPLED = 50
# Cells that one pass of a selection counts.
CELLS = 4096


def _nulls_first(row: tuple) -> list[tuple]:
    """Sort key with Spark's order: null below all values, NaN above all numbers."""
    return [(v is not None, v != v, 0 if v is None or v != v else v) for v in row]


def range_number(pinned: DataFrame, keys: list[str]) -> Column:
    """The range of a row by ascending ``keys``: how many split points are at most its own.

    Split points are literals, so every reader of the rows gets the same
    ranges. The sample that leaves the executors has ``SAMPLED`` rows a range.
    """
    rows = pinned.count()
    ranges = min(MOST_RANGES, -(-rows // RANGE_ROWS))
    # A literal zero would be folded, and with it the keys of the joins on ranges.
    only = F.pmod(F.xxhash64(F.col(pinned.columns[0])), F.lit(1)).cast("int")
    if ranges <= 1:
        return only
    share = min(1.0, SAMPLED * ranges / rows)
    held = sorted(pinned.select(*keys).sample(share, seed=7).collect(), key=_nulls_first)
    splits = held[SAMPLED // 2 :: SAMPLED][:MOST_RANGES]
    if not splits:
        return only
    types = [pinned.schema[k].dataType for k in keys]
    point = lambda row: F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(row, types, keys)])
    table, own = F.array(*[point(r) for r in splits]), F.struct(*[F.col(k) for k in keys])
    halves = F.array(*[F.lit(1 << b) for b in range(len(splits).bit_length() - 1, -1, -1)])
    reached = lambda n: (n <= len(splits)) & (F.get(table, n - 1) <= own)
    return F.aggregate(halves, F.lit(0), lambda n, half: F.when(reached(n + half), n + half).otherwise(n))


def running_totals(df: DataFrame, order: list[str], totals: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Exact running sums along ascending ``order``, restarting for each ``by`` group.

    ``totals`` maps output names to summed columns; sums include the current
    row. ``order`` has to be unique within ``by``, else ties are cut at will.
    """
    by = by or []
    # Sampled, summed and numbered below: computed once.
    pinned = cut_lineage(df)
    ranged = pinned.withColumn(RANGE, range_number(pinned, [*by, *order]))
    # One row per range and group, so at most ranges + groups rows.
    per_range = ranged.groupBy(*by, RANGE).agg(*[F.sum(c).alias(f"_sum_{name}") for name, c in totals.items()])
    earlier = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *by, RANGE, *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in totals]
    )
    inside = Window.partitionBy(*by, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(name) for name, c in totals.items()])
    joined = _join_groups(local, offsets, [*by, RANGE])
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_off_{n}")).alias(n) for n in totals])


def _join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join in which null keys match each other."""
    names = {k: f"_key_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    on = [left[k].eqNullSafe(right[v]) for k, v in names.items()]
    return left.join(right, on).drop(*names.values())


def carried(df: DataFrame, order: list[str], column: str) -> DataFrame:
    """``df`` with nulls of ``column`` filled by its last value before them along a unique ascending ``order``.

    As with running totals, one row per range tells the later ranges.
    """
    pinned = cut_lineage(df)
    ranged = pinned.withColumn(RANGE, range_number(pinned, order))
    latest = F.max_by(column, F.struct(*order)).alias("_last")
    per_range = ranged.where(F.col(column).isNotNull()).groupBy(RANGE).agg(latest)
    # Ranges without a value of their own still ask for an earlier one.
    every = ranged.select(RANGE).distinct().join(per_range, RANGE, "left")
    earlier = Window.partitionBy().orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = every.select(RANGE, F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_own", F.last(column, ignorenulls=True).over(inside))
    return _join_groups(local, before, [RANGE]).withColumn(column, F.coalesce("_own", "_before")).select(df.columns)


def last_selected(pinned: DataFrame, column: str, n: int) -> float | None:
    """A bound that at least ``n`` of the values of a double column reach, and few more.

    The ``n``-th largest value is closed in by counting over the digits of the
    double: the first pass counts rows per sign and exponent, later ones rows
    per equal cell of the interval it is known to lie in, and each goes on in
    the cell where the count runs out, until that holds few rows or one value.
    Six passes settle any table; what reaches the driver is a row per cell.
    NaN and infinity rank above all numbers. None if there are no more than
    ``n`` rows.
    """
    x = F.col(column).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    above = F.count_if(x.isNotNull() & ~finite & ~(x == float("-inf")))
    rows, top, low, high = pinned.agg(F.count(F.lit(1)), above, F.min(F.when(finite, x)), F.max(F.when(finite, x))).first()
    if rows <= n or low is None:
        return None
    left = n - top
    if left <= 0:
        return high
    slack = max(RANGE_ROWS, n // 8)
    # Exponents first; halved numbers do not overflow when they are doubled again.
    place = F.signum(x) * F.coalesce(F.pow(F.lit(2.0), F.floor(F.log2(F.abs(x) / 2))), F.lit(0.0))
    while high > low:
        counts = pinned.where(finite & (x >= low) & (x <= high)).groupBy(place.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")
        )
        for cell in counts.orderBy(F.desc("cell")).collect():
            if cell["n"] >= left:
                break
            left -= cell["n"]
        else:
            return low
        low, high = cell["low"], cell["high"]
        width = (high - low) / CELLS
        # Too close to be parted by a division: all of them are taken.
        if cell["n"] <= slack or width == 0 or low + width == low:
            break
        place = F.least(F.floor((x - low) / width), F.lit(CELLS - 1))
    return low


def top_numbered(df: DataFrame, order: list[str], name: str, limit: int) -> DataFrame:
    """Row numbers up to ``limit`` along ``order``, whose first column is a double to be taken from the largest down.

    Only rows that reach the selected bound are put in order and shuffled; of
    the others, no more than that column is read.
    """
    pinned = cut_lineage(df)
    first, *rest = order
    least = last_selected(pinned, first, limit)
    x = F.col(first).cast("double")
    reaches = F.lit(True) if least is None else F.col(first) >= F.lit(least)
    # File statistics leave NaN out: where there is any, the filter must not be judged by them.
    odd = not pinned.where(F.isnan(x)).isEmpty()
    rivals = pinned.where(F.isnan(x) | reaches if odd else reaches)
    down = rivals.withColumn("_down", -F.coalesce(x, F.lit(float("-inf"))))
    # NaN above all numbers, as in a descending sort.
    down = down.withColumn("_down", F.when(F.isnan("_down"), float("-inf")).otherwise(F.col("_down"))).withColumn("_nan", ~F.isnan(x))
    return numbered(down, ["_nan", "_down", *rest], name, limit).drop("_nan", "_down")


def numbered(df: DataFrame, order: list[str], name: str, limit: int | None = None) -> DataFrame:
    """Row numbers along a unique ascending ``order``; with ``limit``, the rows numbered up to it."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(ones, order, {name: "_one"}).drop("_one")
    return ranked if limit is None else ranked.where(F.col(name) <= limit)
