"""Numeric and key columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The marker for "not employed", the length of a year in days,
# the key separator and the stand-in for a missing key part.
NOT_EMPLOYED_DAYS = 365243
DAYS_PER_YEAR = 365.25
KEY_SEPARATOR = "||"
KEY_NULL = "_null_"


def round_to(x: Column, digits: int) -> Column:
    """Round a double on plain IEEE arithmetic, ties to even.

    ``F.round`` goes through big decimals row by row; this stays on primitive
    doubles, any engine with IEEE doubles gives the same bits, and NaN stays
    NaN so that range checks still see it.
    """
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def years_fraction(days_before: Column) -> Column:
    """Negative day offset to years, at six decimals."""
    return round_to(-days_before.cast("double") / DAYS_PER_YEAR, 6)


def years_whole(days_before: Column) -> Column:
    """Negative day offset to completed years, cut towards zero."""
    return (-days_before.cast("double") / DAYS_PER_YEAR).cast("int")


def scrub_not_employed(days_employed: Column, value: Column) -> Column:
    """``value``, or null where the offset is the not-employed marker."""
    return F.when(days_employed == NOT_EMPLOYED_DAYS, F.lit(None)).otherwise(value)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, or null when the denominator is zero or null."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def surrogate_key(*names: str) -> Column:
    """Stable hash key over the text form of several raw columns."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit(KEY_NULL)) for n in names]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


# Whole digits and decimals of summed money. Amounts from SUM_LIMIT up, infinite
# ones and NaN are no summands: gates refuse tables that have them.
SUM_TYPE = "decimal(38,18)"
SUM_LIMIT = 1e20


def summable(amount: Column) -> Column:
    """Whether ``exact_sum`` takes the amount in full; null passes."""
    x = amount.cast("double")
    return x.isNull() | ((F.abs(x) < SUM_LIMIT) & ~F.isnan(x))


def exact_sum(amount: Column) -> Column:
    """Sum of money that does not depend on the order of rows, as sums of doubles do.

    Amounts below 1e20 are added as decimals of 18 places. If any amount is
    not ``summable``, or the total leaves the range, the sum is NaN: a part of
    the rows is never passed off as the whole.
    """
    total = F.try_sum(amount.try_cast(SUM_TYPE)).cast("double")
    some = F.count_if(amount.isNotNull()) > 0
    fits = F.every(summable(amount)) & (total.isNotNull() | ~some)
    return F.when(~some | fits, total).otherwise(F.lit("NaN").cast("double"))
