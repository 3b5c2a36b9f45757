"""The declared checks of every table, and how they are counted.

Row rules are counted while a table is written, so they cost no pass of their
own; all keys of a table are counted by grouping sets, in one shuffle; a
relationship is one anti join on distinct keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from creditweave.operators import checks
from creditweave.session import lean_disk, remove
from creditweave.settings import ID, TARGET
from creditweave.sources.versioned import shares


@dataclass(frozen=True)
class Declared:
    """Checks of one table; ranges are closed and may be open-ended, nulls pass all but ``not_null``."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, list] = field(default_factory=dict)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    # Column -> table and column that have to know its values.
    known: dict[str, tuple[str, str]] = field(default_factory=dict)

    def rules(self) -> dict[tuple[str, str], Column]:
        """Checks that look at one row: (check, column) -> true where the row is at fault."""
        return (
            {("not_null", c): checks.is_missing(c) for c in self.not_null}
            | {("accepted_values", c): checks.not_accepted(c, v) for c, v in self.accepted.items()}
            | {("accepted_range", c): checks.outside(c, low, high) for c, (low, high) in self.ranges.items()}
        )


# Which columns of which table are checked for what.
CATALOGUE: dict[str, Declared] = {
    "stage_applications": Declared((ID, TARGET, "income_total"), (ID,), {TARGET: [0, 1]}, {"employment_years": (0, 100)}),
    "stage_credits": Declared(("bureau_credit_id", ID, "credit_status"), ("bureau_credit_id",)),
    "stage_payments": Declared(("payment_id", ID, "installment_due_day")),
    "stage_predictions": Declared(
        (ID, "predicted_pd", "top1_feature"), (ID,), {}, {"predicted_pd": (0, 1)}, {ID: ("applications", ID)}
    ),
    "credit_rollup": Declared((ID,), (ID,), {}, {"prior_credit_count": (1, 1000)}),
    "drivers": Declared(
        (ID, "predicted_pd", "top1_label", "top2_label", "top3_label", "driver_list"), (ID,), {}, {"predicted_pd": (0, 1)}
    ),
    "applications": Declared(
        (ID, TARGET, "prior_credit_count"), (ID,), {TARGET: [0, 1]},
        {"prior_credit_count": (0, None), "active_credit_count": (0, None)},
    ),
    "payments": Declared(("payment_id", ID, "installment_due_day"), ("payment_id",)),
    "scored": Declared((ID, "predicted_pd"), (ID,), {}, {"predicted_pd": (0, 1)}),
    "declines": Declared((ID, "predicted_pd", "adverse_action_reason"), (ID,)),
    "labels": Declared(("feature_name", "feature_label"), ("feature_name", "feature_label")),
}

RESULT = "table_name string, check string, column_name string, offending_rows bigint"


def write_checked(name: str, df: DataFrame, path: str) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """Write a table and count its row rules on the way; the table as read back, and the counts."""
    found = checks.write_observed(df, path, CATALOGUE[name].rules())
    return df.sparkSession.read.schema(df.schema).parquet(path), found


def run_catalogue(spark: SparkSession, frames: dict[str, DataFrame], root: str, keep: bool = True) -> DataFrame:
    """One row per declared check with the rows (or repeated or unknown keys) at fault.

    ``frames`` are the tables by name; each is computed once, by being written below ``root``.
    Keys are counted in shares of about as many rows as a commit deals out at once. Unless
    ``keep``, a table goes as soon as no check is left that reads it.
    """
    stored, of_rows, of_keys = {}, [], {name: [] for name in frames}
    # Relationships by child column: they wait for both tables.
    waiting = {(name, column): known for name in frames for column, known in CATALOGUE[name].known.items()}
    with lean_disk(spark):
        for name, df in frames.items():
            stored[name], found = write_checked(name, df, f"{root}/{name}")
            of_rows += [(name, check, column, n) for (check, column), n in found.items()]
            unique = CATALOGUE[name].unique
            parts = shares(spark, stored[name].count()) if unique else 1
            of_keys[name] += [(name, "unique", c, n) for c, n in checks.repeated_keys(stored[name], unique, parts).items()]
            for (child, column), (parent, key) in [*waiting.items()]:
                if child in stored and parent in stored:
                    unknown = checks.orphans(stored[child], column, stored[parent], key).count()
                    of_keys[child].append((child, "relationships", column, unknown))
                    del waiting[child, column]
            needed = {t for (child, _), (parent, _) in waiting.items() for t in (child, parent)}
            if not keep:
                done = [t for t in stored if t not in needed]
                remove(spark, [f"{root}/{t}" for t in done])
                stored = {t: table for t, table in stored.items() if t in needed}
        return spark.createDataFrame(of_rows + [row for rows in of_keys.values() for row in rows], RESULT)
