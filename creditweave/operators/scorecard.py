"""A fixed additive scorecard: scores, per-feature terms and top drivers.

Everything is a column expression, so scoring a table is one pass without a
shuffle and any SQL engine can recompute it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from creditweave.functions.numbers import round_to
from creditweave.settings import CATEGORICAL, FEATURES, ID

DIGITS = 6


@dataclass(frozen=True)
class Scorecard:
    """Model parameters: ``weight * ((x - center) / scale)`` for each feature."""

    intercept: float
    numeric: dict[str, tuple[float, float, float]]
    categories: dict[str, float] = field(default_factory=dict)

    def term(self, feature: str) -> Column:
        """The feature's share of the log-odds; missing values add nothing."""
        if feature == CATEGORICAL:
            value = F.lit(0.0)
            for category, weight in self.categories.items():
                value = F.when(F.col(feature) == category, weight).otherwise(value)
            return value
        center, scale, weight = self.numeric[feature]
        x = F.coalesce(F.col(feature).cast("double"), F.lit(center))
        return weight * ((x - center) / scale)


# Chosen for the given tables: center and scale are near each column's median
# and spread there.
DEFAULT_SCORECARD = Scorecard(
    intercept=-1.3,
    numeric={
        "income_total": (4500.0, 3170.0, -0.31),
        "credit_amount": (250000.0, 144000.0, 0.27),
        "annuity_amount": (12500.0, 7200.0, 0.11),
        "age_years": (44.0, 14.3, -0.29),
        "employment_years": (16.4, 9.5, -0.37),
        "prior_credit_count": (4.0, 2.1, 0.17),
        "active_credit_count": (2.0, 1.4, 0.23),
        "total_credit_debt": (205000.0, 127000.0, 0.33),
        "total_credit_overdue": (3400.0, 4300.0, 0.41),
        "max_days_overdue": (24.0, 17.6, 0.19),
        "credit_to_income_ratio": (52.0, 610.0, 0.36),
        "annuity_to_income_ratio": (2.6, 30.5, 0.14),
    },
    categories={
        "1-URGENT": 0.43,
        "2-HIGH": 0.21,
        "4-NOT SPECIFIED": -0.13,
        "5-LOW": -0.26,
    },
)


def linear_scores(
    mart: DataFrame, card: Scorecard = DEFAULT_SCORECARD, carry: list[str] | None = None
) -> DataFrame:
    """``application_id, predicted_pd`` and an array of per-feature terms.

    ``carry`` names mart columns to keep, where a later step needs them next to
    the score: no join is needed to bring them back.
    """
    kept = carry or []
    terms = mart.select(ID, *kept, *[card.term(f).alias(f"_t_{f}") for f in FEATURES])
    margin = F.lit(card.intercept)
    for f in FEATURES:
        margin = margin + F.col(f"_t_{f}")
    return terms.select(
        ID,
        *kept,
        (1.0 / (1.0 + F.exp(-margin))).alias("predicted_pd"),
        F.array(*[F.col(f"_t_{f}") for f in FEATURES]).alias("contributions"),
    )


def top_drivers(scores: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """The prediction row: three largest contributions, with their features.

    Largest first, whatever the sign; equal contributions follow feature order.
    """
    # A lambda over the array, not a column per feature: unrolled, the generated
    # method outgrows what the JVM compiles, and the whole stage is interpreted.
    placed = F.transform("contributions", lambda c, i: F.struct(c.alias("c"), (-i).alias("place")))
    ranked = scores.select(ID, "predicted_pd", F.sort_array(placed, asc=False).alias("ranked"))
    names = F.array(*[F.lit(f) for f in features])
    columns = []
    for i in (1, 2, 3):
        entry = F.col("ranked")[i - 1]
        columns += [names[-entry["place"]].alias(f"top{i}_feature"), entry["c"].alias(f"top{i}_shap")]
    return ranked.select(ID, "predicted_pd", *columns)


def published(df: DataFrame) -> DataFrame:
    """Scores and contributions at six decimals, for readers; decisions are made before."""
    shown = [c for c, kind in df.dtypes if kind == "double" and (c == "predicted_pd" or c.endswith("_shap") or c.startswith("term_"))]
    # Adding zero turns a rounded -0.0 into 0.0.
    return df.withColumns({c: round_to(F.col(c), DIGITS) + 0.0 for c in shown})
