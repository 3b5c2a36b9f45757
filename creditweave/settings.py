"""Policy parameters of the credit pipeline."""

from __future__ import annotations

from dataclasses import dataclass

ID = "application_id"
TARGET = "is_default"
CATEGORICAL = "contract_type"

# The model's input columns, in mart order. The position is the
# tie-break when two features contribute equally.
FEATURES = [
    "contract_type",
    "income_total",
    "credit_amount",
    "annuity_amount",
    "age_years",
    "employment_years",
    "prior_credit_count",
    "active_credit_count",
    "total_credit_debt",
    "total_credit_overdue",
    "max_days_overdue",
    "credit_to_income_ratio",
    "annuity_to_income_ratio",
]
NUMERIC_FEATURES = [f for f in FEATURES if f != CATEGORICAL]


@dataclass(frozen=True)
class Policy:
    """Decision and sampling knobs; the defaults are the published ones."""

    decline_threshold: float = 0.30
    # None explains every declined applicant, a number the riskiest ones only.
    decline_sample_size: int | None = None
    test_share: float = 0.2
    seed: int = 42
