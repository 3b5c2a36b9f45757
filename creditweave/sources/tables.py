"""Scans, gold table writes and the label dictionary."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from creditweave.settings import FEATURES
from creditweave.sources import schemas

# Own phrases for the model's features; no phrase contains another.
LABELS = {
    "contract_type": "the kind of loan applied for",
    "income_total": "the income stated in the application",
    "credit_amount": "the size of the requested loan",
    "annuity_amount": "the size of the regular repayment",
    "age_years": "applicant age",
    "employment_years": "time in the current job",
    "prior_credit_count": "how many earlier credits are on record",
    "active_credit_count": "how many credits are still open",
    "total_credit_debt": "debt owed on other credits",
    "total_credit_overdue": "overdue amounts on other credits",
    "max_days_overdue": "the longest delay in paying other credits",
    "credit_to_income_ratio": "loan size compared with income",
    "annuity_to_income_ratio": "repayment size compared with income",
}
assert list(LABELS) == FEATURES


def scan(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a Parquet table with its declared schema; nothing is inferred."""
    return spark.read.schema(schemas.struct(schemas.BRONZE[table])).parquet(path)


def label_dictionary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Feature names and phrases: the built-in ones, or a two-column CSV file."""
    schema = schemas.struct(schemas.FEATURE_LABELS)
    if path is None:
        columns = {"feature_name": list(LABELS), "feature_label": list(LABELS.values())}
        return spark.createDataFrame(pa.table(columns), schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def as_views(frames: dict[str, DataFrame]) -> None:
    """Expose staged frames to SQL as lazy views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def describe(df: DataFrame, table: str) -> DataFrame:
    """Attach table and column descriptions as field metadata, which Parquet keeps."""
    texts = schemas.DESCRIPTIONS.get(table, {})
    notes = {c: {"comment": texts[c]} for c in df.columns if c in texts}
    if table in schemas.TABLE_DESCRIPTIONS:
        # Parquet keeps field metadata only: the first column carries the table's text.
        notes.setdefault(df.columns[0], {})["table_comment"] = schemas.TABLE_DESCRIPTIONS[table]
    return df.select([F.col(c).alias(c, metadata=notes[c]) if c in notes else F.col(c) for c in df.columns])


def write_table(
    df: DataFrame,
    path: str,
    table: str = "",
    cluster_by: list[str | Column] | None = None,
    files: int | None = None,
) -> DataFrame:
    """Full-refresh write; returns the table as a reader sees it.

    ``cluster_by`` sorts rows into ranges so that row-group statistics let
    filters on the leading column skip files. Give a unique trailing column:
    one value of the leading column may hold a large share of the rows, and
    only the trailing one can spread it over several tasks.
    """
    described = describe(df, table)
    if cluster_by:
        parts = (files, *cluster_by) if files else tuple(cluster_by)
        described = described.repartitionByRange(*parts).sortWithinPartitions(*cluster_by)
    described.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(described.schema).parquet(path)


def write_and_count(df: DataFrame, path: str, table: str = "") -> int:
    """Replace a table and return the row count read back from storage."""
    return write_table(df, path, table).count()


def append_metrics(df: DataFrame, path: str) -> None:
    """Add rows ``(run_id, stage, metric, value)`` to the metric log."""
    df.select("run_id", "stage", "metric", F.col("value").cast("double")).write.mode("append").parquet(path)
