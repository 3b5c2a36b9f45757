"""Audit of drafted SQL and scoring of answers, in bulk.

The drafts are text in a column; the gates look at the text only. They do not
parse SQL: a forbidden word inside a literal or used as a function name is
refused as well, and the schema part of a table name is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditweave.sources.schemas import CONTRACTS

# The verbs a read-only statement may not hold, in the order they
# are reported.
FORBIDDEN_VERBS = [
    "insert",
    "update",
    "delete",
    "merge",
    "drop",
    "alter",
    "create",
    "truncate",
    "grant",
    "revoke",
    "replace",
    "refresh",
    "copy",
    "into",
]

# The patterns of the gates.
FENCE = r"(?is)^```(?:sql)?\s*(.*?)\s*```$"
READ_ONLY = r"^\s*(select|with)\b"
TABLE_AFTER_FROM = r"\b(?:from|join)\s+([a-zA-Z0-9_.]+)"
# Own additions: forms in which a table name hides from TABLE_AFTER_FROM.
QUOTED_TABLE = r"\b(?:from|join)\s+[`\"]"
COMMA_JOIN = r"\bfrom\s+[a-z0-9_.]+(?:\s+(?:as\s+)?[a-z0-9_]+)?\s*,"


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_draft(text: Column) -> Column:
    """Drop a surrounding code fence and trailing semicolons."""
    trimmed = _trim(text)
    fenced = F.when(trimmed.rlike(FENCE), F.regexp_extract(trimmed, FENCE, 1)).otherwise(trimmed)
    return _trim(F.regexp_replace(_trim(fenced), ";+$", ""))


def audit_drafts(drafts: DataFrame, strict: bool = True, allowed_tables: list[str] | None = None) -> DataFrame:
    """``(question_id, verdict, gate, detail, cleaned_sql)`` per draft.

    ``gate`` is the first one that refuses. ``strict`` adds the last gate,
    against quoted table names and comma joins. A draft may read
    ``allowed_tables``, by default the gold tables.
    """
    sql, lowered = F.col("cleaned_sql"), F.col("lowered")
    # One pattern finds out whether any verb is there; only then is it asked which.
    any_verb = lowered.rlike(rf"\b(?:{'|'.join(FORBIDDEN_VERBS)})\b")
    which = F.coalesce(*[F.when(lowered.rlike(rf"\b{verb}\b"), F.lit(verb)) for verb in FORBIDDEN_VERBS])
    allowed = F.array(*[F.lit(t) for t in (list(CONTRACTS) if allowed_tables is None else allowed_tables)]).cast("array<string>")
    # Drafts are lower-cased before tables are looked up, like the verbs.
    tables = F.array_sort(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TABLE_AFTER_FROM), 1)))
    foreign = F.filter(tables, lambda t: ~F.array_contains(allowed, F.substring_index(t, ".", -1)))
    gates = [
        ("single_statement", sql.contains(";"), F.lit(None).cast("string")),
        ("read_only", ~lowered.rlike(READ_ONLY), F.lit(None).cast("string")),
        ("forbidden_verb", F.col("verb").isNotNull(), F.col("verb")),
        ("table_allowlist", F.size("foreign_tables") > 0, F.get("foreign_tables", F.lit(0))),
    ]
    if strict:
        hidden = lowered.rlike(QUOTED_TABLE) | lowered.rlike(COMMA_JOIN)
        gates.append(("hidden_table", hidden, F.lit(None).cast("string")))
    refused = F.coalesce(
        *[F.when(test, F.struct(F.lit(name).alias("gate"), detail.alias("detail"))) for name, test, detail in gates]
    )
    looked_up = (
        drafts.withColumn("cleaned_sql", clean_draft(F.col("sql_text")))
        .withColumn("lowered", F.lower("cleaned_sql"))
        .withColumn("verb", F.when(any_verb, which))
        .withColumn("foreign_tables", foreign)
        .withColumn("refused", refused)
    )
    return looked_up.select(
        "question_id",
        F.when(F.col("refused").isNull() & sql.isNotNull(), "accepted").otherwise("refused").alias("verdict"),
        F.col("refused.gate").alias("gate"),
        F.col("refused.detail").alias("detail"),
        "cleaned_sql",
    )


def score_answers(answers: DataFrame, truth: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """``(question_id, expected, got, hit)`` for every question with a truth.

    Numbers match within ``tolerance``, anything else as trimmed text. A
    question that was refused, or has no answer row, is a miss.
    """
    joined = truth.join(answers, "question_id", "left")
    got, want = F.col("got"), F.col("expected")
    a, b = got.try_cast("double"), want.try_cast("double")
    numeric = a.isNotNull() & b.isNotNull()
    same = F.when(numeric, F.abs(a - b) < tolerance).otherwise(_trim(got).eqNullSafe(_trim(want)))
    answered = F.coalesce(~F.col("refused"), F.lit(False))
    return joined.select("question_id", "expected", "got", (answered & same).alias("hit"))


def answer_accuracy(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if("hit").alias("hits"),
        F.round(F.avg(F.col("hit").cast("int")), 4).alias("accuracy"),
    )
