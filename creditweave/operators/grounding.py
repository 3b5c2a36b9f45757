"""Do reasons cite only the applicant's own drivers?

The textbook form pairs every reason with every label. Here words of the
reasons meet each label's longest word in an equi-join; the few pairs that
share one fetch the reason's text and are matched as whole phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditweave.functions.text import cites
from creditweave.settings import ID

NO_LABEL = "(driver without label)"


def _lowered(declines: DataFrame) -> DataFrame:
    return declines.select(
        ID,
        F.lower("adverse_action_reason").alias("reason"),
        *[F.lower(f"top{i}_label").alias(f"l{i}") for i in (1, 2, 3)],
    )


def _own() -> list[Column]:
    return [F.col(f"l{i}") for i in (1, 2, 3)]


def cited_labels(reasons: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``cited``: every dictionary phrase the reason holds as whole words.

    A label without a word in it could not be found and is an error.
    """
    words = F.regexp_extract_all("fl", F.lit(r"\w+"), 0)
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    # Each word of a phrase is a whole word wherever the phrase is matched, so
    # joining on the longest one (the least common, most likely) loses nothing.
    anchored = (
        labels.select(F.lower("feature_label").alias("fl"))
        .where(F.col("fl").isNotNull())
        .distinct()
        .select("fl", F.when(F.size(words) > 0, longest).otherwise(
            F.raise_error(F.concat(F.lit("label without a word: "), "fl"))).alias("word"))
    )
    tokens = reasons.select(ID, F.explode(F.array_distinct(F.regexp_extract_all("reason", F.lit(r"\w+"), 0))).alias("word"))
    pairs = tokens.join(anchored, "word").select(ID, "fl")
    found = (
        pairs.join(reasons.select(ID, "reason"), ID)
        .where(cites(F.col("reason"), F.col("fl")))
        .groupBy(ID)
        .agg(F.sort_array(F.collect_list("fl")).alias("cited"))
    )
    return reasons.join(found, ID, "left").withColumn("cited", F.coalesce("cited", F.array().cast("array<string>")))


def _foreign(cited: Column) -> Column:
    own = F.array_compact(F.array(*_own()))
    return F.filter(cited, lambda phrase: ~F.array_contains(own, phrase))


def ungrounded_citations(declines: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(application_id, foreign_label_cited)``; none means grounded.

    A driver without a label would make a plain NOT IN null and let any
    citation through, so it is reported as a failure of its own.
    """
    checked = cited_labels(_lowered(declines), labels)
    unlabelled = F.array_repeat(F.lit(NO_LABEL), F.when(_any_null(), 1).otherwise(0))
    return checked.select(
        ID, F.explode(F.concat(_foreign(F.col("cited")), unlabelled)).alias("foreign_label_cited")
    )


def _any_null() -> Column:
    return F.col("l1").isNull() | F.col("l2").isNull() | F.col("l3").isNull()


def grounding_metrics(declines: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: reasons, mean own drivers cited, reasons with own / foreign ones."""
    own = sum((cites(F.col("reason"), label).cast("int") for label in _own()), F.lit(0))
    per_reason = cited_labels(_lowered(declines), labels).select(
        own.alias("own_cited"), F.size(_foreign(F.col("cited"))).alias("foreign_cited")
    )
    return per_reason.agg(
        F.count(F.lit(1)).alias("n_reasons"),
        F.round(F.avg("own_cited"), 2).alias("avg_own_drivers_cited"),
        F.count_if(F.col("own_cited") >= 1).alias("reasons_citing_any_driver"),
        F.count_if(F.col("foreign_cited") > 0).alias("reasons_with_foreign_factor"),
    )
