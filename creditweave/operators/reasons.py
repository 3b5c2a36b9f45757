"""Reason texts for declined applicants."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from creditweave.functions.text import reason_prompt, template_reason
from creditweave.session import cut_lineage


def _labels() -> list[Column]:
    return [F.col(f"top{i}_label") for i in (1, 2, 3)]


def with_prompt(drivers: DataFrame) -> DataFrame:
    """Add the instruction text a text generator would receive."""
    return drivers.withColumn("prompt", reason_prompt(F.col("driver_list")))


def with_reason(
    drivers: DataFrame, write: Callable[[pd.Series], pd.Series] | None = None
) -> DataFrame:
    """One reason per declined applicant.

    By default a fixed sentence, built by Spark expressions. ``write`` may be
    any batch function from prompts to texts. It runs in the tasks and sees
    each distinct prompt once: applicants with the same drivers in the same
    order, of which there are 1,716 at most, share its text.
    """
    keep = [F.col(c) for c in drivers.columns if not c.endswith("_shap")]
    if write is None:
        return drivers.select(*keep, template_reason(_labels()).alias("adverse_action_reason"))
    prompted = with_prompt(drivers.select(*keep))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(adverse_action_reason=write(frame["prompt"]))

    asked = prompted.select("prompt").where("prompt is not null").distinct()
    # Written once: a second read must not ask the writer again.
    written = cut_lineage(asked.mapInPandas(batches, "prompt string, adverse_action_reason string"))
    return prompted.join(written, "prompt", "left").drop("prompt")
