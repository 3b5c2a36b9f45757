"""Text columns: driver lists, prompts, phrase patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def driver_list(labels: list[Column]) -> Column:
    """``1. a; 2. b; 3. c``; a missing label leaves a gap in the numbering."""
    items = [F.concat(F.lit(f"{i}. "), c) for i, c in enumerate(labels, 1)]
    return F.concat_ws("; ", *items)


def cites(text: Column, phrase: Column) -> Column:
    """Whether ``text`` holds ``phrase`` as whole words (phrase from a column)."""
    pattern = F.concat(F.lit(r"\b\Q"), phrase, F.lit(r"\E\b"))
    return F.call_function("rlike", text, pattern)


# Own wording.
PROMPT_HEAD = (
    "Write two or three polite sentences that tell a loan applicant why the "
    "application was turned down. Use these factors only, word for word, and "
    "no other factor, figure or score: "
)
PROMPT_TAIL = ". Make no promise about later decisions and add nothing of your own."


def reason_prompt(drivers: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), drivers, F.lit(PROMPT_TAIL))


def template_reason(labels: list[Column]) -> Column:
    """A fixed sentence that cites the three labels and nothing else."""
    first, second, third = labels
    return F.concat(
        F.lit("We could not approve your loan. What weighed most was "),
        first,
        F.lit(", followed by "),
        second,
        F.lit(" and "),
        third,
        F.lit("."),
    )
