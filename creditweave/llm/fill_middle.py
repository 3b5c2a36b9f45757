"""Fill-in-the-middle rows, cut at line ends found in an indexable skip list.

The lines of a document are the list's nodes. Each express lane links every
``FAN``-th node of the lane below and carries two widths for a link: the lines
and the code points it passes. Descending by accumulated lines reaches the
node of any rank in a few steps a lane, and the accumulated code points are
the place to cut at: the text is not scanned again, however long it is.
"""

from __future__ import annotations

import hashlib
from array import array

from pyspark.sql import DataFrame, functions as F

from creditweave.llm.common import map_rows

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FAN = 16


def line_widths(text: str) -> list[int]:
    """Code points of each line, its line feed included."""
    widths = [len(part) + 1 for part in text.split("\n")]
    # What follows the last line feed has none of its own.
    widths[-1] -= 1
    return widths if widths[-1] else widths[:-1]


class SkipList:
    """Nodes in order, found by rank; a node has a width in code points.

    Lane 0 links neighbours; a node of rank r is on lane k if ``FAN ** k``
    divides r. So a lane is a pair of arrays, and no link needs a pointer.
    """

    def __init__(self, widths: list[int]):
        self.lanes = [(array("q", [1]) * len(widths), array("q", widths))]
        while len(self.lanes[-1][0]) > FAN:
            units, points = self.lanes[-1]
            starts = range(0, len(units), FAN)
            self.lanes.append(
                (array("q", [sum(units[i : i + FAN]) for i in starts]), array("q", [sum(points[i : i + FAN]) for i in starts]))
            )

    def __len__(self) -> int:
        return sum(self.lanes[-1][0])

    def place(self, rank: int) -> int:
        """Code points before the node of ``rank``, or of all nodes for the rank behind the last."""
        if not 0 <= rank <= len(self):
            raise IndexError(rank)
        node = passed = point = 0
        for units, points in reversed(self.lanes):
            node *= FAN
            while node < len(units) and passed + units[node] <= rank:
                passed += units[node]
                point += points[node]
                node += 1
        return point


def draws(key: object, seed: int) -> list[int]:
    """Four numbers below 2**32 that depend on seed and key alone; no key draws as ``null``."""
    digest = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transform(key: object, text: str, seed: int, rate: int, spm_rate: int) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    lines = SkipList(line_widths(text))
    n = len(lines)
    one, two, three, four = draws(key, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or three % 100 >= rate:
        return n, "plain", None, None, text
    first, last = sorted((one % (n + 1), two % (n + 1)))
    a, b = lines.place(first), lines.place(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if four % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def original(form: str, output: str) -> str:
    """The text that was transformed to ``output``.

    Marks are unambiguous: transformed texts hold none of their own, and a mark
    begins with a character that stands nowhere else in it, so that none can
    arise where a part meets a mark.
    """
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX)
    return prefix + middle + suffix


def fill_middle(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50
) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` of every row.

    ``n`` lines are cut into prefix, middle and suffix at two line ends drawn
    by a hash of ``seed`` and id, and written in the order prefix, suffix,
    middle (``psm``) or, in ``spm_rate`` of a hundred, suffix, prefix, middle
    (``spm``), each part behind its mark. ``rate`` of a hundred texts are
    transformed; the others, empty and null texts, and texts that hold a mark
    stay ``plain`` without cuts. Rows without id draw alike, as repeated ids
    do. Texts are read whole, and each is one row of memory; other columns are
    not read. An empty table gives an empty result.
    """

    def rows(incoming):
        for key, text in incoming:
            yield key, *transform(key, text or "", seed, rate, spm_rate)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_rows(docs.select(id_column, text_column), schema, rows, batch=200)


def restored(transformed: DataFrame, form_column: str = "form", output_column: str = "output") -> DataFrame:
    """``transformed`` with column ``restored``: the exact texts, rebuilt from form and output.

    The parts are found by their marks in built-in functions; a row that no
    transformation wrote is an error of the caller.
    """
    form, output = F.col(form_column), F.col(output_column)
    halves = F.split(output, MIDDLE, 2)
    psm = F.split(F.substr(halves[0], F.lit(len(PREFIX) + 1)), SUFFIX, 2)
    spm = F.split(F.substr(halves[0], F.lit(len(SUFFIX) + 1)), PREFIX, 2)
    text = (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(psm[0], halves[1], psm[1]))
        .otherwise(F.concat(spm[1], halves[1], spm[0]))
    )
    return transformed.withColumn("restored", text)
