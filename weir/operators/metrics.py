"""Row counts of a running job, without counting anything a second time."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class RowCounts:
    """Counts rows at named places of a plan, while the one action that needs them runs.

    ``at`` marks a place; ``result`` has the counts once an action has gone over all marked places.  A mark keeps filters on either
    side where they are, so columns are still pruned, and rows are counted where they stand.
    """

    def __init__(self):
        self.marks: list[tuple[str, Observation]] = []

    def at(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        self.marks.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def result(self) -> dict[str, int]:
        """Rows at each place, in order; waits for the action."""
        return {name: seen.get["rows"] for name, seen in self.marks}

    def lost(self) -> dict[str, int]:
        """Rows that each place has fewer than the one before it."""
        got = list(self.result().items())
        return {b[0]: a[1] - b[1] for a, b in zip(got, got[1:], strict=False)}

    def __str__(self) -> str:
        lost = self.lost()
        return "\n".join(f"{name}: {n} rows" + (f", {lost[name]} removed" if name in lost else "") for name, n in self.result().items())


def removed_rows(df: DataFrame, rule: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, RowCounts]:
    """What ``rule`` leaves of ``df``, and counts before and after it that are there once the result was written or collected."""
    counts = RowCounts()
    return counts.at(rule(counts.at(df, "before")), "after"), counts
