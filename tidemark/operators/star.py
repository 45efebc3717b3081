"""Config-driven star join: fold a list of ``JoinSpec`` into LEFT JOINs.

Entry 1 is the FROM table; each later entry is LEFT OUTER joined on its
condition (any boolean SQL over the aliases, equi or not); the output is
the entries' column lists in config order. No SQL text is generated: the
fold builds the DataFrame plan directly, and Catalyst/AQE choose the join
strategy from measured sizes (broadcast only when a side is measured to
be under the threshold, sort-merge otherwise). A duplicate key on a
joined side multiplies the left rows, as in SQL.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JoinSpec

TableResolver = Callable[[str], DataFrame]


def star_join(specs: Sequence[JoinSpec], resolve: TableResolver) -> DataFrame:
    if not specs:
        raise ValueError("star_join needs at least one table")
    first = specs[0]
    if first.condition:
        raise ValueError("the first entry is the FROM table and takes no condition")
    acc = resolve(first.table).alias(first.alias)
    steps = []
    for spec in specs[1:]:
        if not spec.condition:
            raise ValueError(f"join entry {spec.alias!r} needs a condition")
        side = resolve(spec.table).alias(spec.alias)
        # sent to every task only if its size, counted here, is what the entry says
        small = spec.bounded and side.limit(spec.max_rows + 1).count() <= spec.max_rows
        acc = acc.join(F.broadcast(side) if small else side, F.expr(spec.condition), "left")
        steps.append((spec, small, acc))
    _check_equalities(steps)
    cols = [c for s in specs for c in s.cols]
    return acc.select(*[F.col(c) for c in cols])


def _loops(df: DataFrame) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastNestedLoopJoin")


def _check_equalities(steps: list[tuple[JoinSpec, bool, DataFrame]]) -> None:
    """A join without an equality between its sides sends one of them whole to every
    task: only a side that was counted may go there."""
    if not steps or not _loops(steps[-1][2]):
        return   # the usual case: one look at the whole plan
    before = 0
    for spec, small, joined in steps:
        now = _loops(joined)
        if now > before and not small:
            raise ValueError(
                f"join entry {spec.alias!r} has no equality between the sides, so one side goes whole to every task: "
                + (f"it has more than max_rows={spec.max_rows} rows" if spec.bounded
                   else "set bounded=True if this table's size is bounded"))
        before = now
