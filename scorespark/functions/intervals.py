"""Bin numbers as CASE expressions over literal edges.

The expressions are handed to Spark as SQL text: with dozens of edges that is one
call to the JVM instead of one per comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def double_literal(x: float) -> str:
    return f"double('{float(x)!r}')"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bin_text(column: str, edges: Sequence[float], leaf: Callable[[int], str]) -> str:
    """SQL for ``leaf(bin)`` of a value in the intervals ``(edge[i], edge[i+1]]``, bins from 1.

    The lowest edge belongs to bin 1. Values outside the edges go to the first
    or last bin, so edges learned on one population can bin another one. Two
    equal edges, or a single one, make one bin. NULL stays NULL.
    """
    name = quoted(column)
    inner = list(edges[1:-1])

    def between(low: int, high: int) -> str:
        if low == high:
            return leaf(low + 1)
        middle = (low + high) // 2
        return (
            f"CASE WHEN {name} <= {double_literal(inner[middle])} "
            f"THEN {between(low, middle)} ELSE {between(middle + 1, high)} END"
        )

    return f"CASE WHEN {name} IS NOT NULL THEN {between(0, len(inner))} END"


def right_closed_bin(column: str, edges: Sequence[float]) -> Column:
    """1-based bin number, see :func:`bin_text`."""
    return F.expr(bin_text(column, edges, str))


def left_closed_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """1-based equal-width bin ``[edge, next)``; the last bin holds the maximum too."""
    if high <= low:
        return F.when(value.isNotNull(), F.lit(1))
    position = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    return F.least(F.lit(bins), F.greatest(F.lit(1), position.cast("int") + 1))


def even_edges(low: float, high: float, bins: int) -> list[float]:
    """``bins + 1`` equally spaced edges from ``low`` to ``high``."""
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]
