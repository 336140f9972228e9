"""Counts of a run, taken on the rows as they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` with figures (aggregates; by default ``rows``) taken as its rows
    pass, and a function that gives them once the frame has been written.

    The figures belong to the stage that writes: nothing is read or computed a
    second time, and a task that runs again counts once.
    """
    seen = Observation(name)
    figures = figures or {"rows": F.count(F.lit(1))}
    return df.observe(seen, *[c.alias(k) for k, c in figures.items()]), lambda: dict(seen.get)
