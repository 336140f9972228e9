"""Type coercion of freshly read CDC text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coerce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Force the given columns to a type.  Uses ``try_cast`` so that bad text
    becomes NULL instead of failing the job under ANSI mode."""
    present = {k: v for k, v in types.items() if k in df.columns}
    return df.withColumns({k: F.col(k).try_cast(v) for k, v in present.items()})


def stamp_load_time(df: DataFrame, run_ts: str | None = None, col: str = "created_at") -> DataFrame:
    """Add the load-time column: a fixed run timestamp when given (replayable,
    testable), else the query's current timestamp."""
    return df.withColumn(col, load_time(run_ts))


def load_time(run_ts: str | None = None) -> Column:
    """The given run time, or else the current time in UTC whatever the
    session's zone (local clocks going back would put new rows below the
    watermark)."""
    if run_ts is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return F.lit(run_ts).cast("timestamp_ntz")
