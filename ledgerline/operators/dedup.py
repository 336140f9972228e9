"""Latest record per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], ts: str, ties: str = "keep") -> DataFrame:
    """Rows carrying the latest ``ts`` of their key.

    ``ties="keep"`` (the pipeline's rule): exact duplicate rows are removed,
    every distinct row at the maximum time is kept, and a key whose times
    are all NULL yields nothing.  Plan: the per-key maximum is a partially
    aggregated ``groupBy`` (tiny, skew-proof); rows are semi-joined to it on
    (key, time), which shuffles them by (key, time) - a hot key's rows are
    spread by their times - and the duplicate removal afterwards reuses
    that partitioning (no second shuffle of the rows).

    ``ties="one"``: exactly one row per key, the maximum of
    ``(ts, other columns...)`` - a total order, so the answer is
    deterministic.  One aggregation with map-side combine; no join, no sort.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if ties == "keep":
        latest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
        return df.join(latest, [*keys, ts], "left_semi").dropDuplicates()
    if ties == "one":
        others = [c for c in df.columns if c not in keys and c != ts]
        best = (df.where(F.col(ts).isNotNull()).groupBy(*keys)
                .agg(F.max(F.struct(ts, *others)).alias("__best")))
        return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in [ts, *others]]).select(*df.columns)
    raise ValueError(f"ties must be 'keep' or 'one', not {ties!r}")
