"""Joins by their definition: all pairs of a key, for comparison on small inputs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_versions_all(facts: DataFrame, versions: DataFrame, fact_key: str, fact_time: str,
                      version_cols: dict[str, str]) -> DataFrame:
    """Definition form: every version of the fact's tag that started at or
    before the fact time (a fact fans out over its earlier versions)."""
    v = versions.select(F.col("tag").alias("__tag"), F.col("starting_at").alias("__start"),
                        *[F.col(c).alias(a) for c, a in version_cols.items()])
    cond = (F.col(fact_key) == F.col("__tag")) & (F.col("__start") <= F.col(fact_time))
    return facts.join(v, cond, "left").drop("__tag", "__start")


def join_following_events(facts: DataFrame, events: DataFrame, fact_key: str, fact_time: str,
                          event_cols: list[str]) -> DataFrame:
    """Definition form of the referral join: every event of the buyer
    strictly after the purchase (all pairs of a key).  """
    e = events.select(F.col("user_email").alias("__email"), F.col("event_date").alias("__date"),
                      *[F.col(c) for c in event_cols])
    cond = (F.col(fact_key) == F.col("__email")) & (F.col("__date") > F.col(fact_time))
    return facts.join(e, cond, "left").withColumnRenamed("__date", "event_date").drop("__email")
