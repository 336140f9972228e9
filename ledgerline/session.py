"""Spark session defaults and shared-folder helpers.

Cluster jobs get their session from the platform; the only thing this
module adds there is :func:`shared_dir`, which resolves the shared folder
named by ``spark.checkpoint.dir``.  Local runs (tests, bench) build a
session with :func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins and
# coalesces/splits partitions at runtime; its skew-join split covers inner and
# left joins (a full outer join, as MERGE uses, is never split: its keys are
# unique on the source side and rows without a key do not enter the join).
# Every timestamp in the pipeline is TIMESTAMP_NTZ and every function used
# on it is zone-independent, so the session time zone is left as it is.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEM", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", os.environ.get("LEDGERLINE_TZ", "UTC"))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


# Private checkpoint folders of local sessions without the setting, by application.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach; it is
    read from the session and never set or replaced.  Where it is unset, a
    local master (tests) gets a private temporary folder; any other master
    raises, since a machine-local folder would lose data there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL_DIRS.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        _LOCAL_DIRS[sc.applicationId] = base
    return base.rstrip("/") + "/" + (name or "tmp") + "-" + uuid.uuid4().hex[:12]


def missing(error: Exception) -> bool:
    """Whether Spark failed because a path or its files are not there (and for no other reason)."""
    condition = getattr(error, "getCondition", lambda: None)()
    return condition in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _context(spark: SparkSession):
    """The SparkContext, or None in a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no context
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return max(sc.defaultParallelism, 1)
    return int(spark.conf.get("spark.default.parallelism", "8"))


#: Codec of the files the library writes: read back once or a few times, so bytes count for more than the time to pack them.
CODEC = "zstd"


def materialize(df, name: str = "stage"):
    """Cut the lineage of ``df``: write it once as parquet to a fresh folder
    under the shared checkpoint folder and continue from the written copy
    (one job; survives executor loss; used where a plan would otherwise
    recompute an expensive input)."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)
