"""Session helpers: a local session for tests/bench and lineage cuts.

On a cluster the caller owns the session; nothing here overrides settings that
are already present.  ``spark.checkpoint.dir`` in particular is read from the
session and only filled in when it is unset (local tests).
"""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "stagewise") -> SparkSession:
    """A local[N] session with AQE on and the UI off (tests and bench only)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _local_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the checkpoint folder named by the session (``spark.checkpoint.dir``).

    Library code never invents one: on a cluster it must be a shared folder, so
    a missing setting is an error.  Only :func:`local_session` (tests, bench)
    fills in a scratch folder, and only when the setting is unset.
    """
    d = checkpoint_dir(spark)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                           "(or use materialize_mode='persist')")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def _local_checkpoint_dir(spark: SparkSession) -> None:
    """Local sessions only: scratch checkpoint folder when none is configured."""
    if not checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stagewise-ckpt-"))
    ensure_checkpoint_dir(spark)


def materialize(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """Cut lineage of a frame that several reports re-read.

    ``checkpoint``: reliable checkpoint into the shared checkpoint dir; survives
    executor loss without recomputing the upstream joins.
    ``persist``: MEMORY_AND_DISK cache; lost blocks are recomputed from lineage.
    ``none``: return the lazy frame unchanged.
    """
    if mode == "none":
        return df
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialize mode {mode!r}")
