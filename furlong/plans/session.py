"""Session settings the operators are designed for.

The operators never depend on these for correctness; they are the knobs
that make the plans scale:

* adaptive execution re-plans joins from measured sizes: a side is
  broadcast only when its shuffle output is under the adaptive broadcast
  threshold (a checked size), otherwise the join stays sort-merge;
* skew-join splitting breaks up an oversized join partition (a hot key);
* partition coalescing sizes reduce tasks from the actual data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Runtime broadcast conversion from measured shuffle sizes (the static
    # planner uses spark.sql.autoBroadcastJoinThreshold on estimates).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Checkpoints are deleted once their DataFrame is garbage-collected, so a
    # long application does not accumulate them in the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture for error messages walks the stack on every
    # Column call; plans here are built from many expressions.
    "spark.python.sql.dataFrameQueryContext.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "furlong", extra: dict | None = None) -> SparkSession:
    """A local session with :data:`SCALE_CONF` (tests, bench)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(SCALE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``, or
    one already set on the context), also set on the context so that
    ``DataFrame.checkpoint`` writes there; None when the session names none."""
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or spark.sparkContext.getCheckpointDir())
    if current and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``);
    ``fallback`` is set only when the session names none (tests)."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
