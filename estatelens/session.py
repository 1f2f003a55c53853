"""SparkSession construction and shared-storage settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings a job relies on.  Applied by ``get_spark`` for local runs and
# tests; on a cluster they belong in the submit configuration.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Broadcast only what the size check (static estimate, then AQE's
    # runtime statistics) proves small; larger sides fall back to a
    # sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "estatelens", extra: dict | None = None,
              checkpoint_dir: str | None = None,
              largest_shuffle_bytes: float | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`DEFAULT_CONF`.

    Settings given at submit time win: the defaults only fill keys the
    launcher left unset, while ``extra`` and ``shuffle_partitions`` (explicit
    caller choices) always apply.  ``master`` defaults to
    ``local[$BENCH_CPUS or 8]`` only when no launcher decides it (tests,
    bench, plain ``python``); under ``spark-submit`` the submitted master is
    kept.  ``checkpoint_dir`` is used only when the session names no
    ``spark.checkpoint.dir`` (local runs and tests).  With
    ``largest_shuffle_bytes`` the shuffles are sized by :func:`cluster_conf`
    for the cores the session has; submitted and explicit settings still win.
    """
    launched = _master_configured()
    b = SparkSession.builder.appName(app_name)
    if master is None and not launched:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        b = b.master(master)
    explicit = dict(extra or {})
    if shuffle_partitions is not None:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not launched:
        b = b.config("spark.ui.enabled", "false")
    for k, v in explicit.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    submitted = spark.sparkContext.getConf()
    defaults = dict(DEFAULT_CONF)
    if largest_shuffle_bytes is not None:
        defaults |= cluster_conf(largest_shuffle_bytes, spark.sparkContext.defaultParallelism)
    for k, v in defaults.items():
        if k in explicit or submitted.contains(k) or not spark.conf.isModifiable(k):
            continue
        spark.conf.set(k, v)
    for k, v in explicit.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)  # a reused session still gets the caller's choice
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def _master_configured() -> bool:
    """True when the launcher already decides the master: spark-submit and
    the pyspark shell start the JVM gateway first (``PYSPARK_GATEWAY_PORT``)
    and pass ``--master`` to it; an explicit ``spark.master`` counts too."""
    from pyspark import SparkConf

    if os.environ.get("PYSPARK_GATEWAY_PORT") or os.environ.get("SPARK_MASTER"):
        return True
    return SparkConf().contains("spark.master")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    The session's setting always wins; ``fallback`` is registered only when
    nothing is set (local tests).  With neither, checkpointing jobs keep
    their lineage instead of writing to a machine-local folder."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and fallback:
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    if d and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(largest_shuffle_bytes: float, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run.

    AQE can merge small shuffle partitions but never split large ones, so
    the initial partition count must fit the *largest* shuffle: enough
    partitions that each holds about ``target_partition_bytes`` (it then
    sorts and aggregates in executor memory without heavy spilling), and at
    least three waves of tasks over all cores.  Smaller stages are coalesced
    back to the advisory size at run time.

    Example: the largest shuffle of these jobs is a projected fact table
    (listings/offers/price history, a few key and measure columns).  At
    100 TB of input that is a few TB; ``cluster_conf(4e12, 4000)`` gives
    14,902 initial partitions.
    """
    n = max(3 * total_cores, int(-(-largest_shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        # coalesce to the advisory size rather than keeping many tiny
        # partitions (measured slower on one 8-core machine, where
        # parallelism matters more than task count; right for a cluster)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }
