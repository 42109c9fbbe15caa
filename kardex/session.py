"""Session helpers.

``get_session`` builds a local session for tests and the bench.  Under
``spark-submit`` it keeps what was submitted: master, memory, shuffle
partitions and every other setting that is given there win over the defaults
below.  Intermediate data goes to the folder that ``spark.checkpoint.dir``
names and nowhere else.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces partitions,
# skew-join splits hot partitions, and the broadcast threshold is an explicit,
# bounded number rather than the default guess.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "kardex",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults applied.

    ``master``, ``shuffle_partitions`` and ``extra`` are set as given.  All
    else is set only where neither ``spark-submit`` nor the running session
    has a value.
    """
    builder = SparkSession.builder.appName(app)
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    if not submitted:
        # Started as a plain Python program: a local session of its own.
        builder = (builder.master(master or os.environ.get("KARDEX_MASTER", "local[*]"))
                   .config("spark.driver.memory", os.environ.get("KARDEX_DRIVER_MEMORY", "16g"))
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
        event_dir = os.environ.get("KARDEX_EVENT_LOG_DIR")
        if event_dir:
            # Stage/task timings for profiling, read offline (no UI server).
            builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    elif master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark, DEFAULT_CONF if submitted else {"spark.sql.shuffle.partitions": "8", **DEFAULT_CONF},
                   keep=set(extra or {}))
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def apply_defaults(spark: SparkSession, conf: dict[str, str], keep: set[str] = frozenset()) -> None:
    """Set the runtime settings that the application was not given."""
    given = spark.sparkContext.getConf()
    for key, value in conf.items():
        if key not in keep and not given.contains(key):
            spark.conf.set(key, value)


def scale_session(spark: SparkSession, input_bytes: int) -> None:
    """Size shuffles for an input: ``scale_conf`` with the executors and cores
    of this application, where the application was not given other values."""
    given = spark.sparkContext.getConf()
    cores = int(given.get("spark.executor.cores", "1"))
    slots = max(spark.sparkContext.defaultParallelism, cores)
    apply_defaults(spark, scale_conf(input_bytes, -(-slots // cores), cores))


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run: enough initial shuffle partitions
    that each holds about ``target_partition_bytes`` of the input (AQE then
    coalesces small ones), never fewer than 3 waves of tasks; skew split
    above 4x the median partition.  For 100 TB on 1000 x 8 cores this gives
    ~400k initial partitions."""
    slots = max(1, executors * cores_per_executor)
    parts = max(3 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 * 1024 * 1024)),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and all
    executors must share.  Unset it is an error, because no folder of one
    machine can stand in for it; only a local session, whose driver and
    executor are one process, makes a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = getattr(spark, "sparkContext", None)
    if not folder and context is not None and context.master.startswith("local") and "cluster" not in context.master:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="kardex-"))
        return context.getCheckpointDir()
    if not folder:
        raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def staging_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for files that a job writes and reads
    again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4()}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan is reused by several downstream reports so a lost
    executor does not force recomputation from the raw scans.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
