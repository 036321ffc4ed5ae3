"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts at
# run time, skew-join splits hot partitions, UTC pins event-time semantics.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A broadcast side must stay small; anything larger goes through a
    # shuffle join chosen by AQE.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(
    app: str = "vitalis",
    cpus: int | str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitter's
    settings win because ``getOrCreate`` reuses the active session."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(
        shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    )
    conf["spark.driver.memory"] = os.environ.get("VITALIS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in
    ``spark.checkpoint.dir``; only when unset (local tests) a scratch
    folder is created and registered."""
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder would be lost with its executor.
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        # Local runs and tests only: no shared folder was configured.
        current = tempfile.mkdtemp(prefix="vitalis-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of :func:`checkpoint_dir` that nothing reads
    any more; any other path is refused."""
    base = checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{base}/vitalis-"):
        raise ValueError(f"not a scratch folder: {path}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new scratch path under the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/vitalis-{name}-{uuid.uuid4().hex}"


def materialize(df, name: str, partition_by: tuple[str, ...] = ()):
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back. Survives executor loss (unlike cached or
    locally checkpointed blocks) and lets later stages scan it cheaply;
    with ``partition_by`` a filter on those columns prunes whole folders."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


# Largest dimension broadcast to every task; beyond it, shuffle joins.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 << 20


def small_enough(df, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Proven size bound before a broadcast: rows and bytes of ``df`` from one
    aggregate with partial sums (no limit, which would send up to
    ``max_rows`` rows of each partition through one task)."""
    from pyspark.sql import functions as F
    width = F.lit(0)
    for c, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes
