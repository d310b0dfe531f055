"""Session helpers.

``local_session`` is for tests and the bench only; on a cluster the caller
owns the session and its settings.  ``checkpoint_dir`` reads the shared
checkpoint location from the session and only falls back to a fresh local
scratch folder when none is configured (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on; applied to local sessions and recommended
# for clusters (AQE re-plans joins from runtime sizes and splits skew).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when the next operator relies on
    # the join's partitioning (costs one extra shuffle only when skew is seen)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of line data.

    The line table is shuffled about twice at roughly its own size, so the
    initial shuffle width aims at ``partition_bytes`` per partition (AQE then
    coalesces small partitions and splits skewed ones); scans are cut at the
    same size.  Pass the result to ``SparkSession.builder.config(map=...)``.
    """
    width = max(2 * total_cores, -(-int(input_bytes) // int(partition_bytes)))
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    })
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cartwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_on(master: str, app: str = "cartwise") -> SparkSession:
    """A session on a cluster; its other settings come from the environment."""
    return (SparkSession.builder.master(master).appName(app)
            .config(map=RECOMMENDED_CONF).getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` or the context's checkpoint folder when the
    cluster names one.  With neither set, a local master gets a fresh scratch
    folder (tests, local runs); any other master is an error, as executors
    could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cartwise-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


# Rows of narrow lines that one task sorts and groups, at about 300 bytes each.
TASK_ROWS = 500_000


def spread(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by ``columns``, about ``TASK_ROWS`` a task.

    Adaptive execution sizes tasks by shuffled bytes.  Ordered ids compress to a few
    bytes a row there and take a hundred times that in a task's memory, so tasks on
    them grow with the input; these are sized by rows.  Few rows are left to the
    session.  For keys without hot values only: such partitions are never split.
    """
    few = TASK_ROWS * df.sparkSession.sparkContext.defaultParallelism
    return df if rows <= few else df.repartition(-(-rows // TASK_ROWS), *columns)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call or application uses."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark)}/cartwise-{app}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a written table, in whatever file system holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this application.  Call it only when no
    frame that reads them is used any more."""
    delete_path(spark, f"{checkpoint_dir(spark)}/cartwise-{spark.sparkContext.applicationId}")
