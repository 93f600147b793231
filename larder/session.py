"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins are never hinted unless a side is bounded by construction: Spark picks broadcast or
# sort-merge from sizes, and a hot key in a sort-merge join is split by the skew rule.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # tables cached for repeated passes keep their shuffle partitions
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false",
    "spark.sql.session.timeZone": "UTC",
}

# a table folder is dealt out in at least one part per so many bytes, and a task reads so much of a shuffle or of files,
# where a row of a few small columns takes only some five bytes
PART_BYTES = 4 << 20
TASK_SHUFFLE = "16m"
TASK_FILES = 32 << 20
PARTS, ADVISORY, SIZED = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.larder.sized"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT, SPLIT_SIZED = "spark.sql.files.maxPartitionBytes", "spark.larder.split"


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Let shuffles have more parts the larger the tables are, so that a task's share stays the same, and let no task read
    more than 32 MB of files. Small tables keep the session's own numbers; parts that turn out small are merged at run time."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    parts, ours = size // PART_BYTES, spark.conf.get(SIZED, None) is not None
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        if ours or spark.conf.get(PARTS, None) is None:
            for key, value in ((PARTS, str(parts)), (ADVISORY, TASK_SHUFFLE), (SIZED, "true")):
                spark.conf.set(key, value)
        split = spark.conf.get(SPLIT)
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split) > TASK_FILES:
            spark.conf.set(SPLIT_SIZED, split)
            spark.conf.set(SPLIT, str(TASK_FILES))
    else:
        if ours:
            for key in (PARTS, ADVISORY, SIZED):
                spark.conf.unset(key)
        split = spark.conf.get(SPLIT_SIZED, None)
        if split is not None:
            spark.conf.set(SPLIT, split)
            spark.conf.unset(SPLIT_SIZED)


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one that the session names. Only a session on one machine may go without."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="larder-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: later jobs start from columnar files, not
    from the lineage, and a lost executor costs a re-read only. The shuffles of the write are deleted once it is done."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/larder-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget(*frames: DataFrame) -> None:
    """Delete tables made by ``materialize`` that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("larder-"):
                remove(df.sparkSession, folder)


def local_session(cores: str = "8", partitions: int = 8, name: str = "larder") -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
