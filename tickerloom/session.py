"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ARROW_BYTES = 8 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session on one machine may name none (tests): a local folder is then made and set on the context, so that
    ``checkpoint()`` uses it as well. On a cluster that would be another folder on every executor, so it is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"name a folder that all executors share in {CHECKPOINT_DIR}; the master is {master}")
    made = tempfile.mkdtemp(prefix="tickerloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tickerloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives executor loss."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def bound_batches(df: DataFrame) -> DataFrame:
    """Let Spark hand rows to Python in batches of 8 MB, unless the session has set a bound of its own."""
    conf = df.sparkSession.conf
    bound = conf.get(_ARROW_BYTES, None)
    if bound in (None, "67108864b"):
        conf.set(_ARROW_BYTES, str(ARROW_BYTES))
    return df


def discard(stored: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more (what follows from it is stored itself)."""
    spark = stored.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stored.scratch)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over: it does when the driver collects garbage, which may else be half an hour away."""
    spark.sparkContext._jvm.System.gc()


def redistribute(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over all shuffle partitions ahead of CPU-heavy work; a set number keeps small ones apart."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
