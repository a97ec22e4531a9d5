"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "antecede", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for. Any keyword in
    ``conf`` (dots written as ``__``) overrides or adds a setting."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call-site capture on every Column call: most of the time it takes to
        # build a wide plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def sized_for(shuffle_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a job that shuffles this much: partitions start at about
    ``partition_bytes`` each, and AQE folds those that turn out small. 100 TB at
    the default gives some 800,000."""
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark__sql__shuffle__partitions": str(partitions),
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
        "spark__sql__files__maxPartitionBytes": str(2 * partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only where that is unset (a local test session) is
    a folder of our own made; a cluster must name one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="antecede-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder, read back: cuts the plan
    behind it, is computed once for any number of readers, and survives lost
    executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
