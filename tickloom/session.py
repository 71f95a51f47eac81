"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and ``bench.py``; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


_written: list[str] = []


def staging_path(spark: SparkSession, label: str) -> str:
    """New path in the shared folder, remembered for ``clear_staged``."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear_staged(spark: SparkSession) -> None:
    """Delete what this program wrote to the shared folder; results that still read it become invalid."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while _written:
        path = hadoop(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, keeps column pruning, and gives the planner the
    measured size, so Spark's own broadcast threshold decides about joins with the result.
    ``partition_by`` lets later filters on these columns skip the other folders.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def stage_instead(df: DataFrame, label: str, old: str | None) -> tuple[DataFrame, str]:
    """As ``stage``, for a table that takes the place of the one at ``old``, which is deleted; also gives the path."""
    spark = df.sparkSession
    staged = stage(df, label)
    if old is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _written.remove(old)
    return staged, _written[-1]
