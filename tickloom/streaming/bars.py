"""Bar streams from files, and counts by date kept up to date by a query with a checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickloom.session import staging_path

MOST_DATES = 10_000  # dates of a batch that are named in a filter


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "csv",
    pattern: str | None = None,
    files_per_trigger: int = 1,
) -> DataFrame:
    """Unbounded table over the files of a folder, ``files_per_trigger`` files per micro-batch."""
    reader = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
    )
    if file_format == "csv":
        # a header with other names, order or count raises
        reader = reader.option("header", True).option("enforceSchema", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def count_by_date(
    stream: DataFrame, moment: str = "date", key: Column | None = None, delay: str | None = None
) -> DataFrame:
    """Rows per ``date``: the day of ``moment``, or any ``key``.

    With ``delay`` a watermark drops finished days from the state; append mode then emits each day
    once, after the watermark has passed it.
    """
    rows = stream.withColumn("__moment", F.col(moment).cast("timestamp"))
    if delay is None:
        return rows.groupBy((F.to_date("__moment") if key is None else key).alias("date")).count()
    day = F.window("__moment", "1 day")
    return (
        rows.withWatermark("__moment", delay)
        .groupBy(day.alias("day"))
        .count()
        .select(F.to_date("day.start").alias("date"), "count")
    )


def _snapshots(spark: SparkSession, root: str) -> list[int]:
    """Batch numbers of the written snapshots, ascending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/counts")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return sorted(int(f.getPath().getName().removeprefix("batch=")) for f in system.listStatus(path))


def _forget(spark: SparkSession, root: str, batch: int) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/counts/batch={batch}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run_counts(counts: DataFrame, path: str | None = None) -> DataFrame:
    """Run a count to the end of the available files and return its newest value per date.

    ``path`` holds the checkpoint and the counts, so a later call with the same path goes on where
    this one ended. Each micro-batch writes a whole snapshot, the one before with the changed dates
    replaced; a repeated batch replaces its own snapshot, and only the last two are kept.
    """
    spark = counts.sparkSession
    root = path or staging_path(spark, "counts")

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier = [b for b in _snapshots(spark, root) if b < batch_id]
        merged = batch
        if earlier:
            before = spark.read.schema(counts.schema).parquet(f"{root}/counts/batch={earlier[-1]}")
            merged = before.join(batch.select("date"), "date", "left_anti").unionByName(batch)
        merged.write.mode("overwrite").parquet(f"{root}/counts/batch={batch_id}")
        for old in earlier[:-1]:
            _forget(spark, root, old)

    running = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    found = _snapshots(spark, root)
    if not found:
        return spark.createDataFrame([], counts.schema)
    return spark.read.schema(counts.schema).parquet(f"{root}/counts/batch={found[-1]}")


def run_append(finished: DataFrame, path: str | None = None) -> DataFrame:
    """Run an append-mode query to the end of the available files into parquet and read the output.

    ``path`` holds the checkpoint and the output, so a later call with the same path goes on.
    """
    spark = finished.sparkSession
    root = path or staging_path(spark, "finished")
    running = (
        finished.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    running.awaitTermination()
    return spark.read.schema(finished.schema).parquet(f"{root}/out")


class UpsertStore:
    """Rows by key in a folder partitioned by date, kept up to date by micro-batches.

    A batch rewrites the dates it touches and no others. Its number is written to ``commits`` when
    it is done: a batch that comes again is left out if it is there, else it is done anew with the same
    result. A reader during a batch sees each date as before or after it. ``partition`` is one of the columns
    of every batch and decides where a row lies; a key must not move from one date to another.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], partition: str):
        self.spark, self.root, self.schema, self.keys, self.partition = spark, root, schema, list(keys), partition
        # columns of partitions come last
        self.columns = [f.name for f in schema.fields if f.name != partition] + [partition]

    def _system(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def read(self) -> DataFrame:
        """All rows as of the last batch."""
        path, system = self._system(f"{self.root}/data")
        if not system.exists(path):
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([self.schema[c] for c in self.columns])
        return self.spark.read.schema(stored).parquet(f"{self.root}/data").select(*self.schema.names)

    def committed(self, batch_id: int) -> bool:
        path, system = self._system(f"{self.root}/commits/{batch_id}")
        return system.exists(path)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Puts the rows of ``batch``, one for each key, in the place of earlier ones."""
        if self.committed(batch_id):
            return
        batch = batch.select(*self.columns).persist()
        try:
            dates = [r[0] for r in batch.select(self.partition).distinct().limit(MOST_DATES + 1).collect()]
            stored = self.read().select(*self.columns)
            if len(dates) <= MOST_DATES:
                stored = stored.filter(F.col(self.partition).isin(dates))  # no other folder is listed or read
            else:
                stored = stored.join(batch.select(self.partition).distinct(), self.partition, "left_semi").select(*self.columns)
            merged = stored.join(batch.select(*self.keys), self.keys, "left_anti").select(*self.columns).unionByName(batch)
            merged.repartition(self.partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                self.partition
            ).parquet(f"{self.root}/data")
        finally:
            batch.unpersist()
        path, system = self._system(f"{self.root}/commits/{batch_id}")
        system.create(path, True).close()


def run_upserts(result: DataFrame, keys: Sequence[str], partition: str, path: str | None = None) -> UpsertStore:
    """Run a stateful query to the end of the available files into a store; a later call with the same path goes on."""
    spark = result.sparkSession
    root = path or staging_path(spark, "store")
    store = UpsertStore(spark, root, result.schema, keys, partition)
    running = (
        result.writeStream.outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(store.upsert)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return store
