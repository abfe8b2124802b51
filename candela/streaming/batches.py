"""Stateful streams as batch plans: tables of a micro-batch and tables carried to the next.

A step gets a micro-batch as a batch DataFrame and its ``BatchTables``. It
writes outputs and carries small tables (the last closes of a symbol, the
largest event time of a source partition) from one micro-batch to the next.

Why not per-key processors: a processor sees all rows of its key in one Python
worker, in no order. Here a micro-batch is planned like any table, so the order-aware
batch operators (two-level scans, blocks with a halo, top-k) run on it
unchanged, a hot key is split over tasks, and no Python runs on executors.

Exactly once (W7): everything is written to a folder named by the batch id, with
overwrite. A batch that Spark repeats after a failure reads the tables carried
by the batch *before* it and replaces its own folders, so it changes nothing.
Outputs of one batch are written before its carried tables, and Spark commits the
batch after both, so a reader that takes batches up to the newest carried one sees outputs
that belong together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candela.session import scratch_path

#: Versions of a carried table that are kept: the one to repeat a batch from, and the newest.
KEPT_VERSIONS = 2


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder wherever Hadoop reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the ``batch_id=`` folders that were written to their end, ascending."""
    system, where = _folder(spark, path)
    if not system.exists(where):
        return []
    found = []
    for status in system.listStatus(where):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("batch_id=") and system.exists(done):
            found.append(int(name.removeprefix("batch_id=")))
    return sorted(found)


class BatchTables:
    """Tables of one micro-batch under ``path``."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark, self.path, self.batch_id = spark, path, batch_id

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Writes this batch's rows of output ``name`` once and reads them back: later uses don't run the batch again."""
        path = f"{self.path}/{name}/batch_id={self.batch_id}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def carried(self, name: str, schema: T.StructType | str) -> DataFrame:
        """The table ``name`` as the batch before this one left it; empty at first."""
        older = [n for n in batch_ids(self.spark, f"{self.path}/{name}") if n < self.batch_id]
        if not older:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/batch_id={older[-1]}")

    def carry(self, name: str, df: DataFrame) -> DataFrame:
        """Leaves ``df`` to the next batch and drops versions that no repeat can need."""
        out = self.write(name, df)
        system, where = _folder(self.spark, f"{self.path}/{name}")
        for n in batch_ids(self.spark, f"{self.path}/{name}"):
            if n <= self.batch_id - KEPT_VERSIONS:
                system.delete(self.spark._jvm.org.apache.hadoop.fs.Path(where, f"batch_id={n}"), True)
        return out


Step = Callable[[DataFrame, BatchTables], None]


def start_steps(df: DataFrame, step: Step, path: str, available_now: bool = True, processing_time: str = "1 second",
                state_partitions: int | None = None) -> StreamingQuery:
    """Starts a stream whose micro-batches go through ``step``; tables lie under ``path``, the checkpoint beside them.

    Called again with the same ``path`` it goes on where it stopped.
    """
    from candela.streaming.pipeline import _StartSettings

    def run(batch: DataFrame, batch_id: int) -> None:
        step(batch, BatchTables(batch.sparkSession, path, batch_id))

    writer = df.writeStream.foreachBatch(run).option("checkpointLocation", f"{path}/checkpoint").outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    with _StartSettings(df.sparkSession, state_partitions):
        return writer.start()


def replay_in_parts(df: DataFrame, order: Column, step: Step, name: str, parts: int = 2) -> str:
    """Feeds a table to a stream part by part in ``order`` (a number), and stops and starts the stream for each.

    Returns the folder of its tables, under the checkpoint root.
    """
    spark = df.sparkSession
    source, out = scratch_path(spark, f"{name}-in"), scratch_path(spark, name)
    cuts = df.select(F.percentile_approx(order, [i / parts for i in range(1, parts)]).alias("q")).first().q or []
    part = sum((F.coalesce(order > cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for i in range(parts):
        df.filter(part == i).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        start_steps(stream, step, out).awaitTermination()
    return out


def read_output(spark: SparkSession, path: str, name: str, keep_batch: bool = False) -> DataFrame:
    """All rows of an output, over all micro-batches."""
    rows = spark.read.parquet(f"{path}/{name}")
    return rows if keep_batch else rows.drop("batch_id")


def read_carried(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The newest version of a carried table."""
    newest = batch_ids(spark, f"{path}/{name}")
    if not newest:
        raise FileNotFoundError(f"no version of {name} under {path}")
    return spark.read.parquet(f"{path}/{name}/batch_id={newest[-1]}")


def newest_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the greatest ``order`` of each key; keys may be NULL."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_newest"))
    return best.select(*keys, "_newest.*").select(*rows.columns)
