"""Keyed JSON record sources and sinks.

The reference moves every stream through Kafka topics as (key, JSON value).
Here a stream is a DataFrame; at a boundary it becomes (key, value) records:

* ``to_records``: value = ``to_json(struct(*))``, key = ``symbol-interval`` (or symbol).
* ``from_records``: parse values back with the table's schema.
* ``write_records`` / ``read_records``: batch twin on files (JSON lines or parquet),
  partitioned by symbol so per-symbol reads prune partitions (S9).
* ``kafka_stream`` / ``kafka_sink``: the same records on Kafka. The Kafka connector
  is not part of the PySpark distribution; these need
  ``spark-sql-kafka-0-10`` on the classpath and are not exercised by the tests.
  ``startingOffsets="latest"`` mirrors the display consumers (S8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Timestamps keep their microseconds on the way through JSON.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def record_key(df: DataFrame) -> F.Column:
    if "interval" in df.columns:
        return F.concat_ws("-", F.col("symbol"), F.col("interval"))
    return F.col("symbol")


def to_records(df: DataFrame) -> DataFrame:
    """(key, value) records: value is the JSON object of the row."""
    return df.select(record_key(df).alias("key"), F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value"))


def from_records(records: DataFrame, schema: T.StructType | str, keep_key: bool = True) -> DataFrame:
    parsed = records.select(*(["key"] if keep_key else []), F.from_json("value", schema, JSON_OPTIONS).alias("_r"))
    return parsed.select(*(["key"] if keep_key else []), "_r.*")


def write_records(df: DataFrame, path: str, fmt: str = "json", partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_records(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | str | None = None
                 ) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def publish_records(records: DataFrame, route: F.Column, path: str) -> None:
    """Routes (key, value) records into one folder per symbol, the file twin of a topic per symbol.

    ``route`` says where a record goes; a NULL symbol has a folder of its own.
    """
    write_records(records.withColumn("route", route), path, partition_by=["route"])


def subscribe(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """(route, key, value) records; with ``symbol`` only that symbol's folder is read."""
    records = read_records(spark, path, schema="key string, value string, route string")
    return records if symbol is None else records.filter(F.col("route") == symbol)


def store_series(df: DataFrame, path: str, time_col: str = "trade_time", mode: str = "overwrite") -> None:
    """A table stored for reading one symbol and a time range of it: a folder per symbol, sorted by time.

    Rows are ranged by (symbol, time) first, so that each file is one time range of a symbol and
    a symbol with many rows is spread over several tasks and files.
    """
    ranged = df.withColumn("route", F.col("symbol")).repartitionByRange("route", time_col)
    ranged.sortWithinPartitions("route", time_col).write.mode(mode).partitionBy("route").parquet(path)


def read_series(spark: SparkSession, path: str, symbol: str | None = None, since=None, until=None,
                time_col: str = "trade_time") -> DataFrame:
    """Rows of ``store_series``. ``symbol`` prunes folders, ``since`` (inclusive) and ``until`` (exclusive) row groups."""
    rows = spark.read.parquet(path).withColumn("route", F.col("route").cast("string"))
    if symbol is not None:
        rows = rows.filter(F.col("route") == symbol)
    if since is not None:
        rows = rows.filter(F.col(time_col) >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col(time_col) < F.lit(until))
    return rows.drop("route")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Raw wire messages, one per line, as a ``value`` column (the shape of a Kafka value)."""
    return spark.read.text(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest") -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp")
    )


def kafka_sink(records: DataFrame, servers: str, topic: str, checkpoint: str):
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .start()
    )
