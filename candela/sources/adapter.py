"""Adapter from the driver's ``events`` table to the trade schema.

    symbol        <- event_type
    trade_id      <- event_id
    trade_time    <- ts (TIMESTAMP_NTZ kept; window() is zone-free on it)
    price         <- cast(value as decimal(18,8))
    quantity      <- cast(props.k as decimal(18,8))
    is_buyer_maker<- user_id % 2 = 0
    arrival_seq   <- event_id + 13 * (event_id % 5)   (disordered arrival, for lateness)
    part          <- user_id % 3                      (source partition, for lateness)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schemas import PRICE, QTY


#: Session setting: deal the raw rows of a table over so many partitions. Off unless set.
SCAN_PARTITIONS = "candela.scan.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it lies: its splits are the scan's tasks.

    A caller whose table is one unsplittable file (one parquet row group) can set
    ``candela.scan.partitions`` to spread its rows evenly at the price of one
    exchange. Nothing looks at the table's or the cluster's size.
    """
    df = _table(spark, sf_dir, name)
    n = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame) -> DataFrame:
    cols = {
        "event_type": "'trade'",
        "event_time": "ts",
        "symbol": "event_type",
        "trade_id": "event_id",
        "price": f"CAST(value AS {PRICE})",
        "quantity": f"try_cast(get_json_object(props, '$.k') AS {QTY})",
        "buyer_order_id": "CAST(NULL AS BIGINT)",
        "seller_order_id": "CAST(NULL AS BIGINT)",
        "trade_time": "ts",
        "is_buyer_maker": "user_id % 2 = 0",
        "arrival_seq": "event_id + 13 * (event_id % 5)",
        "part": "user_id % 3",
    }
    return events.select(*[F.expr(e).alias(n) for n, e in cols.items()])


def load_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(read_table(spark, sf_dir, "events"))
