from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from candela.schemas import TRADE_SCHEMA  # noqa: E402
from candela.streaming.pipeline import ROCKSDB  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("candela-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # what a caller sets who starts a query with processor state without the library's runner
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="candela-test-ckpt-"))
    yield s


T0 = datetime(2024, 1, 1, 0, 0, 0)


def trade(symbol="BTC", trade_id=1, t=T0, price="1", qty="1", maker=False):
    return (
        "trade", t, symbol, trade_id, Decimal(price), Decimal(qty), None, None, t, maker,
    )


def trades_df(spark, rows):
    return spark.createDataFrame(rows, TRADE_SCHEMA)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)
