"""

    python tools/measure_baseline.py [sf_dir] [replicas]

* W1 direct (one aggregation per window) vs W3 roll-up, same three windows
* first/last by packed DECIMAL(38,0) key vs struct key (HashAggregate vs SortAggregate)
* trends / alerts_all end to end
* the same on ``replicas`` copies of ``events`` (event_id, ts and symbol offset per copy),
  written once under the checkpoint root
* streaming: final bars from a file stream, input rows per second
Median of 3 warm runs into the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from candela.operators.alerts import all_alerts  # noqa: E402
from candela.operators.bars import bars, bars_multi, market_bars  # noqa: E402
from candela.operators.trends import trends  # noqa: E402
from candela.schemas import PRICE_INTERVALS  # noqa: E402
from candela.session import get_spark, scratch_path  # noqa: E402
from candela.sources.adapter import read_table, trades_from_events  # noqa: E402
from candela.streaming.pipeline import bars_stream, run_to_table, stage_replay, trades_stream_from_events  # noqa: E402


def timed(df, runs: int = 3) -> float:
    df.write.format("noop").mode("overwrite").save()
    out = []
    for _ in range(runs):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - t0)
    return round(statistics.median(out), 3)


def struct_key_bars(trades):
    g = trades.groupBy("symbol", F.window("trade_time", "1 minute").alias("w")).agg(
        F.min_by("price", F.when(F.col("price") != 0, F.struct("trade_time", "trade_id"))).alias("open"),
        F.max_by("price", F.struct("trade_time", "trade_id")).alias("close"),
        F.sum(F.col("price") * F.col("quantity")).alias("volume"),
        F.count(F.lit(1)).alias("n"),
    )
    return g


def replicate(spark, sf_dir: str, copies: int) -> str:
    ev = read_table(spark, sf_dir, "events")
    span = ev.agg(F.max("event_id")).first()[0] + 1
    # each copy: ids shifted past the previous one, times shifted by 31 days, its own symbols
    big = ev.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("event_id") + F.col("r").cast("bigint") * F.lit(span)).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("r").cast("int") * 31)).alias("ts"),
        "user_id",
        F.concat(F.col("event_type"), F.lit("_"), F.col("r").cast("string")).alias("event_type"),
        "value", "props",
    )
    path = scratch_path(spark, f"events-x{copies}")
    big.write.parquet(path)
    return path


def suite(spark, events_path: str) -> dict:
    t = trades_from_events(spark.read.parquet(events_path))
    m = market_bars(t)
    extra = [c for c in m.columns if c not in ("symbol", "window_start")]
    return {
        "rows": spark.read.parquet(events_path).count(),
        "bars_1m_packed_key": timed(bars(t)),
        "bars_1m_struct_key": timed(struct_key_bars(t)),
        "bars_3w_direct": timed(bars_multi(t, PRICE_INTERVALS, method="direct")),
        "bars_3w_rollup": timed(bars_multi(t, PRICE_INTERVALS, method="rollup")),
        "trends": timed(trends(bars(t))),
        "alerts_all": timed(all_alerts(trends(m, extra=extra))),
    }


def stream_rate(spark, events_path: str) -> dict:
    src = stage_replay(spark.read.parquet(events_path), "events-stream", files=4)
    n = spark.read.parquet(src).count()
    t0 = time.perf_counter()
    run_to_table(bars_stream(trades_stream_from_events(spark, src, max_files_per_trigger=1)), "bench-stream")
    secs = time.perf_counter() - t0
    return {"stream_bars_rows": n, "stream_bars_sec": round(secs, 3), "stream_rows_per_sec": round(n / secs)}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = get_spark()
    events = f"{sf_dir}/events.parquet"
    out = {"sf": sf_dir, "base": suite(spark, events), "stream": stream_rate(spark, events)}
    if copies > 1:
        out[f"x{copies}"] = suite(spark, replicate(spark, sf_dir, copies))
    print(json.dumps(out))


if __name__ == "__main__":
    main()
