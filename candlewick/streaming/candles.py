"""Ticks to daily candles, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.writes import merge_table, upsert
from ..session import configure

CANDLE_SCHEMA = (
    "symbol string, date date, open_price double, high_price double, low_price double, "
    "close_price double, volume double, quote_volume double, number_of_trades bigint"
)
CANDLE_KEY = ["symbol", "date"]


def tick_candles(ticks: DataFrame, *, width: str = "1 day", lateness: str = "3 days") -> DataFrame:
    """Candles per symbol and window of (symbol, ts, price, quantity) ticks.

    Works on a stream or a batch. Ticks later than ``lateness`` are dropped
    and older windows leave the state, which holds one small row per open
    window and symbol; ticks are combined before the shuffle, so a busy
    symbol sends one row per task.
    """
    order = F.struct("ts", "price")
    grouped = ticks.withWatermark("ts", lateness).groupBy(F.window("ts", width), "symbol")
    candles = grouped.agg(
        F.min_by("price", order).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", order).alias("close_price"),
        F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("quote_volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
    )
    return candles.withColumn("date", F.col("window.start").cast("date")).drop("window")


def stream_candles(
    ticks: DataFrame,
    *,
    sink: str,
    checkpoint: str,
    width: str = "1 day",
    lateness: str = "3 days",
) -> StreamingQuery:
    """Keep the candle table at ``sink`` up to date with a tick stream.

    ``checkpoint`` belongs to the sink and is kept with it: a stream that
    starts without it reads its source again with an empty state.

    Each micro-batch replaces the candles it changed, by (symbol, date);
    a repeated batch writes the same rows again.
    """
    configure(ticks.sparkSession)

    def write(batch: DataFrame, _: int) -> None:
        merge_table(
            batch.sparkSession,
            sink,
            batch,
            schema=CANDLE_SCHEMA,
            month_of="date",
            merge=lambda target, rows: upsert(target, rows, keys=CANDLE_KEY, order_by="number_of_trades"),
        )

    return (
        tick_candles(ticks, width=width, lateness=lateness)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
