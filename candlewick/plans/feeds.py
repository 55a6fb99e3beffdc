"""From landed feeds to one long table per asset and day, and its series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import values as V
from ..functions import labels
from ..functions.scalars import null_double, pct, ratio
from ..operators.joins import map_symbols
from ..operators.windows import group_rank, rolling

FEED_COLUMNS = [
    "symbol", "date", "price", "market_cap", "total_volume",
    "open_price", "high_price", "low_price", "source",
]


def spot_daily(raw: DataFrame) -> DataFrame:
    return raw.select("coin_id", "date", "price", "market_cap", "total_volume")


def candle_metrics(raw: DataFrame) -> DataFrame:
    """Daily change and range of every candle."""
    change = F.col("close_price") - F.col("open_price")
    span = F.col("high_price") - F.col("low_price")
    return raw.select(
        "symbol",
        F.col("date").alias("trade_date"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "quote_volume",
        F.round(change, 6).alias("price_change"),
        pct(change, F.col("open_price"), 2).alias("price_change_percent"),
        pct(span, F.col("open_price"), 2).alias("volatility_pct"),
        labels.volatility_label(ratio(span, F.col("open_price")) * 100).alias("volatility_label"),
        "updated_at",
    )


def unified_feed(spot: DataFrame | None, metrics: DataFrame) -> DataFrame:
    """Spot and candle rows in one shape; candles count quote volume."""
    candles = metrics.select(
        "symbol",
        F.col("trade_date").alias("date"),
        F.col("close_price").alias("price"),
        null_double().alias("market_cap"),
        F.col("quote_volume").alias("total_volume"),
        "open_price",
        "high_price",
        "low_price",
        F.lit(V.CANDLE_SOURCE).alias("source"),
    )
    if spot is None:
        return candles
    spots = spot.select(
        F.col("coin_id").alias("symbol"),
        "date",
        "price",
        "market_cap",
        "total_volume",
        null_double().alias("open_price"),
        null_double().alias("high_price"),
        null_double().alias("low_price"),
        F.lit(V.SPOT_SOURCE).alias("source"),
    )
    return spots.unionByName(candles)


def unify_sources(unified: DataFrame, tickers: DataFrame) -> DataFrame:
    """One row per asset and day: mean price, summed volume and market cap."""
    mapped = map_symbols(unified, tickers, col="symbol", to="symbol", only_source=V.CANDLE_SOURCE)
    return mapped.groupBy("symbol", "date").agg(
        F.avg("price").alias("price"),
        F.sum("market_cap").alias("market_cap"),
        F.sum("total_volume").alias("total_volume"),
    )


def market_comparison(unified: DataFrame, stocks: DataFrame, tickers: DataFrame) -> DataFrame:
    """Crypto (sources merged) and stocks in one daily table."""
    merged = unify_sources(unified, tickers).select(
        "symbol", "date", "price", "total_volume", F.lit(V.MERGED_SOURCE).alias("source")
    )
    listed = stocks.select(
        "symbol",
        "date",
        F.col("close").alias("price"),
        F.col("volume").cast("double").alias("total_volume"),
        F.lit(V.STOCK_SOURCE).alias("source"),
    )
    return merged.unionByName(listed).withColumn("asset_type", labels.asset_type(F.col("source")))


def price_with_averages(unified: DataFrame, tickers: DataFrame) -> DataFrame:
    return averages(unify_sources(unified, tickers))


#: Rows of the longest moving average.
TREND_ROWS = 30


def averages(merged: DataFrame) -> DataFrame:
    """Moving averages of the merged feed."""
    base = merged.withColumnRenamed("symbol", "coin_id")
    days = [7, 14, TREND_ROWS]
    averaged = rolling(
        base, by="coin_id", order="date", frames={f"moving_avg_{n}d": ("avg", "price", n) for n in days}
    )
    return averaged.withColumns({f"moving_avg_{n}d": F.round(f"moving_avg_{n}d", 2) for n in days})


def asset_returns(market: DataFrame) -> DataFrame:
    """Daily return in percent; NULL on the first day or after a zero price."""
    series = W.partitionBy("symbol").orderBy(F.col("date").asc_nulls_first())
    prev = market.select(
        "symbol", "date", "asset_type", "price", F.lag("price").over(series).alias("prev_price")
    )
    return prev.withColumn(
        "daily_return_pct", pct(F.col("price") - F.col("prev_price"), F.col("prev_price"), 4)
    )


def volume_analysis(market: DataFrame) -> DataFrame:
    return rolling(
        market.select("symbol", "date", "total_volume", "asset_type"),
        by="symbol",
        order="date",
        frames={f"avg_volume_{n}d": ("avg", "total_volume", n) for n in (7, 30)},
    )


def price_volatility(market: DataFrame) -> DataFrame:
    frames = {}
    for n in (7, 30):
        frames[f"avg_price_{n}d"] = ("avg", "price", n)
        frames[f"stddev_price_{n}d"] = ("stddev", "price", n)
    return rolling(
        market.select("symbol", "date", "price", "asset_type"), by="symbol", order="date", frames=frames
    )


def top_gainers_losers(metrics: DataFrame) -> DataFrame:
    ranked = group_rank(
        metrics.select(
            "symbol", "close_price", "price_change", "price_change_percent",
            "volume", "volatility_label", "trade_date",
        ),
        by="trade_date",
        value="price_change_percent",
        high="gainer_rank",
        low="loser_rank",
    )
    return ranked.withColumn(
        "performance_label",
        labels.performance_label(F.col("price_change_percent"), F.col("gainer_rank"), F.col("loser_rank")),
    )
