"""Driver tables bound to the feeds the models read.

``candles`` and ``spot`` come from line items (trades) and parts (symbols),
``stocks`` from orders, ``ticks`` from events. ``walk`` turns the same trades
into a realistic random walk. Money is summed in whole cents, so totals do
not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import ticker_map
from ..session import configure

# STANDARDUSDT is left out on purpose: an unmapped ticker.
TEST_TICKERS = [
    ("ECONOMYUSDT", "economy"),
    ("LARGEUSDT", "large"),
    ("MEDIUMUSDT", "medium"),
    ("PROMOUSDT", "promo"),
    ("SMALLUSDT", "small"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tickers(spark: SparkSession) -> DataFrame:
    return ticker_map(spark, TEST_TICKERS)


def _cents(x: str) -> Column:
    return F.sum(F.round(F.col(x) * 100).cast("bigint")).cast("double") / 100


def _millionths(x: str) -> Column:
    return F.sum(F.round(F.col(x) * 1000000).cast("bigint")).cast("double") / 1000000


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    joined = items.join(parts, items["l_partkey"] == parts["p_partkey"])
    return joined.withColumns(
        {
            "date": F.col("l_shipdate").cast("date"),
            "unit": F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0)),
        }
    )


def candles(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    base = trades(spark, sf_dir)
    if wide:
        symbol = F.concat("p_brand", F.lit("_"), "p_type")
    else:
        symbol = F.concat(F.upper("p_type"), F.lit("USDT"))
    order = F.struct("l_orderkey", "l_linenumber", "unit")
    taken = F.col("l_linestatus") == "O"
    daily = base.groupBy(symbol.alias("symbol"), "date").agg(
        F.min_by("unit", order).alias("open_price"),
        F.max("unit").alias("high_price"),
        F.min("unit").alias("low_price"),
        F.max_by("unit", order).alias("close_price"),
        F.sum("l_quantity").alias("volume"),
        _cents("l_extendedprice").alias("quote_volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.sum(F.when(taken, F.col("l_quantity")).otherwise(0.0)).alias("taker_buy_base_vol"),
        (
            F.sum(F.when(taken, F.round(F.col("l_extendedprice") * 100).cast("bigint")).otherwise(0)).cast("double")
            / 100
        ).alias("taker_buy_quote_vol"),
    )
    close_time = (F.datediff("date", F.lit("1970-01-01")).cast("bigint") + 1) * 86400000 - 1
    return daily.select(
        "symbol", "date", "open_price", "high_price", "low_price", "close_price", "volume",
        close_time.alias("close_time"), "quote_volume", "number_of_trades",
        "taker_buy_base_vol", "taker_buy_quote_vol", F.col("date").cast("timestamp").alias("updated_at"),
    )


def spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = trades(spark, sf_dir).groupBy(F.lower("p_type").alias("coin_id"), "date").agg(
        # averaged in whole millionths, for the same reason as money
        (_millionths("unit") / F.count("unit")).alias("price"),
        _cents("l_extendedprice").alias("market_cap"),
        _cents("l_extendedprice").alias("total_volume"),
    )
    return daily.withColumn("updated_at", F.col("date").cast("timestamp"))


def walk(spark: SparkSession, sf_dir: str, digits: int | None = None) -> DataFrame:
    """Candles of a random walk; ``digits`` rounds prices like an exchange does."""
    daily = (
        trades(spark, sf_dir)
        .groupBy(F.concat(F.upper("p_type"), F.lit("USDT")).alias("symbol"), "date")
        .agg(
            (_cents("l_discount") / F.count(F.lit(1)) - 0.05).alias("_m"),
            F.sum("l_quantity").alias("volume"),
            _cents("l_extendedprice").alias("quote_volume"),
        )
    )
    series = W.partitionBy("symbol").orderBy(F.col("date").asc_nulls_first())
    price = F.exp(F.sum("_m").over(series.rowsBetween(W.unboundedPreceding, 0))) * 100
    if digits is not None:
        price = F.round(price, digits)
    priced = daily.withColumn("close_price", price)
    opened = priced.withColumn("open_price", F.coalesce(F.lag("close_price").over(series), "close_price"))
    top, bottom = F.col("close_price") * (1 + F.abs("_m")), F.col("close_price") * (1 - F.abs("_m"))
    return opened.select(
        "symbol",
        "date",
        "open_price",
        F.greatest("open_price", top).alias("high_price"),
        F.least("open_price", bottom).alias("low_price"),
        "close_price",
        "volume",
        "quote_volume",
        F.col("date").cast("timestamp").alias("updated_at"),
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("date", F.col("o_orderdate").cast("date"))
    order = F.struct("o_orderkey", "o_totalprice")
    daily = (
        orders.groupBy(F.col("o_orderpriority").alias("symbol"), "date")
        .agg(
            F.min_by("o_totalprice", order).alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", order).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )
    return daily.withColumn("updated_at", F.col("date").cast("timestamp"))


def ticks(events: DataFrame) -> DataFrame:
    """Price ticks of the event table, batch or streaming."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.lit(1.0).alias("quantity"),
    )


__all__ = ["TEST_TICKERS", "candles", "spot", "stocks", "table", "tickers", "ticks", "trades", "walk"]
