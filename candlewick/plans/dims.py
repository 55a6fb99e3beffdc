"""Dimensions: versioned assets, calendar, sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import values as V
from ..functions.scalars import date_key
from ..operators.incremental import scd2_apply
from ..session import literal


def asset_snapshot(spot: DataFrame, stocks: DataFrame) -> DataFrame:
    """Every asset with its type and the first and last day it was seen."""

    def seen(feed: DataFrame, key: str, asset_type: str) -> DataFrame:
        days = feed.groupBy(F.col(key).alias("asset_id")).agg(
            F.min("date").alias("first_seen"), F.max("date").alias("last_seen")
        )
        return days.select(
            "asset_id",
            F.col("asset_id").alias("symbol"),
            F.lit(asset_type).alias("asset_type"),
            "first_seen",
            "last_seen",
        )

    return seen(spot, "coin_id", V.CRYPTO).unionByName(seen(stocks, "symbol", V.STOCK))


def dim_asset(snapshot: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """The asset dimension after ``snapshot``; ``current`` is its last state."""
    return scd2_apply(
        current,
        snapshot,
        key="asset_id",
        tracked=["symbol", "asset_type"],
        first_seen="first_seen",
        last_seen="last_seen",
        surrogate="asset_key",
    )


def dim_date(unified: DataFrame, stocks: DataFrame) -> DataFrame:
    """One row per day that any feed has, with calendar attributes."""
    # Distinct per feed first: the union then shuffles days, not rows.
    dates = unified.select("date").distinct().union(stocks.select("date").distinct()).distinct()
    d = F.col("date")
    return dates.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.day(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.weekofyear(d).alias("week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def dim_source(spark: SparkSession) -> DataFrame:
    """The three sources, numbered by name."""
    names = sorted(V.SOURCE_NAMES.values())
    return literal(spark, list(enumerate(names, 1)), "source_key int, source_name string")
