"""Scoring of forecasts against what happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..operators.joins import map_symbols, pit_join
from ..operators.windows import autocorrelation
from ..operators.writes import upsert

FORECAST_KEY = ["symbol", "target_date", "target_name", "model_name", "horizon_days"]


def store_forecasts(stored: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Stored forecasts after a run: one row per key, values to 8 digits."""
    rows = forecasts.withColumn("predicted_value", F.round("predicted_value", 8)).select(*stored.columns)
    return upsert(stored, rows, keys=FORECAST_KEY, order_by=None)


def fact_forecast_detail(
    forecasts: DataFrame,
    metrics: DataFrame,
    tickers: DataFrame,
    dim_asset: DataFrame,
    dim_date: DataFrame,
    *,
    as_of: Column,
) -> DataFrame:
    """One row per forecast whose target day is over, with its errors."""
    actuals = metrics.filter(F.col("trade_date") < as_of).select(
        "symbol",
        F.col("trade_date").alias("target_date"),
        F.col("close_price").alias("_price"),
        F.col("volatility_pct").alias("_volatility"),
        F.col("quote_volume").alias("_volume"),
    )
    name = F.col("target_name")
    actual = (
        F.when(name == "price", F.col("_price"))
        .when(name == "volatility", F.col("_volatility"))
        .when(name == "volume", F.col("_volume"))
    )
    scored = forecasts.join(actuals, ["symbol", "target_date"]).withColumn("actual_value", actual)
    # a ticker without an asset is not scored
    scored = map_symbols(scored, tickers, col="symbol", keep_unmapped=False)
    keyed = pit_join(scored, dim_asset, key="asset_id", date="target_date")
    days = dim_date.select("date_key", F.col("full_date").alias("target_date"))
    error = F.col("actual_value") - F.col("predicted_value")
    return keyed.join(days, "target_date").select(
        "asset_key", "date_key", "asset_id", "symbol", "target_date", "target_name",
        "model_name", "horizon_days", "model_params",
        F.round("predicted_value", 8).alias("predicted_value"),
        F.round("actual_value", 8).alias("actual_value"),
        F.round(error, 8).alias("error"),
        F.round(F.abs(error), 8).alias("abs_error"),
        F.round(ratio(F.abs(error), F.col("actual_value")) * 100, 4).alias("abs_pct_error"),
    )


def fact_forecast_accuracy(detail: DataFrame, *, baseline: str = "naive") -> DataFrame:
    """Errors per asset, target, model and horizon, compared with the baseline.

    The baseline of the same asset, target and horizon is looked up with a
    window over the few rows the aggregate leaves, not a join of it with
    itself. Errors have eight digits, so they are summed as decimals and the
    result does not depend on the order of rows.
    """
    exact = {c: F.col(c).cast("decimal(28,8)") for c in ("abs_error", "abs_pct_error")}
    n = F.count("abs_error")
    per_model = detail.groupBy(
        "asset_key", "asset_id", "symbol", "target_name", "model_name", "horizon_days"
    ).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        (F.sum(exact["abs_error"]).cast("double") / n).alias("mae"),
        F.sqrt(F.sum(F.col("error") * F.col("error")) / n).alias("rmse"),
        (F.sum(exact["abs_pct_error"]).cast("double") / F.count("abs_pct_error")).alias("mape"),
    )
    same = W.partitionBy("asset_key", "symbol", "target_name", "horizon_days")
    base = F.max(F.when(F.col("model_name") == baseline, F.col("mae"))).over(same)
    return per_model.withColumn("_base", base).select(
        "asset_key", "asset_id", "symbol", "target_name", "model_name", "horizon_days", "n_predictions",
        F.round("mae", 6).alias("mae"),
        F.round("rmse", 6).alias("rmse"),
        F.round("mape", 4).alias("mape"),
        F.round(ratio(F.col("_base") - F.col("mae"), F.col("_base")) * 100, 2).alias("vs_naive_pct"),
    )


def leaderboard(accuracy: DataFrame) -> DataFrame:
    """Per target and model: mean over assets of MAPE and gain on naive.

    Both are decimals of a few digits, so they are averaged as such.
    """
    return accuracy.groupBy("target_name", "model_name").agg(
        F.count(F.lit(1)).alias("assets"),
        F.sum("n_predictions").alias("n_predictions"),
        F.round(F.avg(F.col("mape").cast("decimal(18,4)")), 3).cast("double").alias("mean_mape"),
        F.round(F.avg(F.col("vs_naive_pct").cast("decimal(18,2)")), 2).cast("double").alias("mean_vs_naive_pct"),
    )


def return_autocorrelation(returns: DataFrame, lags: list[int]) -> DataFrame:
    """Lag correlations of daily returns and of their size, per asset."""
    return autocorrelation(returns, by="symbol", order="date", col="daily_return_pct", lags=lags)
