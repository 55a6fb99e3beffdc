"""Threshold labels. Each is evaluated top-down on the unrounded value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import values as V


def volatility_label(x: Column) -> Column:
    # An unknown range counts as HIGH.
    return F.when(x < 2, "LOW").when(x < 5, "MEDIUM").otherwise("HIGH")


def risk_level(cv: Column) -> Column:
    return F.when(cv < 0.05, "low").when(cv < 0.15, "medium").when(cv.isNotNull(), "high")


def is_anomaly(z: Column) -> Column:
    return F.coalesce(F.abs(z) > 2, F.lit(False))


def is_volume_spike(volume: Column, average: Column) -> Column:
    return F.coalesce((average > 0) & (volume > average * 2), F.lit(False))


def correlation_strength(c: Column) -> Column:
    return (
        F.when(c >= 0.7, "strong positive")
        .when(c >= 0.3, "moderate positive")
        .when(c > -0.3, "weak / none")
        .when(c > -0.7, "moderate negative")
        .when(c.isNotNull(), "strong negative")
    )


def pair_type(a: Column, b: Column) -> Column:
    return F.when((a == V.CRYPTO) & (b == V.CRYPTO), "Crypto-Crypto").when(
        (a == V.STOCK) & (b == V.STOCK), "Stock-Stock"
    ).otherwise("Crypto-Stock")


def asset_type(source: Column) -> Column:
    return F.when(source == V.STOCK_SOURCE, V.STOCK).otherwise(V.CRYPTO)


def source_name(source: Column) -> Column:
    """Display name; NULL for a source without one."""
    out = F.lit(None).cast("string")
    for name, display in V.SOURCE_NAMES.items():
        out = F.when(source == name, display).otherwise(out)
    return out


def performance_label(change: Column, gainer_rank: Column, loser_rank: Column) -> Column:
    up, down = change > 0, change < 0
    return (
        F.when(up & (gainer_rank == 1), "TOP GAINER")
        .when(down & (loser_rank == 1), "TOP LOSER")
        .when(up, "GAINER")
        .when(down, "LOSER")
        .otherwise("NEUTRAL")
    )
