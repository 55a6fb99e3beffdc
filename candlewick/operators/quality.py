"""Declarative checks over tables.

A check is (kind, table, column, argument). All not_null, accepted_values and
relationships checks of a table run in one scan of it; references and unique
keys count per key first, so a key with very many rows is one row by the time it
is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import values as V
from ..session import literal


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, unique, relationships, accepted_values, unique_key, no_overlap
    model: str
    column: str
    arg: tuple = ()


def _not_null(model: str, *columns: str) -> list[Check]:
    return [Check("not_null", model, c) for c in columns]


def _refers(model: str, **parents: tuple[str, str]) -> list[Check]:
    return [Check("relationships", model, c, parent) for c, parent in parents.items()]


def _unique(model: str, *columns: str) -> list[Check]:
    return [Check("unique", model, c) for c in columns]


def _accepts(model: str, column: str, allowed: list) -> Check:
    return Check("accepted_values", model, column, tuple(allowed))


_ASSET = ("dim_asset", "asset_key")
_DATE = ("dim_date", "date_key")
_FLAG = [True, False]


def mart_checks() -> list[Check]:
    """The checks every build of the marts must pass."""
    checks: list[Check] = []
    checks += _not_null("dim_date", "date_key", "full_date") + _unique("dim_date", "date_key", "full_date")
    checks += _not_null("dim_source", "source_key", "source_name")
    checks += _unique("dim_source", "source_key", "source_name")
    checks += _unique("dim_asset", "asset_key")
    checks += _not_null(
        "dim_asset", "asset_key", "asset_id", "symbol", "asset_type", "valid_from", "is_current"
    )
    checks.append(_accepts("dim_asset", "is_current", _FLAG))
    checks += _not_null("fact_market_prices", "asset_key", "date_key", "source_key", "price", "total_volume")
    checks += _refers(
        "fact_market_prices", asset_key=_ASSET, date_key=_DATE, source_key=("dim_source", "source_key")
    )
    checks += _not_null(
        "fact_price_trends", "asset_key", "date_key", "moving_avg_7d", "moving_avg_14d", "moving_avg_30d"
    )
    checks += _not_null("fact_volume_analysis", "asset_key", "date_key", "is_volume_spike")
    checks.append(_accepts("fact_volume_analysis", "is_volume_spike", _FLAG))
    checks += _not_null("fact_market_volatility", "asset_key", "date_key", "is_anomaly")
    checks.append(_accepts("fact_market_volatility", "is_anomaly", _FLAG))
    checks.append(_accepts("fact_market_volatility", "risk_level", V.RISK_LEVELS))
    for fact in ("fact_price_trends", "fact_volume_analysis", "fact_market_volatility", "fact_forecast_detail"):
        checks += _refers(fact, asset_key=_ASSET, date_key=_DATE)
    checks += _not_null("fact_market_alerts", "symbol", "date", "alert_type", "alert_message")
    checks += _refers("fact_market_alerts", symbol=("dim_asset", "asset_id"))
    checks.append(_accepts("fact_market_alerts", "alert_type", V.ALERT_TYPES))
    checks += _not_null(
        "fact_asset_correlation", "asset_key_a", "asset_key_b", "date_key", "symbol_a", "symbol_b",
        "pair_type", "observations_30d", "observations_90d",
    )
    checks += _refers("fact_asset_correlation", asset_key_a=_ASSET, asset_key_b=_ASSET, date_key=_DATE)
    checks.append(_accepts("fact_asset_correlation", "pair_type", V.PAIR_TYPES))
    checks.append(_accepts("fact_asset_correlation", "correlation_strength_30d", V.STRENGTHS))
    checks += _not_null(
        "fact_forecast_detail", "asset_key", "date_key", "target_name", "model_name",
        "predicted_value", "actual_value", "abs_pct_error",
    )
    checks += _not_null(
        "fact_forecast_accuracy", "asset_key", "asset_id", "symbol", "target_name", "model_name",
        "horizon_days", "n_predictions", "mae", "rmse", "mape",
    )
    checks += _refers("fact_forecast_accuracy", asset_key=_ASSET, asset_id=("dim_asset", "asset_id"))
    for fact in ("fact_forecast_detail", "fact_forecast_accuracy"):
        checks.append(_accepts(fact, "target_name", V.TARGET_NAMES))
        checks.append(_accepts(fact, "model_name", V.MODEL_NAMES))
    return checks


def invariant_checks() -> list[Check]:
    """Keys that must be unique together, and versions that must not overlap."""
    keys = {
        "fact_market_prices": ["asset_key", "date_key", "source_key"],
        "fact_price_trends": ["asset_key", "date_key"],
        "fact_volume_analysis": ["asset_key", "date_key"],
        "fact_market_volatility": ["asset_key", "date_key"],
        "fact_asset_correlation": ["asset_key_a", "asset_key_b", "date_key"],
    }
    checks = [Check("unique_key", model, ", ".join(k), tuple(k)) for model, k in keys.items()]
    checks.append(Check("no_overlap", "dim_asset", "asset_id", ("valid_from", "valid_to")))
    return checks


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def _in_one_pass(table: DataFrame, checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Rows that fail not_null, accepted_values or relationships: one scan of the table for all of them.

    A row gives one item per check it fails, or whose reference is still to be
    looked up; items are counted per check and key before anything is joined.
    """
    items, known = [], []
    for i, check in enumerate(checks):
        c = F.col(check.column)
        if check.kind == "relationships":
            parent, field = check.arg
            items.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("i"), c.cast("string").alias("key"))))
            keys = tables[parent].select(F.lit(i).alias("i"), F.col(field).cast("string").alias("key"))
            known.append(keys.distinct())
        else:
            bad = c.isNull() if check.kind == "not_null" else c.isNotNull() & ~c.isin(*check.arg)
            items.append(F.when(bad, F.struct(F.lit(i).alias("i"), F.lit(None).cast("string").alias("key"))))
    found = table.select(F.explode(F.array_compact(F.array(*items))).alias("x")).groupBy("x.i", "x.key").agg(
        F.count(F.lit(1)).alias("n")
    )
    if known:
        found = found.join(reduce(DataFrame.unionByName, known), ["i", "key"], "left_anti")
    counts = found.groupBy("i").agg(F.sum("n").alias("failures"))
    names = [(i, c.kind, c.model, c.column) for i, c in enumerate(checks)]
    listed = literal(table.sparkSession, names, "i int, check string, model string, column string")
    return listed.join(counts, "i", "left").select(
        "check", "model", "column", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )


def _repeated(table: DataFrame, check: Check) -> DataFrame:
    keys = list(check.arg) or [check.column]
    counts = table.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter("_n > 1").agg(_row(check, F.count(F.lit(1))).alias("_row")).select("_row.*")


def _overlaps(table: DataFrame, check: Check) -> DataFrame:
    """Versions that begin before the one before them has ended."""
    start, end = check.arg
    before = W.partitionBy(check.column).orderBy(start)
    far = F.lit("9999-12-31").cast("timestamp")
    ends = F.lag(F.coalesce(F.col(end), far)).over(before)
    marked = table.select(check.column, start, end).withColumn("_ends", ends)
    return (
        marked.filter(F.col("_ends") > F.col(start))
        .agg(_row(check, F.count(F.lit(1))).alias("_row"))
        .select("_row.*")
    )


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check, model, column, failures) for every check.

    A check whose table, or whose parent table, is not given counts as one
    failure, named in ``column``.
    """
    parts, absent = [], []
    for check in checks:
        needs = [check.model, *([check.arg[0]] if check.kind == "relationships" else [])]
        if missing := [t for t in needs if t not in tables]:
            absent.append((check.kind, check.model, f"{check.column}: no table {', '.join(missing)}", 1))
    for model, table in tables.items():
        mine = [c for c in checks if c.model == model]
        fused = [c for c in mine if c.kind in ("not_null", "accepted_values")]
        fused += [c for c in mine if c.kind == "relationships" and c.arg[0] in tables]
        if fused:
            parts.append(_in_one_pass(table, fused, tables))
        for check in mine:
            if check.kind in ("unique", "unique_key"):
                parts.append(_repeated(table, check))
            elif check.kind == "no_overlap":
                parts.append(_overlaps(table, check))
    if absent:
        spark = next(iter(tables.values())).sparkSession
        parts.append(literal(spark, absent, "check string, model string, column string, failures bigint"))
    return reduce(DataFrame.unionByName, parts)


def require_clean(report: DataFrame) -> None:
    """Stop the run if any check found failures; one row per check at most."""
    failed = report.filter("failures > 0").collect()
    if failed:
        raise ValueError(
            "checks failed: " + "; ".join(f"{r.check} {r.model}.{r.column}: {r.failures}" for r in failed)
        )
