"""Forecasting: features, naive, exponential smoothing, boosted trees, ensemble.

A panel has one row per (symbol, trade_date) with the three target series.
Forecast rows have the columns ``symbol, cutoff, target_date, target_name,
model_name, horizon_days, predicted_value, model_params``.
"""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import values as V
from ..functions.scalars import fixed, ratio
from ..session import stage
from .boosting import UNIT, bins, boost, whole
from .windows import rolling

# target -> (series, label column, label is a relative change)
TARGETS = {
    "price": ("close_price", "target_price_ret", True),
    "volatility": ("volatility_pct", "target_volatility", False),
    "volume": ("quote_volume", "target_volume_ret", True),
}

FEATURES = [
    "ret", "ret_lag1", "ret_lag2", "ret_lag6", "price_vs_ma7", "price_vs_ma30",
    "volatility_pct", "vol_ma_7", "volume_ratio", "dow",
]

FORECAST_COLUMNS = [
    "symbol", "cutoff", "target_date", "target_name", "model_name",
    "horizon_days", "predicted_value", "model_params",
]

_SERIES = [series for series, _, _ in TARGETS.values()]


def completed_panel(metrics: DataFrame, as_of: Column) -> DataFrame:
    """Series of days that are over at ``as_of``."""
    return metrics.filter(F.col("trade_date") < as_of).select("symbol", "trade_date", *_SERIES)


def panel_profile(panel: DataFrame) -> DataFrame:
    return panel.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("symbol").alias("symbols"),
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
    )


def make_features(panel: DataFrame) -> DataFrame:
    """Ten features that look back only, and three labels one row ahead."""
    series = W.partitionBy("symbol").orderBy(F.col("trade_date").asc_nulls_first())

    def change(col: str) -> Column:
        prev = F.lag(col).over(series)
        return ratio(F.col(col), prev) - 1

    base = panel.select(
        "symbol",
        "trade_date",
        *_SERIES,
        change("close_price").alias("ret"),
        change("quote_volume").alias("_volume_ret"),
    )
    means = rolling(
        base,
        by="symbol",
        order="trade_date",
        full_window=True,
        frames={
            "ma_7": ("avg", "close_price", 7),
            "ma_30": ("avg", "close_price", 30),
            "vol_ma_7": ("avg", "volatility_pct", 7),
            "_volume_ma_30": ("avg", "quote_volume", 30),
        },
    )
    return means.select(
        "symbol",
        "trade_date",
        *_SERIES,
        "ret",
        *[F.lag("ret", k).over(series).alias(f"ret_lag{k}") for k in (1, 2, 6)],
        (ratio(F.col("close_price"), F.col("ma_7")) - 1).alias("price_vs_ma7"),
        (ratio(F.col("close_price"), F.col("ma_30")) - 1).alias("price_vs_ma30"),
        "vol_ma_7",
        ratio(F.col("quote_volume"), F.col("_volume_ma_30")).alias("volume_ratio"),
        F.weekday("trade_date").alias("dow"),
        F.lead("ret").over(series).alias("target_price_ret"),
        F.lead("volatility_pct").over(series).alias("target_volatility"),
        F.lead("_volume_ret").over(series).alias("target_volume_ret"),
    )


# ------------------------------------------------------------ one cutoff


def _long(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per target series instead of one column each."""
    entries = [
        F.struct(F.lit(name).alias("target_name"), F.col(series).alias("value"))
        for name, (series, _, _) in TARGETS.items()
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def _history(panel: DataFrame, cutoff: Column | None, min_rows: int) -> DataFrame:
    """One row per symbol: its whole series up to ``cutoff``, in date order.

    A series has one entry per calendar day at most.
    """
    kept = panel if cutoff is None else panel.filter(F.col("trade_date") <= cutoff)
    entries = F.array_sort(F.collect_list(F.struct("trade_date", *_SERIES)))
    return kept.groupBy("symbol").agg(entries.alias("_entries")).filter(F.size("_entries") >= min_rows)


def forecast_naive(panel: DataFrame, *, cutoff: Column | None = None, min_rows: int = V.MIN_HISTORY_ROWS) -> DataFrame:
    """Tomorrow equals the last known value: (symbol, target_name, value)."""
    kept = panel if cutoff is None else panel.filter(F.col("trade_date") <= cutoff)
    last = kept.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(series, "trade_date").alias(series) for series in _SERIES],
    )
    return _long(last.filter(F.col("_n") >= min_rows), ["symbol"]).select(
        "symbol", "target_name", F.col("value").alias("predicted_value")
    )


def fit_ets(panel: DataFrame, *, cutoff: Column | None = None, min_rows: int = V.MIN_HISTORY_ROWS) -> DataFrame:
    """Simple exponential smoothing: (symbol, target_name, alpha, level, sse, last).

    Twenty alphas are tried on one-step-ahead squared error, the smallest
    winning ties; ``last`` is the newest value itself. Series and alphas fold
    inside one row per symbol and target, so nothing is shuffled after the
    series are gathered.
    """

    def fold(alpha: Column, values: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            miss = x - acc["level"]
            return F.struct(
                (acc["sse"] + miss * miss).alias("sse"),
                (alpha * x + (F.lit(1.0) - alpha) * acc["level"]).alias("level"),
            )

        def finish(acc: Column) -> Column:
            return F.struct(acc["sse"].alias("sse"), alpha.alias("alpha"), acc["level"].alias("level"))

        start = F.struct(F.lit(0.0).alias("sse"), F.get(values, F.lit(0)).alias("level"))
        rest = F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))
        return F.aggregate(rest, start, step, finish)

    history = _history(panel, cutoff, min_rows)
    entries = [
        F.struct(F.lit(name).alias("target_name"), F.col(f"_entries.{series}").alias("_values"))
        for name, (series, _, _) in TARGETS.items()
    ]
    per_target = history.select("symbol", F.inline(F.array(*entries)))
    grid = F.transform(
        F.sequence(F.lit(1), F.lit(V.ALPHA_STEPS)),
        lambda i: fold(i / F.lit(float(V.ALPHA_STEPS)), F.col("_values")),
    )
    best = per_target.select(
        "symbol", "target_name", F.array_min(grid).alias("_best"), F.element_at("_values", -1).alias("last")
    )
    return best.select("symbol", "target_name", "_best.alpha", "_best.level", "_best.sse", "last")


def forecast_ets(panel: DataFrame, *, cutoff: Column | None = None, min_rows: int = V.MIN_HISTORY_ROWS) -> DataFrame:
    """(symbol, target_name, value, params) of the best smoothing level."""
    return fit_ets(panel, cutoff=cutoff, min_rows=min_rows).select(
        "symbol", "target_name", F.col("level").alias("predicted_value"), _alpha_text(F.col("alpha")).alias("model_params")
    )


def _alpha_text(alpha: Column) -> Column:
    return F.concat(F.lit("alpha="), fixed(alpha, 2))


def _signed(x: Column) -> Column:
    return F.concat(F.when(x < 0, "-").otherwise("+"), fixed(F.abs(x), 4))


#: Rounds of boosting, and decimals of the features.
TREE_ROUNDS = 200
FEATURE_DIGITS = 6


def forecast_trees(
    features: DataFrame, *, cutoff: Column, rounds: int = TREE_ROUNDS, min_rows: int = V.TREE_MIN_ROWS
) -> DataFrame:
    """Boosted-tree forecasts of all targets at one cutoff, from rows strictly before it.

    A target with fewer than ``min_rows`` complete rows has none.
    """
    due = features.filter(F.col("trade_date") <= cutoff).withColumns(
        {"first": F.when(F.col("trade_date") == cutoff, 0), "of": F.lit(0), "until": F.lit(0)}
    )
    return _fit_trees(due, before=F.col("trade_date") < cutoff, rounds=rounds, min_rows=min_rows)[0]


def _fit_trees(due: DataFrame, *, before: Column, rounds: int, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """Forecasts (symbol, trade_date, target_name, predicted_value, model_params), and the trees.

    A row trains the windows ``of`` to ``until``, but window ``first``, which it
    is a forecast of; a row without ``first`` is before all of them. Models are
    windows times targets, and all are grown together. Relative targets are
    rebuilt as ``today * (1 + predicted change)``, since trees cannot predict
    beyond the values they were trained on.
    """
    rows = due.dropna(subset=FEATURES).withColumns({f: F.round(f, FEATURE_DIGITS) for f in FEATURES if f != "dow"})
    rows = bins(stage(rows, "tree_rows"), features=FEATURES, before=before)
    names = list(TARGETS)
    labels = [F.nanvl(label, F.lit(None).cast("double")) for _, label, _ in TARGETS.values()]
    entries = [
        F.struct(F.lit(i).alias("target"), whole(F.round(label, FEATURE_DIGITS)).alias("label"), F.col(series).alias("today"))
        for i, (label, (series, _, _)) in enumerate(zip(labels, TARGETS.values()))
    ]
    every = rows.select("symbol", "trade_date", "first", "_bins", F.explode(F.sequence("of", "until")).alias("window"), F.array(*entries).alias("entries"))
    every = every.select("symbol", "trade_date", "window", "_bins", F.col("first").eqNullSafe(F.col("window")).alias("is_due"), F.inline("entries"))
    every = every.withColumn("model", F.col("window") * len(names) + F.col("target"))
    every = every.withColumn("is_training", ~F.col("is_due") & F.col("label").isNotNull()).filter("is_training OR is_due")
    counts = every.groupBy("model").agg(F.count_if("is_training").alias("n")).filter(F.col("n") >= min_rows)
    every = every.join(counts.select("model"), "model", "left_semi").select("symbol", "trade_date", "target", "today", "model", "_bins", "label", "is_training", "is_due")
    made, trees = boost(every, rounds=rounds)
    raw = F.col("prediction") / float(UNIT)
    relative = F.array(*[F.lit(r) for _, _, r in TARGETS.values()])[F.col("target")]
    return made.filter("is_due").select(
        "symbol",
        "trade_date",
        F.array(*[F.lit(n) for n in names])[F.col("target")].alias("target_name"),
        F.when(relative, F.col("today") * (1 + raw)).otherwise(raw).alias("predicted_value"),
        F.when(relative, F.concat(F.lit("ret="), _signed(raw))).otherwise(F.concat(F.lit("pred="), fixed(raw, 4))).alias("model_params"),
    ), trees


def training_rows(features: DataFrame, *, cutoff: Column, min_rows: int = V.TREE_MIN_ROWS) -> DataFrame:
    """(target_name, training_rows, is_trained): complete rows before the cutoff, and whether they suffice."""
    before = features.filter(F.col("trade_date") < cutoff).dropna(subset=FEATURES)
    known = [F.count(F.nanvl(label, F.lit(None).cast("double"))).alias(target) for target, (_, label, _) in TARGETS.items()]
    counts = F.array(*[F.struct(F.lit(t).alias("target_name"), F.col(t).alias("training_rows")) for t in TARGETS])
    return before.agg(*known).select(F.inline(counts)).withColumn("is_trained", F.col("training_rows") >= min_rows)


def ensemble(forecasts: DataFrame, *, by: list[str], min_models: int = 2) -> DataFrame:
    """Mean of the models of each group, where at least ``min_models`` exist.

    Groups hold one row per model, so the name set has four entries at most.
    """
    grouped = forecasts.groupBy(*by).agg(
        F.avg("predicted_value").alias("predicted_value"),
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.array_sort(F.collect_set("model_name")), "+").alias("model_params"),
    )
    return grouped.filter(F.col("_n") >= min_models).drop("_n").withColumn("model_name", F.lit("ensemble"))


def _model(name: str, value: Column, params: Column | None = None) -> Column:
    params = F.lit(None).cast("string") if params is None else params
    return F.struct(
        F.lit(name).alias("model_name"), value.alias("predicted_value"), params.alias("model_params")
    )


def _model_rows(forecasts: DataFrame) -> DataFrame:
    """Forecast rows of ``models`` arrays, with the ensemble as one more model.

    An array holds the few models of one symbol, day and target, so the mean
    is taken inside the row, without grouping the forecasts again.
    """
    models = F.array_sort("models")
    total = F.aggregate(models, F.lit(0.0), lambda acc, m: acc + m["predicted_value"])
    names = F.array_join(F.transform(models, lambda m: m["model_name"]), "+")
    mean = _model("ensemble", total / F.size(models), names)
    with_mean = F.when(F.size(models) >= 2, F.concat(models, F.array(mean))).otherwise(models)
    return forecasts.select(
        "symbol",
        "cutoff",
        "target_date",
        "target_name",
        F.lit(V.HORIZON_DAYS).alias("horizon_days"),
        F.inline(with_mean),
    ).select(*FORECAST_COLUMNS)


def _join_trees(models: DataFrame, trees: DataFrame | None, keys: list[str]) -> DataFrame:
    """Add boosted-tree forecasts to ``models``; either side may lack a row."""
    if trees is None:
        return models
    fitted = trees.select(
        *keys, _model("gbt", F.col("predicted_value"), F.col("model_params")).alias("_tree")
    )
    joined = models.join(fitted, keys, "full")
    known = F.coalesce("models", F.array().cast(models.schema["models"].dataType))
    both = F.when(F.col("_tree").isNull(), known).otherwise(F.concat(known, F.array("_tree")))
    return joined.withColumn("models", both).drop("_tree")


def forecast_round(
    panel: DataFrame,
    *,
    cutoff: Column,
    target_date: Column,
    features: DataFrame | None = None,
    rounds: int = TREE_ROUNDS,
) -> DataFrame:
    """All models for one cutoff, using only rows up to it.

    Without ``features`` the boosted trees are left out.
    """
    fitted = fit_ets(panel, cutoff=cutoff)
    models = fitted.select(
        "symbol",
        "target_name",
        F.array(
            _model("naive", F.col("last")), _model("ets", F.col("level"), _alpha_text(F.col("alpha")))
        ).alias("models"),
    )
    trees = None if features is None else forecast_trees(features, cutoff=cutoff, rounds=rounds)
    models = _join_trees(models, trees, ["symbol", "target_name"])
    return _model_rows(models.withColumns({"cutoff": cutoff, "target_date": target_date}))


def daily_cutoff(panel: DataFrame) -> tuple[Column, Column]:
    """(cutoff, target date) of a daily run: the last day and the day after.

    One date comes to the driver, so that it can prune scans as a literal.
    """
    last = panel.agg(F.max("trade_date").alias("last")).first()["last"]
    return F.lit(last), F.lit(last + timedelta(days=1))


# ----------------------------------------------------------- all cutoffs


def backtest_steps(panel: DataFrame, min_train: int = V.BACKTEST_MIN_TRAIN) -> DataFrame:
    """Dates numbered in order, with the next one as target.

    (step, cutoff, target_date, is_step); dates before ``min_train`` only
    train. The window runs over distinct days, a few hundred rows a year, and
    the result is stored: joins see how small it is.
    """
    days = panel.select(F.col("trade_date").alias("cutoff")).distinct()
    w = W.orderBy("cutoff")
    steps = days.select(
        (F.row_number().over(w) - 1).alias("step"),
        "cutoff",
        F.lead("cutoff").over(w).alias("target_date"),
    ).withColumn("is_step", (F.col("step") >= min_train) & F.col("target_date").isNotNull())
    return stage(steps, "steps")


def _over_steps(rows: DataFrame, steps: DataFrame, min_rows: int) -> DataFrame:
    """Each row at every cutoff where it is the newest its symbol has.

    ``rows`` know how many of their symbol they have ``seen`` and its
    ``next_date``. A row stands from its own date until the next one, and the
    last one until the end, so the rows fill exactly the cutoffs that
    forecast from them; symbols and dates are never crossed.
    """
    bounds = steps.filter("is_step").agg(F.min("step").alias("first"), F.max("step").alias("last")).first()
    first, last = F.lit(bounds["first"]).cast("int"), F.lit(bounds["last"]).cast("int")
    own = steps.select(F.col("step").alias("_own"), F.col("cutoff").alias("trade_date"))
    after = steps.select(F.col("step").alias("_next"), F.col("cutoff").alias("next_date"))
    spans = (
        rows.filter((F.col("seen") >= min_rows) & first.isNotNull())
        .join(own, "trade_date")
        .join(after, "next_date", "left")
    )
    begin = F.greatest(F.col("_own"), first)
    end = F.least(F.coalesce(F.col("_next") - 1, last), last)
    filled = spans.filter(begin <= end).withColumn("_at", F.explode(F.sequence(begin, end)))
    at = steps.select(F.col("step").alias("_at"), "cutoff", "target_date")
    return filled.drop("_own", "_next", "seen", "next_date", "trade_date").join(at, "_at").drop("_at")


def _finish(long: DataFrame, model: str) -> DataFrame:
    return long.withColumns(
        {"model_name": F.lit(model), "horizon_days": F.lit(V.HORIZON_DAYS)}
    ).select(*FORECAST_COLUMNS)


def backtest_naive(
    panel: DataFrame, *, min_train: int = V.BACKTEST_MIN_TRAIN, min_rows: int = V.MIN_HISTORY_ROWS
) -> DataFrame:
    """Naive forecasts of every backtest cutoff, in one pass."""
    series = W.partitionBy("symbol").orderBy("trade_date")
    placed = panel.withColumns(
        {"seen": F.row_number().over(series), "next_date": F.lead("trade_date").over(series)}
    )
    standing = _over_steps(placed, backtest_steps(panel, min_train), min_rows)
    long = _long(standing, ["symbol", "cutoff", "target_date"])
    return _finish(
        long.withColumnRenamed("value", "predicted_value").withColumn("model_params", F.lit(None).cast("string")),
        "naive",
    )


#: Symbols whose series are smoothed side by side.
SYMBOLS_AT_ONCE = 256


def _running_ets(values: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best alpha and its level after each value of many series, all alphas side by side.

    ``values`` has the series' first days, then their second ones, and so on; of day i
    the first ``active[i]`` series have one, the longest series coming first. A column
    is a target.
    """
    alphas = np.arange(1, V.ALPHA_STEPS + 1) / float(V.ALPHA_STEPS)
    keep = 1.0 - alphas
    best, out = np.empty(values.shape), np.empty(values.shape)
    level = sse = np.zeros((0, values.shape[1], V.ALPHA_STEPS))
    begin = 0
    for day, n in enumerate(active.tolist()):
        x = values[begin : begin + n, :, None]
        if day:
            level, sse = level[:n], sse[:n]
            miss = x - level
            sse = sse + miss * miss
            level = alphas * x + keep * level
        else:
            level, sse = np.repeat(x, V.ALPHA_STEPS, axis=2), np.zeros((n, values.shape[1], V.ALPHA_STEPS))
        k = np.argmin(sse, axis=2)
        best[begin : begin + n] = alphas[k]
        out[begin : begin + n] = np.take_along_axis(level, k[:, :, None], axis=2)[:, :, 0]
        begin += n
    return best, out


def running_ets(panel: DataFrame) -> DataFrame:
    """(symbol, trade_date, and last value, alpha and level of each series there).

    ``seen`` counts the symbol's rows so far and ``next_date`` is its next day.

    The recursion has no built-in form with all of its intermediate states, so
    series fold in numpy, once rather than once per cutoff. Groups of symbols
    (about SYMBOLS_AT_ONCE, as many groups as the symbols need) go through their days
    together, one step for all symbols, targets and alphas; nothing is
    padded, so a group takes the room of its rows.
    """
    schema = "symbol string, trade_date date, seen int, next_date date, " + ", ".join(
        f"{name}_last double, {name}_alpha double, {name}_level double" for name in TARGETS
    )

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["symbol", "trade_date"], ignore_index=True)
        days = pdf.groupby("symbol").cumcount().to_numpy()
        length = pdf.groupby("symbol")["symbol"].transform("size").to_numpy()
        order = np.lexsort((pdf["symbol"].to_numpy(dtype=str), -length, days))
        best, level = _running_ets(pdf[_SERIES].to_numpy(dtype=float)[order], np.bincount(days))
        back = np.argsort(order)
        out = {
            "symbol": pdf["symbol"],
            "trade_date": pdf["trade_date"],
            "seen": days + 1,
            "next_date": pdf.groupby("symbol")["trade_date"].shift(-1),
        }
        for i, name in enumerate(TARGETS):
            out[f"{name}_last"] = pdf[_SERIES[i]]
            out[f"{name}_alpha"], out[f"{name}_level"] = best[back, i], level[back, i]
        return pd.DataFrame(out)

    groups = -(-panel.select("symbol").distinct().count() // SYMBOLS_AT_ONCE) or 1
    rows = panel.select("symbol", "trade_date", *_SERIES, F.pmod(F.xxhash64("symbol"), F.lit(groups)).alias("_group"))
    return rows.groupBy("_group").applyInPandas(lambda pdf: fold(pdf), schema)


def backtest_ets(
    panel: DataFrame, *, min_train: int = V.BACKTEST_MIN_TRAIN, min_rows: int = V.MIN_HISTORY_ROWS
) -> DataFrame:
    """Smoothing forecasts of every backtest cutoff, in one pass."""
    standing = _over_steps(running_ets(panel), backtest_steps(panel, min_train), min_rows)
    entries = [
        F.struct(
            F.lit(name).alias("target_name"),
            F.col(f"{name}_level").alias("predicted_value"),
            _alpha_text(F.col(f"{name}_alpha")).alias("model_params"),
        )
        for name in TARGETS
    ]
    long = standing.select("symbol", "cutoff", "target_date", F.inline(F.array(*entries)))
    return _finish(long, "ets")


def backtest(
    panel: DataFrame, *, min_train: int = V.BACKTEST_MIN_TRAIN, trees: DataFrame | None = None
) -> DataFrame:
    """Walk-forward forecasts of all models and their ensemble.

    Naive and smoothing forecasts stand on the same rows, so both come out
    of one pass over the panel.
    """
    standing = _over_steps(running_ets(panel), backtest_steps(panel, min_train), V.MIN_HISTORY_ROWS)
    entries = [
        F.struct(
            F.lit(name).alias("target_name"),
            F.array(
                _model("naive", F.col(f"{name}_last")),
                _model("ets", F.col(f"{name}_level"), _alpha_text(F.col(f"{name}_alpha"))),
            ).alias("models"),
        )
        for name in TARGETS
    ]
    models = standing.select("symbol", "cutoff", "target_date", F.inline(F.array(*entries)))
    return _model_rows(_join_trees(models, trees, ["symbol", "cutoff", "target_date", "target_name"]))


def backtest_gbt(
    panel: DataFrame,
    *,
    refit_every: int,
    min_train: int = V.BACKTEST_MIN_TRAIN,
    rounds: int = TREE_ROUNDS,
    min_rows: int = V.TREE_MIN_ROWS,
) -> DataFrame:
    """Boosted-tree forecasts of every backtest cutoff.

    ``refit_every`` steps share a model, trained before the first of them, so no
    forecast ever sees its own future. The models of all windows and targets
    grow together (``boosting``): a row stands once for each window that
    follows it, and the number of jobs is that of one model.
    """
    steps = backtest_steps(panel, min_train)
    ends = steps.filter("is_step").agg(F.min("step").alias("first"), F.max("step").alias("last")).first()
    if ends["first"] is None:
        raise ValueError(f"history is too short: more than {min_train + 1} days are needed")
    windows = (ends["last"] - ends["first"]) // refit_every + 1
    own = F.floor((F.col("step") - ends["first"]) / refit_every).cast("int")
    placed = steps.filter(F.col("step") <= ends["last"]).select(
        F.col("cutoff").alias("trade_date"),
        "target_date",
        F.when(F.col("is_step"), own).alias("first"),
        F.greatest(own, F.lit(0)).alias("of"),
        F.lit(windows - 1).alias("until"),
    )
    due = make_features(panel).join(placed, "trade_date")
    made, _ = _fit_trees(due, before=F.col("first").isNull(), rounds=rounds, min_rows=min_rows)
    dated = made.join(placed.select("trade_date", "target_date"), "trade_date").withColumnRenamed("trade_date", "cutoff")
    return _finish(dated, "gbt")
