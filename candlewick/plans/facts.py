"""Fact tables of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import values as V
from ..functions import labels
from ..functions.scalars import fixed, null_double, pct, ratio
from ..operators.joins import map_symbols, pairs, pit_join
from ..operators.windows import is_extreme, rolling_corr
from ..session import stage


def _with_date_key(fact: DataFrame, dim_date: DataFrame, date: str = "date", how: str = "inner") -> DataFrame:
    days = dim_date.select("date_key", F.col("full_date").alias("_full_date"))
    return fact.join(days, fact[date] == days["_full_date"], how).drop("_full_date")


def _keyed(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, key: str, dim_key: str = "asset_id"):
    return _with_date_key(
        pit_join(fact, dim_asset, key=key, date="date", dim_key=dim_key), dim_date
    )


def price_rows(unified: DataFrame, stocks: DataFrame, tickers: DataFrame) -> DataFrame:
    """Prices of every source under asset ids, before keys are attached."""
    crypto = map_symbols(unified, tickers, col="symbol", only_source=V.CANDLE_SOURCE).select(
        "asset_id", "date", "price", "total_volume", "open_price", "high_price", "low_price",
        labels.source_name(F.col("source")).alias("source_name"),
    )
    listed = stocks.select(
        F.col("symbol").alias("asset_id"),
        "date",
        F.col("close").alias("price"),
        F.col("volume").cast("double").alias("total_volume"),
        null_double().alias("open_price"),
        null_double().alias("high_price"),
        null_double().alias("low_price"),
        F.lit(V.SOURCE_NAMES[V.STOCK_SOURCE]).alias("source_name"),
    )
    return crypto.unionByName(listed)


def fact_market_prices(
    rows: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, dim_source: DataFrame
) -> DataFrame:
    keyed = _keyed(rows, dim_asset, dim_date, "asset_id").join(dim_source, "source_name")
    return keyed.select(
        "asset_key", "date_key", "source_key",
        "price", "total_volume", "open_price", "high_price", "low_price",
    )


def fact_price_trends(averages: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    keyed = _keyed(averages, dim_asset, dim_date, "coin_id", dim_key="symbol")
    return keyed.select("asset_key", "date_key", "moving_avg_7d", "moving_avg_14d", "moving_avg_30d")


def fact_volume_analysis(volumes: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    volume = F.col("total_volume")
    measured = volumes.select(
        "symbol",
        "date",
        *[
            pct(volume - F.col(f"avg_volume_{n}d"), F.col(f"avg_volume_{n}d"), 2).alias(f"volume_change_pct_{n}d")
            for n in (7, 30)
        ],
        labels.is_volume_spike(volume, F.col("avg_volume_30d")).alias("is_volume_spike"),
    )
    return _keyed(measured, dim_asset, dim_date, "symbol").select(
        "asset_key", "date_key", "volume_change_pct_7d", "volume_change_pct_30d", "is_volume_spike"
    )


def volatility_measures(volatility: DataFrame) -> DataFrame:
    """Coefficient of variation and z-score over 30 rows, with their labels."""
    cv = ratio(F.col("stddev_price_30d"), F.col("avg_price_30d"))
    z = ratio(F.col("price") - F.col("avg_price_30d"), F.col("stddev_price_30d"))
    measured = volatility.select("symbol", "date", cv.alias("coefficient_of_variation"), z.alias("z_score"))
    return measured.withColumns(
        {
            "is_anomaly": labels.is_anomaly(F.col("z_score")),
            "risk_level": labels.risk_level(F.col("coefficient_of_variation")),
        }
    )


def fact_market_volatility(volatility: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _keyed(volatility_measures(volatility), dim_asset, dim_date, "symbol").select(
        "asset_key", "date_key", "coefficient_of_variation", "z_score", "is_anomaly", "risk_level"
    )


def return_pairs(returns: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Returns of every pair of assets on the days both have one."""
    known = returns.filter(F.col("daily_return_pct").isNotNull())
    return pairs(known, on="date", item="symbol", values=["asset_type", "daily_return_pct", *(extra or [])])


#: Rows of the longest frame of a correlation.
LONGEST_FRAME = 90


def pair_correlation(returns: DataFrame, *, extra: list[str] | None = None, since: date | None = None) -> DataFrame:
    """Rolling 30- and 90-row correlation per pair, one Window for all four.

    With ``since`` only rows from that day on are returned, and only as much
    history is paired as their frames reach back (``frame_history``). Symbols
    with a return too large for whole numbers are looked for in the returns,
    before they are paired; their pairs alone take the slower way.
    """
    values = ["asset_type", "daily_return_pct", *(extra or [])]
    known = stage(returns.filter(F.col("daily_return_pct").isNotNull()).select("date", "symbol", *values), "returns")
    huge = known.filter(is_extreme(F.col("daily_return_pct"))).select("symbol").distinct()
    far, start = (None, None) if since is None else frame_history(known, since, LONGEST_FRAME)

    def correlated(rows: DataFrame, only: DataFrame | None = None) -> DataFrame:
        """Correlations of pairs with one of the symbols ``only`` names, or of all."""
        flags = {"_huge": huge, "_only": only}
        for flag, names in flags.items():
            if names is not None:
                rows = rows.join(names.withColumn(flag, F.lit(True)), "symbol", "left")
        flagged = [f for f, names in flags.items() if names is not None]
        paired = pairs(rows, on="date", item="symbol", values=[*values, *flagged])
        if only is not None:
            paired = paired.filter(F.coalesce("_only_a", "_only_b").isNotNull())
        some = F.coalesce("_huge_a", "_huge_b").isNotNull()
        out = _pair_windows(paired.filter(~some) if has_huge else paired, extreme=False)
        if has_huge:
            out = out.unionByName(_pair_windows(paired.filter(some), extreme=True))
        return out.drop(*[f"{f}_{side}" for f in flagged for side in "ab"])

    has_huge = not huge.isEmpty()
    if since is None:
        return correlated(known)
    recent = known.filter(F.col("date") >= start)
    if far is None:
        return correlated(recent).filter(F.col("date") >= since)
    near = correlated(recent.join(far, "symbol", "left_anti"))
    return near.unionByName(correlated(known, only=far)).filter(F.col("date") >= since)


#: Days of history tried for the frames of a new day.
HISTORIES = (120, 180, 270, 400, 600, 900)


def frame_history(known: DataFrame, since: date, rows: int) -> tuple[DataFrame | None, date]:
    """Symbols that need all their history, or None, and the day from which history does for all others.

    Of m days on which anything traded, two symbols with a and b rows have at
    least ``a + b - m`` rows in common. Symbols with ``(m + rows - 1) / 2`` rows
    in them therefore find ``rows - 1`` common ones before ``since``, and a symbol
    without older rows finds all it has. What is left must look further back; m is
    taken where that costs least. Per symbol one count for each m is formed;
    the days (one row each) and the sums over all symbols go to the driver.
    """
    before = known.filter(F.col("date") < since)
    most = max(HISTORIES)
    days = [r.date for r in before.select("date").distinct().orderBy(F.col("date").desc()).limit(most).collect()]
    if not days:
        return None, since
    tried = {m: days[m - 1] for m in HISTORIES if m < len(days)} | ({len(days): days[-1]} if len(days) < most else {})
    per_symbol = before.groupBy("symbol").agg(
        F.min("date").alias("first"), *[F.count_if(F.col("date") >= day).alias(f"m{m}") for m, day in tried.items()]
    )
    short = {m: (2 * F.col(f"m{m}") < m + rows - 1) & (F.col("first") < day) for m, day in tried.items()}
    sums = per_symbol.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(s).alias(f"s{m}") for m, s in short.items()]).first()
    total = before.select("date").distinct().count()
    best = min(tried, key=lambda m: sums["n"] * m / 2 + sums[f"s{m}"] * total)
    far = per_symbol.filter(short[best]).select("symbol") if sums[f"s{best}"] else None
    return far, tried[best]


def _pair_windows(paired: DataFrame, *, extreme: bool) -> DataFrame:
    rolled = rolling_corr(
        paired,
        by=["cell", "symbol_a", "symbol_b"],
        order="date",
        x="daily_return_pct_a",
        y="daily_return_pct_b",
        rows={"_c30": 30, "_c90": LONGEST_FRAME},
        counts={"observations_30d": 30, "observations_90d": LONGEST_FRAME},
        extreme=extreme,
    )
    return rolled.withColumns(
        {
            "pair_type": labels.pair_type(F.col("asset_type_a"), F.col("asset_type_b")),
            "correlation_strength_30d": labels.correlation_strength(F.col("_c30")),
            "correlation_30d": F.round("_c30", 4),
            "correlation_90d": F.round("_c90", 4),
        }
    ).drop("_c30", "_c90")


def fact_asset_correlation(
    returns: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, *, since: date | None = None
) -> DataFrame:
    """Keys are looked up once per asset and day, before rows are paired.

    Versions never overlap, so a return has at most one key and the lookup
    cannot change which pairs or windows exist; pairs with an unknown asset
    are dropped at the end, after their rows took part in the windows. With
    ``since``, the rows of that day and later ones.
    """
    keyed = pit_join(returns, dim_asset, key="symbol", date="date", how="left")
    keyed = _with_date_key(keyed, dim_date, how="left")
    rolled = pair_correlation(keyed, extra=["asset_key", "date_key"], since=since)
    known = (
        F.col("asset_key_a").isNotNull() & F.col("asset_key_b").isNotNull() & F.col("date_key_a").isNotNull()
    )
    return rolled.filter(known).select(
        "asset_key_a", "asset_key_b", F.col("date_key_a").alias("date_key"),
        "symbol_a", "symbol_b", "pair_type", "correlation_30d", "correlation_90d",
        "correlation_strength_30d", "observations_30d", "observations_90d",
    )


def fact_market_alerts(
    market: DataFrame,
    volume_facts: DataFrame,
    volatility_facts: DataFrame,
    dim_asset: DataFrame,
    dim_date: DataFrame,
    drop_threshold: float = V.DROP_THRESHOLD,
) -> DataFrame:
    """Price drops, volume spikes and high volatility, with their messages."""
    series = W.partitionBy("symbol").orderBy(F.col("date").asc_nulls_first())
    change = ratio(F.col("price") - F.col("prev_price"), F.col("prev_price"))
    drops = (
        market.select("symbol", "date", "price", F.lag("price").over(series).alias("prev_price"))
        .filter(change <= drop_threshold)
        .select(
            "symbol",
            "date",
            F.lit("price_drop").alias("alert_type"),
            F.concat(
                F.lit("Price dropped "), fixed(change * 100, 2),
                F.lit("% (from $"), fixed(F.col("prev_price"), 2),
                F.lit(" to $"), fixed(F.col("price"), 2), F.lit(")"),
            ).alias("alert_message"),
        )
    )

    def located(facts: DataFrame) -> DataFrame:
        """Fact rows back under asset id and date, where the market has them."""
        named = facts.join(dim_asset.select("asset_key", F.col("asset_id").alias("symbol")), "asset_key")
        dated = named.join(dim_date.select("date_key", F.col("full_date").alias("date")), "date_key")
        return dated.join(market.select("symbol", "date"), ["symbol", "date"])

    spikes = located(volume_facts.filter("is_volume_spike")).select(
        "symbol",
        "date",
        F.lit("volume_spike").alias("alert_type"),
        F.concat(
            F.lit("Volume spiked "), fixed(F.col("volume_change_pct_30d"), 2),
            F.lit("% above the 30-day average"),
        ).alias("alert_message"),
    )
    swings = located(volatility_facts.filter("risk_level = 'high'")).select(
        "symbol",
        "date",
        F.lit("high_volatility").alias("alert_type"),
        F.concat(
            F.lit("High volatility: 30-day price swing at "),
            fixed(F.col("coefficient_of_variation") * 100, 1),
            F.lit("% of the average price (z-score "), fixed(F.col("z_score"), 2), F.lit(")"),
        ).alias("alert_message"),
    )
    return drops.unionByName(spikes).unionByName(swings)
