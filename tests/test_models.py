from datetime import datetime

from helpers import d, days, rows
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.functions import labels
from candlewick.functions.scalars import capitalise, money, signed_pct
from candlewick.plans import dims, facts, feeds

CANDLE = (
    "symbol string, date date, open_price double, high_price double, low_price double, close_price double, "
    "volume double, quote_volume double, updated_at timestamp"
)
MARKET = "symbol string, date date, price double, total_volume double, source string, asset_type string"


def market(table, prices, symbol="a", volumes=None, kind="Crypto"):
    volumes = volumes or [1.0] * len(prices)
    return table(
        MARKET, *[(symbol, x, p, v, "unified", kind) for x, p, v in zip(days("2024-01-01", len(prices)), prices, volumes)]
    )


def test_zero_open_has_no_change_and_counts_as_high(table):
    out = feeds.candle_metrics(table(CANDLE, ("A", d("2024-01-01"), 0.0, 2.0, 1.0, 1.5, 1.0, 1.0, None))).first()
    assert (out.price_change, out.price_change_percent, out.volatility_label) == (1.5, None, "HIGH")


def test_candles_count_quote_volume_and_lack_market_cap(table):
    metrics = feeds.candle_metrics(table(CANDLE, ("A", d("2024-01-01"), 1.0, 2.0, 1.0, 1.5, 7.0, 70.0, None)))
    spot = table("coin_id string, date date, price double, market_cap double, total_volume double",
                 ("a", d("2024-01-01"), 2.5, 9.0, 30.0))
    unified = feeds.unified_feed(spot, metrics)
    assert rows(unified, "symbol", "total_volume", "market_cap", "source") == [
        ("A", 70.0, None, "binance"), ("a", 30.0, 9.0, "coingecko")
    ]
    tickers = table("ticker string, asset_id string", ("A", "a"))
    assert rows(feeds.unify_sources(unified, tickers)) == [("a", d("2024-01-01"), 2.0, 9.0, 100.0)]


def test_first_return_and_return_after_zero_are_null(table):
    assert [r.daily_return_pct for r in feeds.asset_returns(market(table, [10.0])).collect()] == [None]
    out = feeds.asset_returns(market(table, [0.0, 5.0, 4.0])).orderBy("date").collect()
    assert [r.daily_return_pct for r in out] == [None, None, -20.0]


def test_constant_series_and_single_row_volatility(table):
    flat = facts.volatility_measures(feeds.price_volatility(market(table, [3.0] * 30))).orderBy("date").collect()
    last = flat[-1]
    assert (last.coefficient_of_variation, last.z_score, last.is_anomaly, last.risk_level) == (0.0, None, False, "low")
    first = flat[0]
    assert (first.coefficient_of_variation, first.risk_level, first.is_anomaly) == (None, None, False)


def test_label_boundaries(spark):
    values = spark.createDataFrame([(0.7,), (0.3,), (-0.3,), (-0.7,), (0.0,), (None,)], "c double")
    got = [r[0] for r in values.select(labels.correlation_strength(F.col("c"))).collect()]
    assert got == ["strong positive", "moderate positive", "moderate negative", "strong negative", "weak / none", None]
    risk = spark.createDataFrame([(0.0499,), (0.05,), (0.15,), (None,)], "c double")
    assert [r[0] for r in risk.select(labels.risk_level(F.col("c"))).collect()] == ["low", "medium", "high", None]


def test_spike_is_strict(table):
    volumes = [1.0] * 29 + [0.0]
    volumes[-1] = 2 * 29 / 28  # exactly twice its own 30-row average
    out = facts.labels.is_volume_spike(F.col("v"), F.col("a"))
    df = table("v double, a double", (2.0, 1.0), (2.1, 1.0), (1.0, 0.0), (1.0, None))
    assert [r[0] for r in df.select(out).collect()] == [False, True, False, False]


def test_sunday_in_iso_week_53(table):
    stocks = table(S.STOCKS, ("T", d("2021-01-03"), 1.0, 1.0, 1.0, 1.0, 1, None))
    unified = feeds.unified_feed(None, feeds.candle_metrics(table(CANDLE)))
    out = dims.dim_date(unified, stocks).first()
    assert (out.date_key, out.week, out.day_name, out.is_weekend, out.month_name) == (
        20210103, 53, "Sunday", True, "January"
    )


def test_sources_are_numbered_by_name(spark):
    assert rows(dims.dim_source(spark)) == [(1, "Alpha Vantage"), (2, "Binance"), (3, "CoinGecko")]


def _keys(table, symbol="a", n=60):
    asset = table(S.DIM_ASSET, (1, symbol, symbol, "Crypto", datetime(2024, 1, 1), None, True))
    date = table("date_key int, full_date date", *[(int(x.strftime("%Y%m%d")), x) for x in days("2024-01-01", n)])
    return asset, date


def test_alerts_and_their_messages(table):
    prices = [100.0] * 20 + [90.0, 85.5]  # exactly -10 %, then -5 %
    volumes = [10.0] * 21 + [100.0]
    m = market(table, prices, volumes=volumes)
    asset, date = _keys(table)
    volume = facts.fact_volume_analysis(feeds.volume_analysis(m), asset, date)
    swing = facts.fact_market_volatility(feeds.price_volatility(m), asset, date)
    got = rows(facts.fact_market_alerts(m, volume, swing, asset, date), "date", "alert_type", "alert_message")
    assert got == [
        (d("2024-01-21"), "price_drop", "Price dropped -10.00% (from $100.00 to $90.00)"),
        (d("2024-01-22"), "volume_spike", "Volume spiked 609.68% above the 30-day average"),
    ]


def test_high_volatility_message(table):
    m = market(table, [10.0, 20.0])
    asset, date = _keys(table)
    swing = facts.fact_market_volatility(feeds.price_volatility(m), asset, date)
    volume = facts.fact_volume_analysis(feeds.volume_analysis(m), asset, date)
    out = facts.fact_market_alerts(m, volume, swing, asset, date)
    assert rows(out, "alert_message") == [
        ("High volatility: 30-day price swing at 47.1% of the average price (z-score 0.71)",)
    ]


def test_zero_previous_price_raises_no_alert(table):
    m = market(table, [0.0, 5.0])
    asset, date = _keys(table)
    none = facts.fact_volume_analysis(feeds.volume_analysis(m), asset, date)
    swing = facts.fact_market_volatility(feeds.price_volatility(m), asset, date).limit(0)
    assert facts.fact_market_alerts(m, none, swing, asset, date).count() == 0


def test_pair_of_unknown_asset_is_dropped_but_shared_days_count(table):
    a, b = market(table, [1.0, 2.0, 3.0, 5.0]), market(table, [2.0, 1.0, 4.0, 3.0], symbol="b", kind="Stock")
    asset, date = _keys(table)
    returns = feeds.asset_returns(a.unionByName(b))
    assert facts.fact_asset_correlation(returns, asset, date).count() == 0
    both = asset.unionByName(asset.selectExpr("2L as asset_key", "'b' as asset_id", "'b' as symbol", "'Stock' as asset_type",
                                              "valid_from", "valid_to", "is_current"))
    out = facts.fact_asset_correlation(returns, both, date).orderBy("date_key").collect()
    assert [(r.observations_30d, r.pair_type) for r in out] == [(1, "Crypto-Stock"), (2, "Crypto-Stock"), (3, "Crypto-Stock")]
    assert out[0].correlation_30d is None and out[0].correlation_strength_30d is None
    assert (out[1].correlation_30d, out[1].correlation_strength_30d) == (-1.0, "strong negative")


def test_gainers_and_losers(table):
    day = d("2024-01-01")
    metrics = feeds.candle_metrics(
        table(CANDLE, ("n", day, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0, None), ("x", day, 100.0, 1.0, 1.0, 103.0, 1.0, 1.0, None),
              ("y", day, 100.0, 1.0, 1.0, 103.0, 1.0, 1.0, None), ("z", day, 100.0, 1.0, 1.0, 99.0, 1.0, 1.0, None))
    )
    out = feeds.top_gainers_losers(metrics)
    # the unknown change ranks first, so nobody is top gainer
    assert rows(out, "symbol", "gainer_rank", "loser_rank", "performance_label") == [
        ("n", 1, 4, "NEUTRAL"), ("x", 2, 2, "GAINER"), ("y", 2, 2, "GAINER"), ("z", 4, 1, "TOP LOSER")
    ]


def test_number_text(spark):
    df = spark.createDataFrame([(1234.5, 2.675), (0.12345, -0.001), (None, None), (0.99999, 0.0)], "p double, c double")
    got = [tuple(r) for r in df.select(money(F.col("p")), signed_pct(F.col("c"))).collect()]
    assert got == [("$1,234.50", "+2.68%"), ("$0.1235", "-0.00%"), ("n/a", "n/a"), ("$1.0000", "+0.00%")]
    names = spark.createDataFrame([("cardano",), ("TSLA",), ("",)], "s string")
    assert [r[0] for r in names.select(capitalise(F.col("s"))).collect()] == ["Cardano", "TSLA", ""]
