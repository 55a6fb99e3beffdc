import json
from datetime import datetime, timedelta

import pytest
from helpers import days, rows

from candlewick import schemas as S
from candlewick import values as V
from candlewick.operators.joins import ticker_map
from candlewick.operators.writes import read_or_empty
from candlewick.plans import daily_run, facts, feeds

DAY = 86400000
EPOCH = datetime(1970, 1, 1)


def price(i, k):
    return round(100 + 10 * k + ((i * 7919 + k * 104729) % 23) - 0.3 * i, 2)


def make_payloads(table, start, n, bad=False):
    """One response per source and symbol over ``n`` days."""
    dates = days(start, n)

    def millis(x):
        return (datetime.combine(x, datetime.min.time()) - EPOCH).days * DAY

    coin, candles, stocks = [], [], []
    for k, (name, ticker) in enumerate([("bitcoin", "BTCUSDT"), ("ethereum", "ETHUSDT")]):
        points = [(millis(x), price(x.toordinal() % 97, k)) for x in dates]
        coin.append((name, json.dumps({
            "prices": points, "market_caps": [(t, v * 1000) for t, v in points],
            "total_volumes": [(t, v * 10) for t, v in points],
        })))
        candles.append((ticker, json.dumps([
            [t, str(v - 1), str(v + 2), str(v - 2), str(v), "5", t + DAY - 1, str(v * 5), 3, "2", str(v * 2), "0"]
            for t, v in points
        ])))
    series = {
        x.isoformat(): {"1. open": "50", "2. high": "60", "3. low": "40", "4. close": str(price(x.toordinal() % 97, 5)),
                        "5. volume": "12.5" if bad and x == dates[-1] else "1000"}
        for x in dates if x.weekday() < 5
    }
    stocks.append(("AAPL", json.dumps({"Time Series (Daily)": series})))
    schema = "symbol string, payload string"
    return {"coingecko": table(schema, *coin), "binance": table(schema, *candles), "alpha_vantage": table(schema, *stocks)}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("warehouse"))


def assert_same_as_rebuilt(spark, root, marts):
    """Facts that were brought up to date equal those built from the raw tables at once."""
    raw = {t: read_or_empty(spark, f"{root}/raw/{t}", s) for t, s in daily_run.FEED_TABLES.items()}
    unified = feeds.unified_feed(feeds.spot_daily(raw["coingecko_daily"]), feeds.candle_metrics(raw["binance_daily"]))
    tickers, asset, day = ticker_map(spark), marts["dim_asset"], marts["dim_date"]
    trends = facts.fact_price_trends(feeds.price_with_averages(unified, tickers), asset, day)
    assert rows(trends) == rows(marts["fact_price_trends"])
    prices = facts.fact_market_prices(facts.price_rows(unified, raw["alpha_vantage"], tickers), asset, day, marts["dim_source"])
    assert rows(prices) == rows(marts["fact_market_prices"])
    returns = feeds.asset_returns(feeds.market_comparison(unified, raw["alpha_vantage"], tickers))
    rebuilt = facts.fact_asset_correlation(returns, asset, day)
    names = [f.name for f in marts["fact_asset_correlation"].schema]
    assert rows(rebuilt, *names) == rows(marts["fact_asset_correlation"], *names) and rebuilt.count() > 0


def test_late_rows_and_old_corrections(spark, table, tmp_path, monkeypatch):
    """A symbol two months behind and a price corrected after two months end up as in a rebuild."""
    root, now = str(tmp_path / "w"), datetime(2024, 5, 1, 7, 45)

    def build(payloads, day, run_id):
        at = now + timedelta(days=day)
        daily_run.ingest(spark, payloads, root, run_id=run_id, now=at, override_days=200)
        return daily_run.build_models(spark, root, as_of=at.date())

    full = make_payloads(table, "2023-12-01", 152)
    ends = make_payloads(table, "2023-12-01", 80)
    only = lambda p, *names: {s: df.filter(df.symbol.isin(*names)) for s, df in p.items()}
    both = lambda a, b: {s: a[s].unionByName(b[s]) for s in a}
    # ethereum stops after 80 days, the others go on
    build(both(only(full, "bitcoin", "BTCUSDT", "AAPL"), only(ends, "ethereum", "ETHUSDT")), 0, "r1")

    # the rest of ethereum arrives, far older than any look-back
    read = []
    monkeypatch.setattr(facts, "frame_history", lambda known, since, n, run=facts.frame_history: read.append(since) or run(known, since, n))
    late = build(only(full, "ethereum", "ETHUSDT"), 1, "r2")
    assert late["asset_returns"].filter("symbol = 'ethereum'").count() == 152
    assert read == [days("2023-12-01", 81)[-1]]
    assert_same_as_rebuilt(spark, root, late)

    # nothing new: no correlation is computed
    build(only(full, "bitcoin"), 2, "r3")
    assert len(read) == 1

    # one price of bitcoin is corrected after sixty days
    fixed = only(full, "bitcoin").copy()
    old = days("2023-12-01", 92)[-1]
    point = json.loads(fixed["coingecko"].first().payload)
    for name in point:
        point[name] = [[t, v * (3 if t == (datetime.combine(old, datetime.min.time()) - EPOCH).days * DAY else 1)] for t, v in point[name]]
    fixed["coingecko"] = table("symbol string, payload string", ("bitcoin", json.dumps(point)))
    hit = []
    merge = daily_run._replace_keys
    monkeypatch.setattr(daily_run, "_replace_keys", lambda spark, path, batch, **k: hit.append((path.rsplit("/", 1)[1], batch.count())) or merge(spark, path, batch, **k))
    corrected = build(fixed, 3, "r4")
    assert read[1:] == [old]
    assert_same_as_rebuilt(spark, root, corrected)
    written = dict(hit)
    assert written["coingecko_daily"] == 1 and written["binance_metrics"] == 0
    # the thirty averages with that day in their frame, and the look-back of each asset
    assert written["fact_price_trends"] == 30 + 2 * (V.FACTS_LOOKBACK + 1)


def test_two_days_of_runs(spark, table, root):
    now = datetime(2024, 3, 1, 7, 45)
    out = daily_run.run(
        spark, make_payloads(table, "2024-01-20", 42, bad=True), root, run_id="r1", now=now, trees=False
    )
    assert out["checks"].filter("failures > 0").count() == 0

    log = read_or_empty(spark, f"{root}/state/pipeline_logs", S.RUN_LOG)
    # three coins, three pairs and one stock of the seeded assets have no payload
    assert rows(log, "source", "status") == [("alpha_vantage", "failed"), ("binance", "failed"), ("coingecko", "failed")]
    assert "TSLA" in {r.source_symbol for r in read_or_empty(spark, f"{root}/state/load_errors", S.LOAD_ERRORS).collect()}
    control = daily_run.read_control(spark, root).first()
    assert (control.last_run_status, control.is_first_load) == ("PARTIAL_SUCCESS", False)
    # a fractional volume is quarantined
    bad = read_or_empty(spark, f"{root}/state/quarantine", S.QUARANTINE).collect()
    assert [(r.run_id, r.source, r.symbol, r.bad_fields) for r in bad] == [("r1", "alpha_vantage", "AAPL", "volume")]
    failed = read_or_empty(spark, f"{root}/state/failed_symbols", S.FAILED_SYMBOLS)
    assert ("r1", "alpha_vantage", "TSLA") in rows(failed)
    # thirty newest days of the stock map, weekends not counted
    assert read_or_empty(spark, f"{root}/raw/alpha_vantage", S.STOCKS).count() <= 30

    stored = read_or_empty(spark, f"{root}/marts/fact_price_forecast", S.FORECASTS)
    assert stored.select("target_date").distinct().collect()[0][0].isoformat() == "2024-03-01"
    assert stored.count() == 2 * 3 * 3
    assert [r.created_at for r in out["market_summaries"].collect()] == [now]
    stamped = read_or_empty(spark, f"{root}/marts/fact_price_forecast", S.STORED_FORECASTS)
    assert {r.generated_at for r in stamped.collect()} == {now}
    log = read_or_empty(spark, f"{root}/marts/market_alerts_log", S.STORED_ALERTS)
    assert {r.sent_at for r in log.collect()} == {now}
    sent = out["alert_digest"].filter("kind = 'line'").count()
    assert sent == out["fact_market_alerts"].count()

    # the next day only fetches and reprocesses what it needs, and scores yesterday's forecast
    before = {name: rows(df) for name, df in out.items() if name in ("fact_market_prices", "fact_price_trends")}
    later = now + timedelta(days=1)
    again = daily_run.run(
        spark, make_payloads(table, "2024-02-28", 3), root, run_id="r2", now=later, trees=False
    )
    assert again["fact_forecast_detail"].count() == 2 * 3 * 3
    assert again["fact_forecast_accuracy"].filter("vs_naive_pct is null").count() == 0
    grown = rows(again["fact_market_prices"])
    assert set(before["fact_market_prices"]) <= set(grown) and len(grown) > len(before["fact_market_prices"])
    assert again["dim_asset"].filter("is_current").count() == 3

    assert_same_as_rebuilt(spark, root, again)

    # the same run once more changes nothing and sends nothing
    third = daily_run.run(
        spark, make_payloads(table, "2024-02-28", 3), root, run_id="r2", now=later, trees=False
    )
    assert rows(third["fact_market_prices"]) == grown
    assert third["alert_digest"].filter("kind = 'line'").count() == 0
    state = {"load_errors": S.LOAD_ERRORS, "quarantine": S.QUARANTINE, "failed_symbols": S.FAILED_SYMBOLS}
    for name, schema in state.items():
        stored = read_or_empty(spark, f"{root}/state/{name}", schema)
        assert stored.count() == stored.distinct().count()


def test_nothing_ingested_fails_and_keeps_the_mark(spark, table, tmp_path):
    empty = {s: table("symbol string, payload string") for s in ("coingecko", "binance", "alpha_vantage")}
    root = str(tmp_path / "w")
    with pytest.raises(ValueError):
        daily_run.run(spark, empty, root, run_id="r", now=datetime(2024, 3, 1))
    control = daily_run.read_control(spark, root).first()
    assert (control.last_run_status, control.is_first_load, control.last_load_timestamp) == ("FAILED", True, None)
