import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from candlewick.plans import reports


@pytest.fixture
def latest(table):
    return table(
        "symbol string, asset_type string, price double, daily_return_pct double, date date",
        ("bitcoin", "Crypto", 64000.0, 2.345, d("2024-01-08")), ("cardano", "Crypto", 0.45678, -1.0, d("2024-01-08")),
        ("TSLA", "Stock", 250.0, None, d("2024-01-05")),
    )


@pytest.fixture
def alerts(table):
    return table(
        "symbol string, date date, alert_type string, alert_message string",
        ("cardano", d("2024-01-08"), "price_drop", "m1"), ("bitcoin", d("2024-01-08"), "price_drop", "m2"),
        ("bitcoin", d("2024-01-08"), "volume_spike", "m3"), ("bitcoin", d("2024-01-07"), "high_volatility", "old"),
    )


@pytest.fixture
def related(table):
    return table("pair_type string, avg_correlation double, pair_count bigint", ("Crypto-Crypto", 0.8, 1), ("Crypto-Stock", 0.16, 2))


@pytest.fixture
def as_of(spark):
    return F.lit("2024-01-08").cast("date")


def lines(df):
    return [r.line for r in df.orderBy("section", "item").collect()]


def test_snapshot_text(latest, alerts, related, as_of):
    rolled = reports.alert_rollup(alerts, as_of)
    assert lines(reports.snapshot_lines(latest, rolled, related, as_of)) == [
        "Market data for 2024-01-08:",
        "CRYPTO:",
        "  Bitcoin: $64,000.00 (+2.35%)",
        "  Cardano: $0.4568 (-1.00%)",
        "STOCK:",
        "  TSLA: $250.00 (n/a) [as of 2024-01-05]",
        "ACTIVE ALERTS (3):",
        "  price_drop x2:",
        "    Bitcoin",
        "    Cardano",
        "  volume_spike x1:",
        "    Bitcoin",
        "30-DAY RETURN CORRELATION (latest per pair, averaged):",
        "  Crypto-Crypto: 0.80 (1 pair)",
        "  Crypto-Stock: 0.16 (2 pairs)",
    ]


def test_summary_text(latest, alerts, related, as_of):
    rolled = reports.alert_rollup(alerts, as_of)
    assert reports.daily_summary(latest, rolled, related, as_of).first().summary_text == (
        "Market summary for 2024-01-08. Best performer: Bitcoin at +2.35%. Weakest: Cardano at -1.00%. "
        "3 alert(s) active (price_drop, volume_spike). "
        "Average 30-day crypto correlation: 0.80, crypto-to-stock: 0.16."
    )


def test_texts_without_alerts_or_pairs(latest, alerts, related, as_of):
    none = reports.alert_rollup(alerts.limit(0), as_of)
    assert reports.daily_summary(latest, none, related.limit(0), as_of).first().summary_text == (
        "Market summary for 2024-01-08. Best performer: Bitcoin at +2.35%. Weakest: Cardano at -1.00%. No alerts active."
    )
    crypto = latest.filter("asset_type = 'Crypto'")
    assert lines(reports.snapshot_lines(crypto, none, related.limit(0), as_of)) == [
        "Market data for 2024-01-08:", "CRYPTO:", "  Bitcoin: $64,000.00 (+2.35%)", "  Cardano: $0.4568 (-1.00%)",
        "ACTIVE ALERTS: none",
    ]


def test_ties_keep_the_order_of_asset_type_and_symbol(table):
    schema = "symbol string, asset_type string, price double, daily_return_pct double, date date"
    rows_ = [(s, k, 1.0, r, d("2024-01-08")) for s, k, r in
             (("a", "Stock", 2.0), ("b", "Crypto", 2.0), ("c", "Crypto", 2.0), ("x", "Crypto", -1.0), ("v", "Stock", -1.0), ("w", "Stock", -1.0))]
    best = reports.best_worst(table(schema, *rows_)).first()
    assert (best.best_symbol, best.worst_symbol) == ("b", "w")


def test_newest_row_of_each_pair_counts(table):
    df = table(
        "symbol_a string, symbol_b string, pair_type string, correlation_30d double, date_key int",
        ("a", "b", "Crypto-Crypto", 0.1, 1), ("a", "b", "Crypto-Crypto", 0.5, 2), ("a", "b", "Crypto-Crypto", None, 3),
        ("a", "c", "Crypto-Crypto", 0.7, 1),
    )
    assert rows(reports.pair_type_correlation(df)) == [("Crypto-Crypto", 0.6, 2)]


def test_unsent_alerts_and_digest(alerts, table):
    log = table("asset_id string, alert_date date, alert_type string, alert_message string",
                ("bitcoin", d("2024-01-08"), "price_drop", "other text"))
    new = reports.unsent_alerts(alerts, log)
    assert new.count() == 3
    digest = reports.alert_digest(new.filter("alert_date = '2024-01-08'"))
    assert rows(digest.orderBy("kind", "symbol"), "line") == [
        ("- Bitcoin: m3",), ("- Cardano: m1",), ("2 new market alert(s)",)
    ]
