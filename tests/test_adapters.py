import json

import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from candlewick.operators.writes import upsert
from candlewick.sources import adapters, config

DAY = 86400000


@pytest.fixture
def payload(table):
    return lambda *pairs: table("symbol string, payload string", *[(s, json.dumps(p)) for s, p in pairs])


def test_unequal_parallel_arrays_are_cut_to_the_shortest(payload):
    body = {
        "prices": [[0, 1.5], [DAY, 2.5], [2 * DAY, 3.5]],
        "market_caps": [[0, 10], [DAY, 20]],
        "total_volumes": [[0, 7], [DAY, 8], [2 * DAY, 9]],
    }
    out = adapters.parse_parallel_arrays(payload(("coin", body))).drop(*adapters.ARRIVAL)
    assert rows(out) == [("coin", d("1970-01-01"), 1.5, 10.0, 7.0), ("coin", d("1970-01-02"), 2.5, 20.0, 8.0)]


def test_unusable_payloads_are_reported_and_lose_only_themselves(payload):
    good = {"prices": [[0, 1]], "market_caps": [[0, 1]], "total_volumes": [[0, 1]]}
    got = payload(("ok", good), ("none", {"error": "limit"}), ("empty", {"prices": [], "market_caps": [], "total_volumes": []}))
    assert rows(adapters.parse("coingecko", got), "__symbol__") == [("ok",)]
    assert rows(adapters.payload_errors("coingecko", got), "source_symbol") == [("empty",), ("none",)]
    assert rows(adapters.payload_errors("binance", payload(("a", []), ("b", {"code": -1}))), "source_symbol") == [("a",), ("b",)]
    told = adapters.payload_errors("alpha_vantage", payload(("a", {"Note": "limit"}), ("b", {"Error Message": "no such"}), ("c", {})))
    assert rows(told) == [("a", "no data in response: limit"), ("b", "no data in response: no such"), ("c", "no data in response")]


def test_klines_by_position_with_numbers_as_text(payload):
    line = [DAY - 1, "1.5", "3", "1", "2.5", "10", DAY * 2 - 1, "25", 4, "5", "12.5", "0"]
    out = adapters.parse_klines(payload(("AUSDT", [line, [DAY, *line[1:]]])))
    got = out.orderBy("__date__").collect()
    assert [r["__date__"] for r in got] == [d("1970-01-01"), d("1970-01-02")]
    assert (got[0].open, got[0].close_time, got[0].number_of_trades) == ("1.5", str(DAY * 2 - 1), "4")


def test_series_map_takes_newest_dates_before_checking_them(payload):
    fields = {"1. open": "1", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. volume": "100"}
    body = {"Time Series (Daily)": {k: fields for k in ("2024-01-03", "bad", "2024-01-02", "2024-01-01")}}
    out = adapters.parse_newest_series(payload(("T", body)), 3)
    # "bad" sorts first and uses up one of the three
    assert rows(out, "__date__") == [(d("2024-01-02"),), (d("2024-01-03"),)]
    assert adapters.parse_series_map(payload(("T", body))).count() == 3


def test_unknown_source_is_an_error(payload):
    with pytest.raises(ValueError):
        adapters.parse("nobody", payload(("a", {})))


def test_mapping_casts_or_quarantines(table):
    raw = table(
        "__symbol__ string, volume string, close string, extra string",
        ("ok", "12", "1.5", "x"), ("null", None, None, "x"), ("frac", "12.5", "1", "x"),
        ("word", "3", "abc", "x"), ("suffix", "3", "1.5d", "x"), ("both", "x", "y", "x"),
    )
    mapping = [("__symbol__", "symbol", "text"), ("volume", "volume", "bigint"), ("close", "close", "float"), ("gone", "gone", "float")]
    good, bad = adapters.apply_mapping(raw, mapping)
    assert good.columns == ["symbol", "volume", "close"]  # absent fields are left out
    assert rows(good) == [("null", None, None), ("ok", 12, 1.5)]
    assert rows(bad, "__symbol__", "bad_fields") == [
        ("both", "volume, close"), ("frac", "volume"), ("suffix", "close"), ("word", "close")
    ]


def test_numbers_already_typed_are_truncated_like_integers(table):
    good, bad = adapters.apply_mapping(table("v double", (12.7,)), [("v", "v", "bigint")])
    assert rows(good) == [(12,)] and bad.count() == 0


def test_seeding_keeps_edited_rows(spark):
    seeded = config.seed_config(spark)
    edited = dict(seeded, connections=seeded["connections"].withColumn("is_active", F.col("id") != 3))
    again = config.seed_config(spark, edited)
    assert [r.source_name for r in config.active_connections(again)] == ["coingecko", "binance"]
    assert again["asset_mapping"].count() == seeded["asset_mapping"].count() == 12
    assert config.active_columns(again, 1) == config.COLUMNS["coingecko"]
    assert config.table_of(again, 2)[2] == ["symbol", "date"]
    with pytest.raises(ValueError):
        config.table_of(again, 99)


def test_status_of_sources_and_of_the_run(table):
    loaded = table(
        "source string, symbol string, inserted bigint", ("a", "x", 5), ("a", "y", 0), ("b", "x", 3), ("c", "x", 0)
    )
    status = config.source_status(loaded)
    assert rows(status, "source", "records", "failed_symbols", "status") == [
        ("a", 5, 1, "failed"), ("b", 3, 0, "success"), ("c", 0, 1, "failed")
    ]
    assert config.run_status(status).first().run_status == "PARTIAL_SUCCESS"
    assert config.run_status(status.filter("source = 'b'")).first().run_status == "SUCCESS"
    assert config.run_status(status.filter("source = 'c'")).first().run_status == "FAILED"
    assert config.run_status(status.limit(0)).first().run_status == "FAILED"


def test_load_errors_keep_their_whole_message(table):
    errors = table("source_symbol string, error_message string", ("a", "x" * 3000))
    out = config.load_error_rows(errors, run_id="r", connection_id=1, at=F.lit("2024-01-01").cast("timestamp"))
    assert len(out.first().error_message) == 3000


def test_all_failed_symbols_are_kept(spark):
    loaded = spark.range(10_050).selectExpr("'a' as source", "concat('s', id) as symbol", "0L as inserted")
    assert config.failed_symbols(loaded).distinct().count() == 10_050


def test_the_last_point_of_a_day_is_stored(table, payload):
    """A spot feed sends midnight and now: two points of one day, the later one smaller."""
    body = {"prices": [[0, 100.0], [DAY - 1, 90.0], [DAY, 5.0]], "market_caps": [[0, 1], [0, 2], [0, 3]], "total_volumes": [[0, 1], [0, 2], [0, 3]]}
    mapping = [("__symbol__", "coin_id", "text"), ("__date__", "date", "date"), ("price", "price", "float")]
    good, bad = adapters.apply_mapping(
        adapters.parse("coingecko", payload(("c", body))), mapping, required=["coin_id", "date"], carry=adapters.ARRIVAL
    )
    empty = table("coin_id string, date date, price double")
    stored = upsert(empty, good, keys=["coin_id", "date"], order_by=adapters.ARRIVAL)
    assert rows(stored) == [("c", d("1970-01-01"), 90.0), ("c", d("1970-01-02"), 5.0)] and bad.count() == 0


def test_records_without_a_day_are_quarantined(payload):
    line = ["x", "1.5", "3", "1", "2.5", "10", 1, "25", 4, "5", "12.5", "0"]
    rows_ = adapters.parse("binance", payload(("AUSDT", [line, [0, *line[1:]]])))
    mapping = [("__symbol__", "symbol", "text"), ("__date__", "date", "date"), ("close", "close_price", "float")]
    good, bad = adapters.apply_mapping(rows_, mapping, required=["symbol", "date"], carry=adapters.ARRIVAL)
    assert good.count() == 1
    assert rows(bad, "__symbol__", "__record__", "bad_fields") == [("AUSDT", 0, "__date__")]
