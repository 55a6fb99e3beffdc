from datetime import datetime

import pytest
from pyspark.sql import functions as F
from helpers import d, days, rows

from candlewick import schemas as S
from candlewick.operators.joins import map_symbols, pairs, pit_join, pit_unmatched


def t(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def dim(table):
    return table(
        S.DIM_ASSET,
        (1, "coin", "coin", "Crypto", t("2024-01-02"), t("2024-01-05"), False),
        (2, "coin", "coin", "Stock", t("2024-01-05"), None, True),
    )


@pytest.fixture
def fact(table):
    return table("asset_id string, date date", *[("coin", x) for x in days("2024-01-01", 6)], ("other", d("2024-01-03")))


def test_validity_is_half_open(fact, dim):
    out = pit_join(fact, dim, key="asset_id", date="date")
    assert rows(out, "date", "asset_key") == [
        (d("2024-01-02"), 1), (d("2024-01-03"), 1), (d("2024-01-04"), 1), (d("2024-01-05"), 2), (d("2024-01-06"), 2)
    ]


def test_facts_before_the_first_version_are_reported(fact, dim):
    lost = pit_unmatched(fact, dim, key="asset_id", date="date")
    assert rows(lost) == [("coin", d("2024-01-01")), ("other", d("2024-01-03"))]


def test_ticker_mapping_with_and_without_a_fallback(table):
    tickers = table("ticker string, asset_id string", ("AUSDT", "a"))
    df = table("symbol string, source string", ("AUSDT", "binance"), ("BUSDT", "binance"), ("AUSDT", "coingecko"))
    kept = map_symbols(df, tickers, col="symbol", only_source="binance")
    assert rows(kept, "symbol", "source", "asset_id") == [
        ("AUSDT", "binance", "a"), ("AUSDT", "coingecko", "AUSDT"), ("BUSDT", "binance", "BUSDT")
    ]
    strict = map_symbols(df, tickers, col="symbol", keep_unmapped=False)
    assert rows(strict, "symbol", "asset_id") == [("AUSDT", "a"), ("AUSDT", "a")]


@pytest.mark.parametrize("blocks", [None, 1, 2, 5])
def test_each_pair_of_a_date_appears_once(table, blocks):
    symbols = [f"s{i}" for i in range(9)]
    df = table("date date, symbol string, v int", *[(x, s, i) for x in days("2024-01-01", 3) for i, s in enumerate(symbols)])
    out = pairs(df, on="date", item="symbol", values=["v"], blocks=blocks)
    got = [(r.date, r.symbol_a, r.symbol_b) for r in out.collect()]
    n = len(symbols)
    assert len(got) == len(set(got)) == 3 * n * (n - 1) // 2
    for r in out.collect():
        assert r.symbol_a < r.symbol_b and f"s{r.v_a}" == r.symbol_a and f"s{r.v_b}" == r.symbol_b
    # all dates of a pair lie in one cell
    assert out.select("symbol_a", "symbol_b", "cell").distinct().count() == n * (n - 1) // 2


def test_pair_rows_are_not_shuffled_again_for_their_windows(spark, table):
    from candlewick.plans.facts import pair_correlation

    returns = table(
        "date date, symbol string, asset_type string, daily_return_pct double",
        *[(x, s, "Crypto", float(i)) for x in days("2024-01-01", 3) for i, s in enumerate("abc")],
    )
    plan = pair_correlation(returns)._jdf.queryExecution().executedPlan().toString()
    window, below = plan.split("Window", 1)[1].split("Join", 1)
    assert "Exchange" not in window and "Exchange" in below


@pytest.mark.parametrize("partitions", ["4", "200"])
def test_cells_follow_the_data_and_are_even(spark, partitions):
    """400 symbols: no task has twice the rows of the middle one, however many partitions the session asks for."""
    from pyspark.sql import functions as F

    df = spark.range(400 * 12).select(
        F.expr("date_add(date'2024-01-01', cast(id div 400 as int))").alias("date"), F.concat(F.lit("s"), F.col("id") % 400).alias("symbol"), F.lit(1).alias("v")
    )
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = pairs(df, on="date", item="symbol", values=["v"], cell_rows=30_000)
        tasks = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert sum(tasks) == 12 * 400 * 399 // 2
        assert len(tasks) > 30 and max(tasks) < 2 * tasks[len(tasks) // 2] and max(tasks) <= 35_000
        assert out.select("cell", F.spark_partition_id().alias("p")).distinct().groupBy("p").count().agg(F.max("count")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_correlation_of_new_days_equals_the_whole(spark, table):
    """Daily symbols, one that pauses for long, one that is new, one of week days, and one huge return."""
    import random

    from candlewick.plans import facts

    rng = random.Random(1)
    every = days("2023-01-01", 420)
    traded = {"a": every, "b": every, "w": [x for x in every if x.weekday() < 5], "late": every[390:], "pause": every[:200:3] + every[405:], "rare": every[::9]}
    traded |= {f"x{i}": every for i in range(10)}
    values = [(x, s, "Crypto", round(rng.gauss(0, 2), 4)) for s, own in traded.items() for x in own]
    values[100] = (*values[100][:3], 5e9)
    returns = table("date date, symbol string, asset_type string, daily_return_pct double", *values)
    names = ["symbol_a", "symbol_b", "date", "correlation_30d", "correlation_90d", "observations_30d", "observations_90d", "pair_type"]
    since = every[410]
    whole = facts.pair_correlation(returns).filter(F.col("date") >= since)
    far, start = facts.frame_history(returns, since, 90)
    assert {"pause", "rare"} <= {r.symbol for r in far.collect()} <= {"pause", "rare", "w"} and every[0] < start < since
    assert rows(facts.pair_correlation(returns, since=since), *names) == rows(whole, *names)
