"""The registered queries: every operator on the driver tables.

Each takes (spark, sf_dir) and returns a DataFrame over whole tables. Dates
leave as text and whole numbers as bigint, so results compare by value with
any other engine; numbers are rounded where their operator does not do so.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick import values as V
from candlewick.operators import forecast as M
from candlewick.operators.incremental import backfill_days, high_water_mark, incremental_filter
from candlewick.operators.joins import map_symbols, ticker_map, pit_join, pit_unmatched
from candlewick.operators.quality import Check, invariant_checks, mart_checks, run_checks
from candlewick.operators.windows import rolling
from candlewick.operators.writes import append_new_only, delete_insert, overwrite_table, read_or_empty, upsert
from candlewick.plans import daily_run, dims, facts, feeds, forecasts, reports
from candlewick.session import configure, fresh_path, literal, stage
from candlewick.sources import adapters, bindings, config
from candlewick.streaming.alerts import stream_alert_log
from candlewick.streaming.candles import CANDLE_SCHEMA, stream_candles

# Literal dates of the test calendar.
AS_OF = "2001-11-10"  # after the newest trade: all days are complete
CUT = "2000-01-01"
LOAD_FROM = "2001-10-15"
NOW = "2001-11-10"
TICK_ALERT = 50.0
# Sources in the order of their connections.
CONNECTED = [V.SPOT_SOURCE, V.CANDLE_SOURCE, V.STOCK_SOURCE]


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def present(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        c = F.col(f"`{field.name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind == "decimal":
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


class Market:
    """Feeds and models of one price source over one table directory.

    ``candles`` are the trades' own prices next to the spot feed; ``walk`` is
    the random walk alone. Dimensions are stored tables, as in a daily run.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, feed: str = "walk", digits: int | None = None):
        self.spark, self.sf_dir, self.feed, self.digits = configure(spark), sf_dir, feed, digits

    @cached_property
    def raw(self) -> DataFrame:
        if self.feed == "walk":
            return bindings.walk(self.spark, self.sf_dir, digits=self.digits)
        return bindings.candles(self.spark, self.sf_dir)

    @cached_property
    def spot(self) -> DataFrame:
        return feeds.spot_daily(bindings.spot(self.spark, self.sf_dir))

    @cached_property
    def stocks(self) -> DataFrame:
        return bindings.stocks(self.spark, self.sf_dir)

    @cached_property
    def tickers(self) -> DataFrame:
        return bindings.tickers(self.spark)

    @cached_property
    def metrics(self) -> DataFrame:
        return feeds.candle_metrics(self.raw)

    @cached_property
    def unified(self) -> DataFrame:
        return feeds.unified_feed(self.spot if self.feed == "candles" else None, self.metrics)

    @cached_property
    def market(self) -> DataFrame:
        return feeds.market_comparison(self.unified, self.stocks, self.tickers)

    def stored(self) -> Market:
        """The same market with its daily table stored, for queries that read it often."""
        self.market = stage(self.market, "market_comparison")
        return self

    @cached_property
    def returns(self) -> DataFrame:
        return feeds.asset_returns(self.market)

    @cached_property
    def snapshot(self) -> DataFrame:
        return dims.asset_snapshot(self.spot, self.stocks)

    @cached_property
    def _dims(self) -> tuple[DataFrame, DataFrame]:
        return (
            stage(dims.dim_asset(self.snapshot), "dim_asset"),
            stage(dims.dim_date(self.unified, self.stocks), "dim_date"),
        )

    @property
    def dim_asset(self) -> DataFrame:
        return self._dims[0]

    @property
    def dim_date(self) -> DataFrame:
        return self._dims[1]

    @cached_property
    def dim_source(self) -> DataFrame:
        return dims.dim_source(self.spark)

    @cached_property
    def price_rows(self) -> DataFrame:
        return facts.price_rows(self.unified, self.stocks, self.tickers)

    @cached_property
    def prices(self) -> DataFrame:
        return facts.fact_market_prices(self.price_rows, self.dim_asset, self.dim_date, self.dim_source)

    @cached_property
    def averages(self) -> DataFrame:
        return feeds.price_with_averages(self.unified, self.tickers)

    @cached_property
    def trends(self) -> DataFrame:
        return facts.fact_price_trends(self.averages, self.dim_asset, self.dim_date)

    @cached_property
    def volumes(self) -> DataFrame:
        return facts.fact_volume_analysis(feeds.volume_analysis(self.market), self.dim_asset, self.dim_date)

    @cached_property
    def volatility(self) -> DataFrame:
        return facts.fact_market_volatility(feeds.price_volatility(self.market), self.dim_asset, self.dim_date)

    @cached_property
    def correlations(self) -> DataFrame:
        return facts.fact_asset_correlation(self.returns, self.dim_asset, self.dim_date)

    @cached_property
    def alerts(self) -> DataFrame:
        return facts.fact_market_alerts(
            self.market, self.volumes, self.volatility, self.dim_asset, self.dim_date
        )

    @cached_property
    def panel(self) -> DataFrame:
        return M.completed_panel(self.metrics, day(AS_OF))


def forecast_market(spark: SparkSession, sf_dir: str) -> Market:
    return Market(spark, sf_dir, "walk", digits=6)


def candle_market(spark: SparkSession, sf_dir: str) -> Market:
    return Market(spark, sf_dir, "candles")


# ------------------------------------------------------------------- feeds


def candle_metrics(spark, sf_dir):
    m = candle_market(spark, sf_dir).metrics
    return present(rounded(m, 4, "open_price", "high_price", "low_price", "close_price", "quote_volume"))


def spot_daily(spark, sf_dir):
    return present(rounded(candle_market(spark, sf_dir).spot, 4, "price", "market_cap", "total_volume"))


def unified_feed(spark, sf_dir):
    u = candle_market(spark, sf_dir).unified
    return present(
        rounded(u, 4, "price", "market_cap", "total_volume", "open_price", "high_price", "low_price")
    )


def symbol_map_passthrough(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    mapped = map_symbols(m.unified, m.tickers, col="symbol", only_source=V.CANDLE_SOURCE)
    return present(mapped.select("source", "symbol", "date", "asset_id"))


def symbol_map_strict(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    mapped = map_symbols(m.metrics, m.tickers, col="symbol", keep_unmapped=False)
    return present(mapped.select("symbol", "trade_date", "asset_id"))


def unify_sources(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    return present(rounded(feeds.unify_sources(m.unified, m.tickers), 4, "price", "market_cap", "total_volume"))


def market_comparison(spark, sf_dir):
    return present(rounded(candle_market(spark, sf_dir).market, 4, "price", "total_volume"))


def asset_returns(spark, sf_dir):
    return present(rounded(Market(spark, sf_dir).returns, 4, "price", "prev_price"))


# ----------------------------------------------------------------- windows


def moving_averages(spark, sf_dir):
    a = candle_market(spark, sf_dir).averages
    return present(rounded(a, 4, "price", "market_cap", "total_volume"))


def rolling_volume(spark, sf_dir):
    v = feeds.volume_analysis(candle_market(spark, sf_dir).market)
    return present(rounded(v, 3, "total_volume", "avg_volume_7d", "avg_volume_30d"))


def rolling_volatility(spark, sf_dir):
    v = feeds.price_volatility(Market(spark, sf_dir).market)
    return present(
        rounded(v, 4, "price", "avg_price_7d", "stddev_price_7d", "avg_price_30d", "stddev_price_30d")
    )


def full_window_mean(spark, sf_dir):
    r = rolling(
        candle_market(spark, sf_dir).metrics.select("symbol", "trade_date", "close_price"),
        by="symbol",
        order="trade_date",
        full_window=True,
        frames={"ma_7": ("avg", "close_price", 7), "ma_30": ("avg", "close_price", 30)},
    )
    return present(rounded(r, 4, "close_price", "ma_7", "ma_30"))


def latest_per_symbol(spark, sf_dir):
    return present(rounded(reports.latest_prices(Market(spark, sf_dir).returns), 4, "price"))


def top_gainers_losers(spark, sf_dir):
    return present(rounded(feeds.top_gainers_losers(Market(spark, sf_dir).metrics), 4, "close_price", "volume"))


def best_worst(spark, sf_dir):
    return present(reports.best_worst(reports.latest_prices(Market(spark, sf_dir).returns)))


# ------------------------------------------------------- dimensions, joins


def dim_date(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    return present(dims.dim_date(m.unified, m.stocks))


def dim_source(spark, sf_dir):
    """Sources that the feeds have rows of, with the keys of the dimension."""
    m = candle_market(spark, sf_dir)
    counts = m.price_rows.groupBy("source_name").agg(F.count(F.lit(1)).alias("price_rows"))
    return present(counts.join(m.dim_source, "source_name"))


def _first_dim(m: Market) -> DataFrame:
    """Assets as known at CUT, without the coin that is listed later."""
    spot = m.spot.filter((F.col("date") < day(CUT)) & (F.col("coin_id") != "small"))
    return dims.dim_asset(dims.asset_snapshot(spot, m.stocks.filter(F.col("date") < day(CUT))))


def _changed_dim(m: Market) -> DataFrame:
    """The next state: one asset changes type and a new one appears."""
    kind = F.when(F.col("asset_id") == "promo", V.STOCK).otherwise(F.col("asset_type"))
    return dims.dim_asset(m.snapshot.withColumn("asset_type", kind), stage(_first_dim(m), "dim_asset"))


def scd2_initial(spark, sf_dir):
    return present(dims.dim_asset(candle_market(spark, sf_dir).snapshot))


def scd2_change(spark, sf_dir):
    return present(_changed_dim(candle_market(spark, sf_dir)))


def pit_join_query(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    dim = stage(_changed_dim(m), "dim_asset")
    joined = pit_join(
        m.price_rows.select("asset_id", "date", "source_name"), dim, key="asset_id", date="date",
        take={"asset_key": "asset_key", "asset_type": "asset_type"},
    )
    return present(joined)


def pit_unmatched_query(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    lost = pit_unmatched(m.price_rows, m.dim_asset, key="asset_id", date="date")
    return present(lost.groupBy("asset_id").agg(F.count(F.lit(1)).alias("facts_lost")))


def return_pairs(spark, sf_dir):
    return present(facts.return_pairs(Market(spark, sf_dir).returns).drop("cell"))


# ------------------------------------------------------------------- facts


def fact_market_prices(spark, sf_dir):
    p = candle_market(spark, sf_dir).prices
    return present(rounded(p, 4, "price", "total_volume", "open_price", "high_price", "low_price"))


def fact_price_trends(spark, sf_dir):
    return present(candle_market(spark, sf_dir).trends)


def fact_volume_analysis(spark, sf_dir):
    return present(candle_market(spark, sf_dir).volumes)


def fact_market_volatility(spark, sf_dir):
    return present(rounded(Market(spark, sf_dir).volatility, 6, "coefficient_of_variation", "z_score"))


def fact_asset_correlation(spark, sf_dir):
    return present(Market(spark, sf_dir).correlations)


def asset_correlation(spark, sf_dir):
    """Correlation of every pair of exchange symbols, unmapped ones included."""
    rolled = facts.pair_correlation(Market(spark, sf_dir).returns)
    return present(rolled.drop("cell", "asset_type_a", "asset_type_b", "daily_return_pct_a", "daily_return_pct_b"))


def _wide_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of one symbol per brand and type: up to 150."""
    metrics = feeds.candle_metrics(bindings.candles(configure(spark), sf_dir, wide=True))
    unified = feeds.unified_feed(None, metrics)
    stocks = bindings.stocks(spark, sf_dir)
    return feeds.asset_returns(feeds.market_comparison(unified, stocks, bindings.tickers(spark)))


def incremental_correlation(spark, sf_dir):
    """The stored fact of all days before the last twenty, and those days added to it."""
    m = Market(spark, sf_dir)
    returns = stage(m.returns, "returns")
    days = [r.date for r in returns.select("date").distinct().orderBy(F.col("date").desc()).limit(20).collect()]
    before = facts.fact_asset_correlation(returns.filter(F.col("date") < days[-1]), m.dim_asset, m.dim_date)
    after = facts.fact_asset_correlation(returns, m.dim_asset, m.dim_date, since=days[-1])
    return present(before.unionByName(after))


def asset_correlation_wide(spark, sf_dir):
    """Newest correlation of every pair of the wide symbol set."""
    rolled = facts.pair_correlation(_wide_returns(spark, sf_dir))
    newest = rolled.groupBy("symbol_a", "symbol_b").agg(
        F.count(F.lit(1)).alias("days"),
        F.max_by("correlation_30d", "date").alias("correlation_30d"),
        F.max_by("observations_90d", "date").alias("observations_90d"),
    )
    return present(newest)


def market_alerts(spark, sf_dir):
    return present(candle_market(spark, sf_dir).stored().alerts)


# ------------------------------------------------------ writes, increments


def _stored_trades(m: Market) -> tuple[DataFrame, DataFrame]:
    """Stored closes before CUT, and a batch of single trades that overlaps."""
    kept = m.metrics.filter(F.col("trade_date") < day(CUT)).select(
        "symbol",
        F.col("trade_date").alias("date"),
        F.col("close_price").alias("price"),
        F.col("volume").alias("quantity"),
        F.lit(0).cast("bigint").alias("seq"),
    )
    single = bindings.trades(m.spark, m.sf_dir).select(
        F.concat(F.upper("p_type"), F.lit("USDT")).alias("symbol"),
        "date",
        F.col("unit").alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    return kept, single.filter(F.col("date") >= F.date_sub(day(CUT), 30))


KEY = ["symbol", "date"]


def upsert_last_wins(spark, sf_dir):
    target, batch = _stored_trades(candle_market(spark, sf_dir))
    return present(rounded(upsert(target, batch, keys=KEY, order_by="seq"), 4, "price"))


def upsert_arrival_order(spark, sf_dir):
    """Payloads with every trade as a point, many a day: the last point of a day is stored."""
    trades = bindings.trades(spark, sf_dir).select(
        F.lower("p_type").alias("symbol"), "date", "l_orderkey", "l_linenumber", "unit"
    )
    points = trades.groupBy("symbol", F.date_format("date", "yyyyMM").cast("int").alias("position")).agg(
        F.array_sort(F.collect_list(F.struct(_millis("date").alias("t"), "l_orderkey", "l_linenumber", "unit"))).alias("_rows")
    )
    series = F.transform("_rows", lambda r: F.array(r["t"].cast("double"), r["unit"]))
    body = F.struct(series.alias("prices"), series.alias("market_caps"), series.alias("total_volumes"))
    payloads = points.select("symbol", "position", F.to_json(body).alias("payload"))
    good, _ = adapters.apply_mapping(
        adapters.parse(V.SPOT_SOURCE, payloads), config.COLUMNS[V.SPOT_SOURCE], required=["coin_id", "date"], carry=adapters.ARRIVAL
    )
    empty = literal(good.sparkSession, [], "coin_id string, date date, price double")
    batch = good.select("coin_id", "date", "price", *adapters.ARRIVAL)
    return present(rounded(upsert(empty, batch, keys=["coin_id", "date"], order_by=adapters.ARRIVAL), 4, "price"))


def delete_insert_query(spark, sf_dir):
    target, batch = _stored_trades(candle_market(spark, sf_dir))
    return present(rounded(delete_insert(target, batch, keys=KEY), 4, "price"))


def _logged(m: Market) -> tuple[DataFrame, DataFrame]:
    """(notification log up to CUT, all alerts), both stored."""
    alerts = stage(reports.alert_log_rows(m.alerts), "alerts")
    return alerts.filter(F.col("alert_date") < day(CUT)), alerts


def append_new_only_query(spark, sf_dir):
    log, batch = _logged(candle_market(spark, sf_dir).stored())
    twice = batch.unionByName(batch)
    return present(append_new_only(log, twice, keys=reports.ALERT_KEY)[1])


def unsent_alerts(spark, sf_dir):
    log, alerts = _logged(candle_market(spark, sf_dir).stored())
    named = alerts.withColumnsRenamed({"asset_id": "symbol", "alert_date": "date"})
    return present(reports.unsent_alerts(named, log))


def alert_digest(spark, sf_dir):
    log, batch = _logged(candle_market(spark, sf_dir).stored())
    _, new = append_new_only(log, batch, keys=reports.ALERT_KEY)
    return present(reports.alert_digest(stage(new, "new_alerts")))


def high_water_mark_query(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    mark = high_water_mark(m.metrics, date="trade_date")
    marked = m.spark.range(1).select(mark.alias("high_water_mark"))
    return present(
        marked.withColumns(
            {
                "reprocess_metrics_from": F.date_sub("high_water_mark", V.METRICS_LOOKBACK),
                "reprocess_facts_from": F.date_sub("high_water_mark", V.FACTS_LOOKBACK),
            }
        )
    )


def _corrected(m: Market) -> DataFrame:
    """The candle feed with every close corrected upwards by a tenth."""
    return m.raw.withColumn("close_price", F.col("close_price") * 1.1)


def incremental_candles(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    target = m.metrics.filter(F.col("trade_date") < day(CUT))
    fresh = incremental_filter(
        _corrected(m), target, date="date", target_date="trade_date", lookback_days=V.METRICS_LOOKBACK
    )
    table = delete_insert(target, feeds.candle_metrics(fresh), keys=["symbol", "trade_date"])
    return present(
        rounded(table, 4, "close_price").select(
            "symbol", "trade_date", "close_price", "price_change_percent", "volatility_label"
        )
    )


def incremental_per_key(spark, sf_dir):
    """Reprocessing with one mark per symbol; half the symbols lag behind."""
    m = candle_market(spark, sf_dir)
    lagging = F.col("symbol") < "N"
    target = m.metrics.filter(
        F.col("trade_date") < F.when(lagging, F.date_sub(day(CUT), 90)).otherwise(day(CUT))
    )
    fresh = incremental_filter(
        m.raw, target, date="date", target_date="trade_date", lookback_days=V.METRICS_LOOKBACK, per_key="symbol"
    )
    return present(
        fresh.groupBy("symbol").agg(F.min("date").alias("reprocessed_from"), F.count(F.lit(1)).alias("candles"))
    )


def incremental_facts(spark, sf_dir):
    m = candle_market(spark, sf_dir)
    cut_key = int(CUT.replace("-", ""))
    target = m.trends.filter(F.col("date_key") < cut_key)
    loaded = target.select("date_key").distinct().join(m.dim_date.select("date_key", "full_date"), "date_key")
    corrected = feeds.unified_feed(m.spot, feeds.candle_metrics(_corrected(m)))
    recent = incremental_filter(
        feeds.price_with_averages(corrected, m.tickers), loaded,
        date="date", target_date="full_date", lookback_days=V.FACTS_LOOKBACK,
    )
    batch = facts.fact_price_trends(recent, m.dim_asset, m.dim_date)
    return present(delete_insert(target, batch, keys=["asset_key", "date_key"]))


def backfill_window(spark, sf_dir):
    """Days to fetch per candle symbol, its newest candle being the last load."""
    m = candle_market(spark, sf_dir)
    control = m.metrics.groupBy(F.col("symbol").alias("pipeline_name")).agg(
        F.max("trade_date").cast("timestamp").alias("last_load_timestamp"),
        (F.count(F.lit(1)) < 10).alias("is_first_load"),
    )
    days = backfill_days(control, as_of=day(NOW))
    capped = backfill_days(control, as_of=day(NOW), max_days=7).select(
        "pipeline_name", F.col("backfill_days").alias("capped_days")
    )
    return present(
        days.join(capped, "pipeline_name").select(
            "pipeline_name", F.col("last_load_timestamp").cast("date").alias("last_load"), "backfill_days", "capped_days",
            "days_uncovered",
        )
    )


def _loaded(m: Market) -> DataFrame:
    """Rows per source and symbol that a load from LOAD_FROM brings."""
    rows = m.price_rows.select(
        F.col("source_name").alias("source"), F.col("asset_id").alias("symbol"), "date"
    )
    return rows.groupBy("source", "symbol").agg(
        F.sum((F.col("date") >= day(LOAD_FROM)).cast("bigint")).alias("inserted")
    )


def source_status(spark, sf_dir):
    return present(config.source_status(_loaded(candle_market(spark, sf_dir))))


def failed_symbols(spark, sf_dir):
    return present(config.failed_symbols(_loaded(candle_market(spark, sf_dir))))


def run_status(spark, sf_dir):
    return present(config.run_status(config.source_status(_loaded(candle_market(spark, sf_dir)))))


def run_log(spark, sf_dir):
    """The run log after a run was repeated: its rows are replaced by source."""
    status = config.source_status(_loaded(candle_market(spark, sf_dir))).select(
        F.lit("run-1").alias("run_id"), "source", "status", F.col("records").alias("records_inserted")
    )
    earlier = status.withColumns({"status": F.lit("failed"), "records_inserted": F.lit(0).cast("bigint")})
    other = earlier.withColumn("run_id", F.lit("run-0"))
    return present(upsert(earlier.unionByName(other), status, keys=["run_id", "source"], order_by=None))


def load_errors(spark, sf_dir):
    """Symbols of a load that brought nothing, as they are logged."""
    errors = _loaded(candle_market(spark, sf_dir)).filter("inserted = 0").select(
        F.col("symbol").alias("source_symbol"), F.lit("0 rows inserted").alias("error_message")
    )
    logged = config.load_error_rows(errors, run_id="run-1", connection_id=3, at=day(NOW).cast("timestamp"))
    return present(logged)


def daily_run_twice(spark, sf_dir):
    """Ingest, models, checks, alerts and summary from payloads of all feeds, the ingest twice for one run.

    The symbols of the tables are configured before the first run; those seeded
    on top of them have no payload and fail.
    """
    m = candle_market(spark, sf_dir)
    root = fresh_path(spark, "warehouse")
    payloads = {
        V.SPOT_SOURCE: spot_payloads(m), V.CANDLE_SOURCE: kline_payloads(m), V.STOCK_SOURCE: series_payloads(m, bad_numbers=True)
    }
    own = reduce(
        DataFrame.unionByName,
        [p.select(F.lit(i).alias("connection_id"), "symbol").distinct() for i, p in enumerate((payloads[s] for s in CONNECTED), 1)],
    )
    own = own.select(
        F.lit(None).cast("int").alias("id"), "connection_id", F.col("symbol").alias("source_symbol"),
        F.col("symbol").alias("display_name"), F.lit(True).alias("is_active"),
    )
    overwrite_table(own, f"{root}/config/asset_mapping")
    now = datetime.fromisoformat(NOW)
    tickers = ticker_map(spark, [*bindings.TEST_TICKERS, ("STANDARDUSDT", "standard")])
    payloads = {source: stage(df, "payloads") for source, df in payloads.items()}
    daily_run.ingest(spark, payloads, root, run_id="run-1", now=now, override_days=31)
    out = daily_run.run(spark, payloads, root, run_id="run-1", now=now, tickers=tickers, trees=False, override_days=31)

    def rows_of(name: str, df: DataFrame, key: Column | None = None) -> DataFrame:
        key = F.lit("") if key is None else key.cast("string")
        return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("item"), "key", "rows")

    state = {
        "pipeline_logs": (S.RUN_LOG, F.concat_ws(" ", "run_id", "source", "status", F.col("records_inserted").cast("string"))),
        "load_errors": (S.LOAD_ERRORS, F.concat_ws(" ", F.col("connection_id").cast("string"), "error_message")),
        "quarantine": (S.QUARANTINE, F.concat_ws(" ", "source", "bad_fields")),
        "failed_symbols": (S.FAILED_SYMBOLS, F.col("source")),
        "etl_control": (S.CONTROL, F.concat_ws(" ", "pipeline_name", "last_run_status", F.col("is_first_load").cast("string"))),
    }
    parts = [rows_of(n, read_or_empty(spark, f"{root}/state/{n}", schema), key) for n, (schema, key) in state.items()]
    for layer in ("landing", "raw"):
        parts += [rows_of(f"{layer} {t}", read_or_empty(spark, f"{root}/{layer}/{t}", schema)) for t, schema in daily_run.FEED_TABLES.items()]
    parts += [rows_of("asset_mapping", spark.read.parquet(f"{root}/config/asset_mapping"), F.col("connection_id"))]
    parts += [rows_of("market_summaries", out["market_summaries"], F.col("period_type")), rows_of("checks", out["checks"], F.col("failures"))]
    return present(reduce(DataFrame.unionByName, parts))


# ---------------------------------------------------------------- adapters


def _by_month(df: DataFrame, date: str, *columns: Column) -> DataFrame:
    """One payload's worth of records per symbol and month, in date order."""
    return df.groupBy("symbol", F.date_format(date, "yyyyMM").cast("int").alias("position")).agg(
        F.array_sort(F.collect_list(F.struct(*columns))).alias("_rows")
    )


def _millis(date: str) -> Column:
    return F.datediff(date, F.lit("1970-01-01")).cast("bigint") * 86400000


def spot_payloads(m: Market) -> DataFrame:
    rows = m.spot.select(F.col("coin_id").alias("symbol"), "date", "price", "market_cap", "total_volume")
    monthly = _by_month(rows, "date", _millis("date").alias("t"), "price", "market_cap", "total_volume")

    def series(field: str) -> Column:
        return F.transform("_rows", lambda r: F.array(r["t"].cast("double"), r[field]))

    body = F.struct(
        series("price").alias("prices"),
        series("market_cap").alias("market_caps"),
        series("total_volume").alias("total_volumes"),
    )
    return monthly.select("symbol", "position", F.to_json(body).alias("payload"))


def kline_payloads(m: Market) -> DataFrame:
    texts = [
        F.col(c).cast("string")
        for c in (
            "open_price", "high_price", "low_price", "close_price", "volume", "close_time",
            "quote_volume", "number_of_trades", "taker_buy_base_vol", "taker_buy_quote_vol",
        )
    ]
    monthly = _by_month(m.raw, "date", _millis("date").alias("t"), F.array(*texts).alias("f"))
    body = F.transform(
        "_rows", lambda r: F.concat(F.array(r["t"].cast("string")), r["f"])
    )
    return monthly.select("symbol", "position", F.to_json(body).alias("payload"))


def series_payloads(m: Market, bad_numbers: bool = False) -> DataFrame:
    volume = F.col("volume").cast("string")
    if bad_numbers:
        # a fraction where a whole number belongs
        volume = F.when(F.col("high") > 400000, F.concat(volume, F.lit(".5"))).otherwise(volume)
    fields = F.struct(
        F.col("open").cast("string").alias("1. open"),
        F.col("high").cast("string").alias("2. high"),
        F.col("low").cast("string").alias("3. low"),
        F.col("close").cast("string").alias("4. close"),
        volume.alias("5. volume"),
    )
    monthly = _by_month(m.stocks, "date", F.col("date").cast("string").alias("d"), fields.alias("v"))
    entries = F.map_from_entries("_rows")
    return monthly.select(
        "symbol", "position", F.to_json(F.struct(entries.alias("Time Series (Daily)"))).alias("payload")
    )


def parse_parallel_arrays(spark, sf_dir):
    rows = adapters.parse("coingecko", spot_payloads(candle_market(spark, sf_dir))).drop(*adapters.ARRIVAL)
    rows = rows.withColumnsRenamed({"__symbol__": "symbol", "__date__": "date"})
    return present(rounded(rows, 4, "price", "market_cap", "total_volume"))


def parse_klines(spark, sf_dir):
    rows = adapters.parse("binance", kline_payloads(candle_market(spark, sf_dir)))
    typed = rows.select(
        F.col("__symbol__").alias("symbol"),
        F.col("__date__").alias("date"),
        *[F.round(F.col(c).try_cast("double"), 4).alias(c) for c in adapters.KLINE_FIELDS],
    )
    return present(typed)


MONTH_ROWS = 15


def _typed_series(rows: DataFrame) -> DataFrame:
    typed = rows.select(
        F.col("__symbol__").alias("symbol"),
        F.col("__date__").alias("date"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    return present(typed)


def parse_series_map(spark, sf_dir):
    return _typed_series(adapters.parse(V.STOCK_SOURCE, series_payloads(candle_market(spark, sf_dir))))


def newest_series(spark, sf_dir):
    """Of each payload the newest days, as a fetch window takes them."""
    return _typed_series(adapters.parse_newest_series(series_payloads(candle_market(spark, sf_dir)), MONTH_ROWS))


def column_mapping(spark, sf_dir):
    rows = adapters.parse("binance", kline_payloads(candle_market(spark, sf_dir)))
    good, _ = adapters.apply_mapping(rows, config.COLUMNS["binance"])
    prices = ["open_price", "high_price", "low_price", "close_price", "quote_volume", "taker_buy_quote_vol"]
    return present(rounded(good, 4, *prices))


def quarantine_bad_rows(spark, sf_dir):
    rows = adapters.parse("alpha_vantage", series_payloads(candle_market(spark, sf_dir), bad_numbers=True))
    good, bad = adapters.apply_mapping(rows, config.COLUMNS["alpha_vantage"])
    kept = good.select("symbol", "date", F.col("volume").cast("string").alias("volume"), F.lit("").alias("bad_fields"))
    out = bad.select(F.col("__symbol__").alias("symbol"), F.col("__date__").alias("date"), "volume", "bad_fields")
    return present(kept.unionByName(out))


# ---------------------------------------------------------------- forecast


def completed_panel(spark, sf_dir):
    return present(rounded(forecast_market(spark, sf_dir).panel, 4, "close_price", "quote_volume"))


def panel_profile(spark, sf_dir):
    return present(M.panel_profile(forecast_market(spark, sf_dir).panel))


def forecast_features(spark, sf_dir):
    f = M.make_features(forecast_market(spark, sf_dir).panel)
    numbers = [c for c in f.columns if c not in ("symbol", "trade_date", "dow")]
    return present(rounded(f, 6, *numbers))


def forecast_naive(spark, sf_dir):
    panel = forecast_market(spark, sf_dir).panel
    return present(rounded(M.forecast_naive(panel, cutoff=day(CUT)), 4, "predicted_value"))


def ets_alpha(spark, sf_dir):
    fitted = M.fit_ets(forecast_market(spark, sf_dir).panel)
    return present(rounded(fitted.drop("sse", "last"), 4, "alpha", "level"))


def forecast_ets(spark, sf_dir):
    panel = forecast_market(spark, sf_dir).panel
    return present(rounded(M.forecast_ets(panel, cutoff=day(CUT)), 4, "predicted_value"))


def forecast_round(spark, sf_dir):
    panel = forecast_market(spark, sf_dir).panel
    cutoff, target_date = M.daily_cutoff(panel)
    made = M.forecast_round(panel, cutoff=cutoff, target_date=target_date)
    return present(rounded(made, 4, "predicted_value"))


def ensemble(spark, sf_dir):
    """Ensemble rows of the whole backtest."""
    made = M.backtest(forecast_market(spark, sf_dir).panel).filter("model_name = 'ensemble'")
    return present(rounded(made, 4, "predicted_value"))


def backtest_naive(spark, sf_dir):
    return present(rounded(M.backtest_naive(forecast_market(spark, sf_dir).panel), 4, "predicted_value"))


def backtest_ets(spark, sf_dir):
    return present(rounded(M.backtest_ets(forecast_market(spark, sf_dir).panel), 4, "predicted_value"))


def _detail(m: Market) -> DataFrame:
    return forecasts.fact_forecast_detail(
        M.backtest(m.panel), m.metrics, m.tickers, m.dim_asset, m.dim_date, as_of=day(AS_OF)
    )


def forecast_upsert(spark, sf_dir):
    """Backtest forecasts stored twice, the second time one percent higher."""
    made = M.backtest_naive(forecast_market(spark, sf_dir).panel)
    stored = forecasts.store_forecasts(literal(made.sparkSession, [], S.FORECASTS), made)
    later = made.filter(F.col("target_date") >= day(CUT)).withColumn(
        "predicted_value", F.col("predicted_value") * 1.01
    )
    return present(rounded(forecasts.store_forecasts(stored, later), 4, "predicted_value"))


def forecast_detail(spark, sf_dir):
    d = _detail(forecast_market(spark, sf_dir))
    return present(
        rounded(d, 3, "predicted_value", "actual_value", "error", "abs_error", "abs_pct_error")
    )


def forecast_accuracy(spark, sf_dir):
    a = forecasts.fact_forecast_accuracy(_detail(forecast_market(spark, sf_dir)))
    return present(rounded(a, 3, "mae", "rmse", "mape"))


def leaderboard(spark, sf_dir):
    return present(forecasts.leaderboard(forecasts.fact_forecast_accuracy(_detail(forecast_market(spark, sf_dir)))))


def autocorrelation(spark, sf_dir):
    a = forecasts.return_autocorrelation(Market(spark, sf_dir).returns, lags=[1, 2, 5])
    return present(rounded(a, 4, "autocorrelation", "abs_autocorrelation"))


#: Rounds that the SQL twins of the tree queries follow, and steps between refits of the backtest.
TREE_ROUNDS, REFIT_EVERY = 2, 40


def forecast_gbt(spark, sf_dir):
    """Boosted trees for all targets on the last day of the panel."""
    panel = stage(forecast_market(spark, sf_dir).panel, "panel")
    cutoff, _ = M.daily_cutoff(panel)
    features = stage(M.make_features(panel), "features")
    made = M.forecast_trees(features, cutoff=cutoff, rounds=TREE_ROUNDS)
    told = made.join(M.training_rows(features, cutoff=cutoff), "target_name")
    return present(rounded(told.select("symbol", "trade_date", "target_name", "training_rows", "predicted_value", "model_params"), 4, "predicted_value"))


def forecast_round_trees(spark, sf_dir):
    """One round with all models, trees and ensemble."""
    panel = stage(forecast_market(spark, sf_dir).panel, "panel")
    cutoff, target_date = M.daily_cutoff(panel)
    features = stage(M.make_features(panel), "features")
    made = M.forecast_round(panel, cutoff=cutoff, target_date=target_date, features=features, rounds=TREE_ROUNDS)
    return present(rounded(made, 4, "predicted_value"))


def backtest_gbt(spark, sf_dir):
    """Walk-forward forecasts of boosted trees, refitted every forty steps."""
    panel = stage(forecast_market(spark, sf_dir).panel, "panel")
    return present(rounded(M.backtest_gbt(panel, refit_every=REFIT_EVERY, rounds=TREE_ROUNDS), 4, "predicted_value"))


# --------------------------------------------------------- checks, reports


def dq_report(spark, sf_dir):
    """All checks over a whole set of marts, forecasts included."""
    m = forecast_market(spark, sf_dir).stored()
    detail = stage(_detail(m), "detail")
    tables = {
        "dim_date": m.dim_date,
        "dim_source": m.dim_source,
        "dim_asset": m.dim_asset,
        "fact_market_prices": stage(m.prices, "prices"),
        "fact_price_trends": stage(m.trends, "trends"),
        "fact_volume_analysis": stage(m.volumes, "volumes"),
        "fact_market_volatility": stage(m.volatility, "volatility"),
        "fact_market_alerts": stage(m.alerts, "alerts"),
        "fact_asset_correlation": stage(m.correlations, "correlations"),
        "fact_forecast_detail": detail,
        "fact_forecast_accuracy": forecasts.fact_forecast_accuracy(detail),
    }
    return present(run_checks(tables, mart_checks() + invariant_checks()))


RAW_CHECKS = [
    Check("not_null", "lineitem", "l_shipdate"),
    Check("accepted_values", "lineitem", "l_returnflag", ("A", "N")),
    Check("unique", "lineitem", "l_orderkey"),
    Check("unique_key", "lineitem", "l_orderkey, l_linenumber", ("l_orderkey", "l_linenumber")),
    Check("relationships", "lineitem", "l_partkey", ("part", "p_partkey")),
    Check("relationships", "lineitem", "l_orderkey", ("orders", "o_orderkey")),
    Check("unique", "orders", "o_orderkey"),
    Check("accepted_values", "orders", "o_orderstatus", ("F", "O")),
    Check("relationships", "orders", "o_custkey", ("customer", "c_custkey")),
]


def dq_raw(spark, sf_dir):
    """The check operators on the tables themselves, where some do fail."""
    tables = {
        name: bindings.table(spark, sf_dir, name) for name in ("lineitem", "orders", "part", "customer")
    }
    return present(run_checks(tables, RAW_CHECKS))


def alert_rollup(spark, sf_dir):
    alerts = stage(candle_market(spark, sf_dir).stored().alerts, "alerts")
    return present(reports.alert_rollup(alerts, alerts.agg(F.max("date").alias("d")).scalar()))


def pair_type_correlation(spark, sf_dir):
    return present(reports.pair_type_correlation(Market(spark, sf_dir).correlations))


def format_snapshot(spark, sf_dir):
    """One formatted line for every asset and day."""
    returns = Market(spark, sf_dir).returns
    return present(reports.price_lines(returns, returns.agg(F.max("date").alias("d")).scalar()))


def _snapshot(m: Market) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    latest = stage(reports.latest_prices(m.returns), "latest")
    alerts = stage(m.alerts, "alerts")
    as_of = latest.agg(F.max("date").alias("d")).scalar()
    rolled = stage(reports.alert_rollup(alerts, as_of), "rolled")
    return latest, rolled, stage(reports.pair_type_correlation(m.correlations), "related"), as_of


def snapshot_lines(spark, sf_dir):
    return present(reports.snapshot_lines(*_snapshot(Market(spark, sf_dir).stored())))


def daily_summary(spark, sf_dir):
    return present(reports.daily_summary(*_snapshot(Market(spark, sf_dir).stored())))


# --------------------------------------------------------------- streaming


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = bindings.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return bindings.ticks(events)


def stream_candles_query(spark, sf_dir):
    configure(spark)
    sink = fresh_path(spark, "candles")
    state = fresh_path(spark, "candles_state")
    stream_candles(_event_stream(spark, sf_dir), sink=sink, checkpoint=state).awaitTermination()
    table = read_or_empty(spark, sink, CANDLE_SCHEMA)
    prices = ["open_price", "high_price", "low_price", "close_price", "quote_volume"]
    return present(rounded(table, 4, *prices))


def stream_alert_dedupe(spark, sf_dir):
    """One alert per symbol and day, from its first tick above the limit."""
    configure(spark)
    sink = fresh_path(spark, "alert_log")
    raised = _event_stream(spark, sf_dir).filter(F.col("price") > TICK_ALERT)
    alerts = raised.select(
        F.col("symbol").alias("asset_id"),
        F.col("ts").cast("date").alias("alert_date"),
        F.lit("price_spike").alias("alert_type"),
        F.concat(F.lit("Price at "), F.round("price", 2).cast("decimal(38,2)").cast("string")).alias("alert_message"),
        "ts",
    )
    state = fresh_path(spark, "alert_state")
    stream_alert_log(alerts, sink=sink, order_by="ts", checkpoint=state).awaitTermination()
    return present(read_or_empty(spark, sink, S.ALERT_LOG))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__.removesuffix("_query"): f
    for f in (
        candle_metrics, spot_daily, unified_feed, symbol_map_passthrough, symbol_map_strict, unify_sources,
        market_comparison, asset_returns,
        moving_averages, rolling_volume, rolling_volatility, full_window_mean, latest_per_symbol,
        top_gainers_losers, best_worst,
        dim_date, dim_source, scd2_initial, scd2_change, pit_join_query, pit_unmatched_query, return_pairs,
        fact_market_prices, fact_price_trends, fact_volume_analysis, fact_market_volatility,
        fact_asset_correlation, incremental_correlation, asset_correlation, asset_correlation_wide, market_alerts,
        upsert_last_wins, upsert_arrival_order, delete_insert_query, append_new_only_query, unsent_alerts, alert_digest,
        high_water_mark_query, incremental_candles, incremental_per_key, incremental_facts, backfill_window,
        source_status, failed_symbols, run_status, run_log, load_errors, daily_run_twice,
        parse_parallel_arrays, parse_klines, parse_series_map, newest_series, column_mapping, quarantine_bad_rows,
        completed_panel, panel_profile, forecast_features, forecast_naive, ets_alpha, forecast_ets,
        forecast_round, ensemble, backtest_naive, backtest_ets, forecast_upsert, forecast_detail,
        forecast_accuracy, leaderboard, autocorrelation, forecast_gbt, forecast_round_trees, backtest_gbt,
        dq_report, dq_raw, alert_rollup, pair_type_correlation, format_snapshot, snapshot_lines, daily_summary,
        stream_candles_query, stream_alert_dedupe,
    )
}
