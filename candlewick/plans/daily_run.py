"""The daily run: ingest, models, checks, forecasts, alerts, summary.

Tables live under ``<root>/<layer>/<table>``. Every step reads what earlier
steps stored, so a run that stopped can be started again: all writes are
keyed and repeating them changes nothing.
"""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .. import values as V
from ..operators import forecast as M
from ..operators.incremental import advance_control, backfill_days, changed_rows, series_before, widened
from ..operators.joins import map_symbols, ticker_map
from ..operators.quality import invariant_checks, mart_checks, require_clean, run_checks
from ..operators.writes import (
    append_to_log,
    delete_insert,
    merge_table,
    newest_stored,
    overwrite_table,
    read_arrived,
    read_or_empty,
    read_since,
    replace_from,
    replace_slice,
    replace_table,
    table_exists,
    upsert,
)
from ..session import configure, literal, stage
from ..sources import adapters, config
from . import dims, facts, feeds, forecasts, reports

PIPELINE = "market_daily"

# Schema, key and date column of each landing and raw table.
FEED_TABLES = {
    "coingecko_daily": S.SPOT,
    "binance_daily": S.CANDLES,
    "alpha_vantage": S.STOCKS,
}

METRICS_SCHEMA = (
    "symbol string, trade_date date, open_price double, high_price double, low_price double, "
    "close_price double, volume double, quote_volume double, price_change double, "
    "price_change_percent double, volatility_pct double, volatility_label string, updated_at timestamp"
)
SPOT_DAILY_SCHEMA = "coin_id string, date date, price double, market_cap double, total_volume double"


def _path(root: str, layer: str, table: str) -> str:
    return f"{root}/{layer}/{table}"


def read_control(spark: SparkSession, root: str) -> DataFrame:
    """The control row, a first load before any run."""
    stored = read_or_empty(spark, _path(root, "state", "etl_control"), S.CONTROL)
    first = literal(spark, [(PIPELINE, None, True, None, None)], S.CONTROL)
    return stored.unionByName(first.join(stored.select("pipeline_name"), "pipeline_name", "left_anti"))


def ingest(
    spark: SparkSession,
    payloads: dict[str, DataFrame],
    root: str,
    *,
    run_id: str,
    now: datetime,
    override_days: int | None = None,
) -> str:
    """Parse, cast, land and archive one payload table per source.

    Returns the run status. A bad record or payload only loses itself; a
    source with a failed symbol is marked failed; nothing at all is FAILED.
    """
    configure(spark)
    at = F.lit(now).cast("timestamp")
    stored = {
        name: read_or_empty(spark, _path(root, "config", name), schema)
        for name, (schema, _) in config.CONFIG_TABLES.items()
    }
    settings = {name: stage(df, name) for name, df in config.seed_config(spark, stored).items()}
    for name, df in settings.items():
        overwrite_table(df, _path(root, "config", name))

    control = stage(read_control(spark, root), "control")
    window = backfill_days(control, as_of=F.lit(now.date()), override=override_days)
    days = window.first()["backfill_days"]

    statuses = []
    for connection in config.active_connections(settings):
        source = connection.source_name
        began = time.monotonic()
        _, table, keys = config.table_of(settings, connection.id)
        schema = FEED_TABLES[table]
        symbols = config.active_symbols(settings, connection.id)
        got = payloads[source].join(symbols.select(F.col("source_symbol").alias("symbol")), "symbol", "left_semi")
        got = stage(got, "payloads")

        if source == V.STOCK_SOURCE:  # this feed sends its whole history
            records = adapters.parse_newest_series(got, days)
        else:
            records = adapters.parse(source, got)
        good, bad = adapters.apply_mapping(
            records, config.active_columns(settings, connection.id), required=keys, carry=adapters.ARRIVAL
        )
        batch = stage(good.withColumn("updated_at", at), "batch")
        overwrite_table(
            upsert(literal(spark, [], schema), batch, keys=keys, order_by=adapters.ARRIVAL),
            _path(root, "landing", table),
        )
        landed = spark.read.schema(schema).parquet(_path(root, "landing", table))
        merge_table(
            spark,
            _path(root, "raw", table),
            landed,
            schema=schema,
            month_of="date",
            merge=partial(upsert, keys=keys, order_by=None),
        )

        counts = batch.groupBy(F.col(keys[0]).alias("symbol")).agg(F.count(F.lit(1)).alias("_n"))
        loaded = stage(
            symbols.select(F.col("source_symbol").alias("symbol"))
            .join(counts, "symbol", "left")
            .select(F.lit(source).alias("source"), "symbol", F.coalesce("_n", F.lit(0)).alias("inserted")),
            "loaded",
        )
        unusable = adapters.payload_errors(source, got)
        why = unusable.groupBy(F.col("source_symbol").alias("symbol")).agg(F.max("error_message").alias("_why"))
        skipped = bad.groupBy(F.col("__symbol__").alias("symbol")).agg(F.count(F.lit(1)).alias("_skipped"))
        none = F.concat_ws(", ", F.lit("0 rows inserted"), F.concat(F.col("_skipped").cast("string"), F.lit(" skipped")))
        errors = (
            loaded.filter("inserted = 0")
            .join(why, "symbol", "left")
            .join(skipped, "symbol", "left")
            .select(F.col("symbol").alias("source_symbol"), F.coalesce("_why", none).alias("error_message"))
        )
        replace_slice(
            config.load_error_rows(errors, run_id=run_id, connection_id=connection.id, at=at),
            _path(root, "state", "load_errors"),
            run_id=run_id, connection_id=str(connection.id),
        )
        quarantined = bad.select(
            F.lit(run_id).alias("run_id"),
            F.lit(source).alias("source"),
            F.col("__symbol__").alias("symbol"),
            F.col("__date__").alias("date"),
            F.col("__payload__").alias("payload"),
            F.col("__record__").alias("record"),
            "bad_fields",
        )
        replace_slice(quarantined, _path(root, "state", "quarantine"), run_id=run_id, source=source)
        failed = config.failed_symbols(loaded).select(F.lit(run_id).alias("run_id"), "source", "symbol")
        replace_slice(failed, _path(root, "state", "failed_symbols"), run_id=run_id, source=source)

        status = stage(config.source_status(loaded), "status")
        row = status.select(
            F.lit(run_id).alias("run_id"),
            "source",
            "status",
            F.col("records").alias("records_inserted"),
            F.lit(time.monotonic() - began).alias("duration_seconds"),
            F.when(
                F.col("failed_symbols") > 0, F.concat(F.col("failed_symbols").cast("string"), F.lit(" failed symbols"))
            ).alias("error_message"),
            at.alias("run_timestamp"),
        )
        log = read_or_empty(spark, _path(root, "state", "pipeline_logs"), S.RUN_LOG)
        log = upsert(log, row, keys=["run_id", "source"], order_by=None)
        replace_table(log, _path(root, "state", "pipeline_logs"))
        statuses.append(status)

    if not statuses:
        raise ValueError("no active connections")
    outcome = config.run_status(reduce(DataFrame.unionByName, statuses)).first()["run_status"]
    moved = advance_control(control, status=F.lit(outcome), now=at)
    replace_table(moved, _path(root, "state", "etl_control"))
    return outcome


def _look_back(spark: SparkSession, path: str, schema: str, column: str, days: int) -> date:
    """First day to reprocess of a stored model: its newest day less ``days``."""
    newest = newest_stored(spark, path, schema, column=column)
    if newest is None:
        newest = date.fromisoformat(V.EPOCH_SENTINEL)
    elif isinstance(newest, int):
        newest = datetime.strptime(str(newest), "%Y%m%d").date()
    return newest - timedelta(days=days)


def _replace_keys(
    spark: SparkSession, path: str, batch: DataFrame, *, schema: str, month_of: str, keys: list[str]
) -> DataFrame:
    merge_table(spark, path, batch, schema=schema, month_of=month_of, merge=partial(delete_insert, keys=keys))
    return read_or_empty(spark, path, schema)


def _rekeyed(dim_asset: DataFrame, before: DataFrame) -> DataFrame:
    """First day on which a fact may get another asset key than before."""
    new = changed_rows(dim_asset, before, keys=["asset_key"])
    return new.agg(F.min(F.coalesce("valid_to", "valid_from").cast("date")).alias("d"))


def least_date(*tables: DataFrame) -> date | None:
    """Earliest of some tables' single dates, or None."""
    found = [d for d in (t.first()[0] for t in tables) if d is not None]
    return min(found) if found else None


def build_models(
    spark: SparkSession, root: str, *, as_of: date, tickers: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Bring all models up to date from the raw tables and store them."""
    configure(spark)
    tickers = ticker_map(spark) if tickers is None else tickers
    raw = {t: _path(root, "raw", t) for t in FEED_TABLES}
    marks = {r.table_name: r.updated_at for r in read_or_empty(spark, _path(root, "state", "build_marks"), S.BUILD_MARKS).collect()}
    moved: list[DataFrame] = []

    def refresh(table: str, name: str, schema: str, keys: list[str], model, look_back: int) -> tuple[DataFrame, DataFrame, date]:
        """Bring a copy of a raw table up to date: the copy, its changed keys, and the first day of the look-back.

        New is what lies in the look-back or has arrived since the last build, so
        a symbol that lags behind loses nothing; rows stored like that already
        are left alone, and so is all that is made of them.
        """
        path, (symbol, day) = _path(root, "intermediate", name), keys
        since = _look_back(spark, path, schema, day, look_back)
        fresh = read_arrived(
            spark, raw[table], FEED_TABLES[table], date_col="date", since=since, arrived="updated_at", after=marks.get(table)
        )
        moved.append(fresh.agg(F.max("updated_at").alias("updated_at")).select(F.lit(table).alias("table_name"), "updated_at"))
        rows = changed_rows(model(fresh), read_or_empty(spark, path, schema), keys=keys, ignore=("updated_at",))
        rows = stage(rows, "changed")
        copy = _replace_keys(spark, path, rows, schema=schema, month_of=day, keys=keys)
        return copy, rows.select(F.col(symbol).alias("symbol"), F.col(day).alias("date")), since

    spot, spot_changed, _ = refresh(
        "coingecko_daily", "coingecko_daily", SPOT_DAILY_SCHEMA, ["coin_id", "date"], feeds.spot_daily, V.METRICS_LOOKBACK
    )
    metrics, metrics_changed, _ = refresh(
        "binance_daily", "binance_metrics", METRICS_SCHEMA, ["symbol", "trade_date"], feeds.candle_metrics, V.METRICS_LOOKBACK
    )
    stocks, stocks_changed, _ = refresh(
        "alpha_vantage", "stock_daily", S.STOCKS, ["symbol", "date"], lambda rows: rows, V.FACTS_LOOKBACK
    )

    unified = feeds.unified_feed(spot, metrics)
    # Read by returns, volume, volatility and alerts: stored once.
    market = stage(feeds.market_comparison(unified, stocks, tickers), "market_comparison")
    returns = feeds.asset_returns(market)

    marts: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame, layer: str = "marts", month_of: str | None = "date_key") -> DataFrame:
        path = _path(root, layer, name)
        overwrite_table(df, path, month_of=month_of)
        marts[name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)  # put there whole just now
        return marts[name]

    known = read_or_empty(spark, _path(root, "marts", "dim_asset"), S.DIM_ASSET)
    current = None if known.isEmpty() else known
    known_before = None if current is None else stage(current, "dim_before")
    dim = stage(dims.dim_asset(dims.asset_snapshot(spot, stocks), current), "dim_asset")
    dim_asset = store("dim_asset", dim, month_of=None)
    dim_date = store("dim_date", dims.dim_date(unified, stocks), month_of=None)
    dim_source = store("dim_source", dims.dim_source(spark), month_of=None)

    # Changed days of each asset; candles under the asset they map to, as in the merged feed.
    mapped = map_symbols(metrics_changed, tickers, col="symbol", to="asset").select(F.col("asset").alias("symbol"), "date")
    crypto_changed = stage(spot_changed.unionByName(mapped).distinct(), "crypto_changed")
    changed = stage(crypto_changed.unionByName(stocks_changed).distinct(), "changed")

    prices_path = _path(root, "marts", "fact_market_prices")
    since = _look_back(spark, prices_path, S.PRICE_FACT, "date_key", V.FACTS_LOOKBACK)

    def recent(rows: DataFrame, symbol: str, day: str, keys: DataFrame) -> DataFrame:
        """Rows of the look-back, and changed ones before it."""
        old = keys.filter(F.col("date") < since).select(F.col("symbol").alias(symbol), F.col("date").alias(day))
        return rows.filter(F.col(day) >= since).unionByName(rows.join(old, [symbol, day], "left_semi").filter(F.col(day) < since))

    new_feed = feeds.unified_feed(
        recent(spot, "coin_id", "date", spot_changed), recent(metrics, "symbol", "trade_date", metrics_changed)
    )
    price_rows = facts.price_rows(new_feed, recent(stocks, "symbol", "date", stocks_changed), tickers)
    marts["fact_market_prices"] = _replace_keys(
        spark, prices_path, facts.fact_market_prices(price_rows, dim_asset, dim_date, dim_source),
        schema=S.PRICE_FACT, month_of="date_key", keys=["asset_key", "date_key", "source_key"],
    )
    # An average changes with any of the rows in its frame: changed days, and the rows that follow them.
    trends_path = _path(root, "marts", "fact_price_trends")
    since = _look_back(spark, trends_path, S.TREND_FACT, "date_key", V.FACTS_LOOKBACK)
    paths = (_path(root, "intermediate", "coingecko_daily"), _path(root, "intermediate", "binance_metrics"))

    def merged_since(day: date) -> DataFrame:
        return feeds.unify_sources(
            feeds.unified_feed(
                read_since(spark, paths[0], SPOT_DAILY_SCHEMA, date_col="date", since=day),
                read_since(spark, paths[1], METRICS_SCHEMA, date_col="trade_date", since=day),
            ),
            tickers,
        )

    reach = merged_since(since).select("symbol", "date")
    redone = stage(crypto_changed.unionByName(reach).distinct(), "redone")
    first = dim_date.agg(F.min("full_date").alias("d")).first()["d"] or since
    series = series_before(merged_since, redone, by="symbol", order="date", rows=feeds.TREND_ROWS, first=first)
    hit = widened(series, redone, by="symbol", order="date", rows=feeds.TREND_ROWS).select(F.col("symbol").alias("coin_id"), "date")
    averages = feeds.averages(series).join(hit, ["coin_id", "date"], "left_semi")
    marts["fact_price_trends"] = _replace_keys(
        spark, trends_path, facts.fact_price_trends(averages, dim_asset, dim_date),
        schema=S.TREND_FACT, month_of="date_key", keys=["asset_key", "date_key"],
    )
    volumes = store("fact_volume_analysis", facts.fact_volume_analysis(feeds.volume_analysis(market), dim_asset, dim_date))
    volatility = store(
        "fact_market_volatility", facts.fact_market_volatility(feeds.price_volatility(market), dim_asset, dim_date)
    )
    # Frames end at their row: what lies before the first changed day stays as it is stored.
    correlation_path = _path(root, "marts", "fact_asset_correlation")
    if current is None or not table_exists(spark, correlation_path):
        since = None
    else:
        since = least_date(changed.agg(F.min("date").alias("d")), _rekeyed(dim_asset, known_before))
    if since is not None or not table_exists(spark, correlation_path):
        correlations = facts.fact_asset_correlation(returns, dim_asset, dim_date, since=since)
        if since is None:
            overwrite_table(correlations, correlation_path, month_of="date_key")
        else:
            replace_from(spark, correlation_path, correlations, month_of="date_key", since=since)
    marts["fact_asset_correlation"] = read_or_empty(spark, correlation_path, S.CORRELATION_FACT)
    store(
        "fact_market_alerts",
        facts.fact_market_alerts(market, volumes, volatility, dim_asset, dim_date),
        month_of="date",
    )
    store("top_gainers_losers", feeds.top_gainers_losers(metrics), layer="reports", month_of="trade_date")

    predictions = read_or_empty(spark, _path(root, "marts", "fact_price_forecast"), S.FORECASTS)
    detail = store(
        "fact_forecast_detail",
        forecasts.fact_forecast_detail(predictions, metrics, tickers, dim_asset, dim_date, as_of=F.lit(as_of)),
    )
    store("fact_forecast_accuracy", forecasts.fact_forecast_accuracy(detail), month_of=None)
    # Only now: a build that broke off reads the same arrivals again.
    arrived = reduce(DataFrame.unionByName, moved).filter(F.col("updated_at").isNotNull())
    marked = upsert(literal(spark, sorted(marks.items()), S.BUILD_MARKS), arrived, keys=["table_name"], order_by=None)
    replace_table(marked, _path(root, "state", "build_marks"))
    return marts | {"binance_metrics": metrics, "asset_returns": returns}


def check_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """Run all checks and stop if any fails."""
    report = stage(run_checks(marts, mart_checks() + invariant_checks()), "checks")
    require_clean(report)
    return report


def run_forecasts(
    spark: SparkSession,
    root: str,
    metrics: DataFrame,
    *,
    now: datetime,
    backtest: bool = False,
    trees: bool = True,
    refit_every: int = 7,
) -> None:
    """Forecast tomorrow, or every past day, and store by key."""
    panel = stage(M.completed_panel(metrics, F.lit(now.date())), "panel")
    if backtest:
        if M.backtest_steps(panel).filter("is_step").isEmpty():
            raise ValueError(f"history is too short: more than {V.BACKTEST_MIN_TRAIN + 1} days are needed")
        made = M.backtest(panel, trees=M.backtest_gbt(panel, refit_every=refit_every) if trees else None)
    else:
        cutoff, target_date = M.daily_cutoff(panel)
        features = stage(M.make_features(panel), "features") if trees else None
        made = M.forecast_round(panel, cutoff=cutoff, target_date=target_date, features=features)
    rows = made.withColumns({"predicted_value": F.round("predicted_value", 8), "generated_at": F.lit(now).cast("timestamp")})
    merge_table(
        spark,
        _path(root, "marts", "fact_price_forecast"),
        rows.filter(F.col("predicted_value").isNotNull()),
        schema=S.STORED_FORECASTS,
        month_of="target_date",
        merge=partial(upsert, keys=forecasts.FORECAST_KEY, order_by=None),
    )


def log_alerts(spark: SparkSession, root: str, alerts: DataFrame, *, now: datetime) -> DataFrame:
    """Log alerts not seen before and return their digest."""
    new = append_to_log(
        spark,
        _path(root, "marts", "market_alerts_log"),
        reports.alert_log_rows(alerts).withColumn("sent_at", F.lit(now).cast("timestamp")),
        schema=S.STORED_ALERTS,
        month_of="alert_date",
        keys=reports.ALERT_KEY,
    )
    return reports.alert_digest(new)


def write_summary(spark: SparkSession, root: str, marts: dict[str, DataFrame], *, now: datetime) -> DataFrame:
    """Store the summary of the newest day, one row per day."""
    latest = stage(reports.latest_prices(marts["asset_returns"]), "latest")
    day = latest.agg(F.max("date").alias("day")).first()["day"]
    if day is None:
        raise ValueError("no returns to summarise")
    as_of = F.lit(day)
    rolled = stage(reports.alert_rollup(marts["fact_market_alerts"], as_of), "alerts")
    related = stage(reports.pair_type_correlation(marts["fact_asset_correlation"]), "correlations")
    text = reports.daily_summary(latest, rolled, related, as_of).select(
        "summary_date", F.lit("daily").alias("period_type"), "summary_text", F.lit("fallback").alias("generated_by"),
        F.lit(now).cast("timestamp").alias("created_at"),
    )
    path = _path(root, "marts", "market_summaries")
    stored = read_or_empty(spark, path, S.STORED_SUMMARIES)
    replace_table(upsert(stored, text, keys=["summary_date", "period_type"], order_by=None), path)
    overwrite_table(reports.snapshot_lines(latest, rolled, related, as_of), _path(root, "reports", "snapshot_lines"))
    return read_or_empty(spark, path, S.STORED_SUMMARIES)


def run(
    spark: SparkSession,
    payloads: dict[str, DataFrame],
    root: str,
    *,
    run_id: str,
    now: datetime,
    tickers: DataFrame | None = None,
    trees: bool = True,
    override_days: int | None = None,
) -> dict[str, DataFrame]:
    """One whole daily run, in order; a failing step stops the ones after it."""
    outcome = ingest(spark, payloads, root, run_id=run_id, now=now, override_days=override_days)
    if outcome == "FAILED":
        raise ValueError("nothing was ingested")
    marts = build_models(spark, root, as_of=now.date(), tickers=tickers)
    report = check_marts(marts)
    run_forecasts(spark, root, marts["binance_metrics"], now=now, trees=trees)
    digest = log_alerts(spark, root, marts["fact_market_alerts"], now=now)
    summary = write_summary(spark, root, marts, now=now)
    return marts | {"checks": report, "alert_digest": digest, "market_summaries": summary}
