"""SQL twins of the registered queries, for DuckDB on the same tables.

Each query is a chain of named steps; ``sql`` keeps only the steps a query
needs. They are written from the definitions, not from the Spark plans.
"""

from __future__ import annotations

import re

from candlewick.sources.config import ASSETS
from candlewick.operators.boosting import BINS, CELLS, DEPTH, MIN_LEAF, RATE, SHRINK, UNIT
from candlewick.operators.forecast import FEATURES
from candlewick.operators.quality import Check, invariant_checks, mart_checks
from candlewick.values import BACKTEST_MIN_TRAIN, TREE_MIN_ROWS
from queries import AS_OF, CUT, LOAD_FROM, MONTH_ROWS, NOW, RAW_CHECKS, REFIT_EVERY, TICK_ALERT, TREE_ROUNDS


def r(x: str, digits: int) -> str:
    """Round half up on the decimal text of a number, not its binary value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def mean(x: str, digits: int, scale: int) -> str:
    """Mean of numbers with ``scale`` decimals, rounded to ``digits``."""
    return r(f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE) / count({x})", digits)


def text(x: str, digits: int) -> str:
    return f"CAST(CAST({r(x, digits)} AS DECIMAL(38,{digits})) AS VARCHAR)"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def rows(n: int, order: str = "date", by: str = "symbol") -> str:
    return f"(PARTITION BY {by} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


CENTS = "CAST(sum(CAST(round({0} * 100) AS BIGINT)) AS DOUBLE) / 100"

STEPS: dict[str, str] = {}


def step(name: str, body: str) -> None:
    STEPS[name] = body


def sql(body: str) -> str:
    """``body`` behind the steps it names, directly or through others."""
    known = STEPS
    seen: set[str] = set()
    needed: list[str] = []

    def visit(fragment: str) -> None:
        for word in re.findall(r"s_[a-z_0-9]+", fragment):
            if word in known and word not in seen:
                seen.add(word)
                visit(known[word])
                needed.append(word)

    visit(body)
    heads = []
    for name in needed:
        columns = "(symbol, target_name, k, i, level, sse)" if name == "s_fold" else ""
        heads.append(f"{name}{columns} AS ({known[name]})")
    return "WITH RECURSIVE " + ",\n".join(heads) + "\n" + body


# ------------------------------------------------------------------- feeds

step("s_trades", """
  SELECT l.*, p.p_type, p.p_brand, CAST(l.l_shipdate AS DATE) AS date,
         l.l_extendedprice / nullif(l.l_quantity, 0) AS unit
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")


def _candles(symbol: str) -> str:
    return f"""
  SELECT {symbol} AS symbol, date,
         first(unit ORDER BY l_orderkey, l_linenumber, unit) AS open_price,
         max(unit) AS high_price, min(unit) AS low_price,
         last(unit ORDER BY l_orderkey, l_linenumber, unit) AS close_price,
         sum(l_quantity) AS volume,
         (date_diff('day', DATE '1970-01-01', date) + 1) * 86400000 - 1 AS close_time,
         {CENTS.format('l_extendedprice')} AS quote_volume,
         count(*) AS number_of_trades,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS taker_buy_base_vol,
         coalesce(CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS DOUBLE), 0)
           / 100 AS taker_buy_quote_vol
  FROM s_trades GROUP BY 1, 2"""


step("s_candles", _candles("upper(p_type) || 'USDT'"))
step("s_wide_candles", _candles("p_brand || '_' || p_type"))
step("s_spot", f"""
  SELECT lower(p_type) AS coin_id, date,
         CAST(sum(CAST(round(unit * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 / count(unit) AS price,
         {CENTS.format('l_extendedprice')} AS market_cap, {CENTS.format('l_extendedprice')} AS total_volume
  FROM s_trades GROUP BY 1, 2""")
step("s_walk_base", f"""
  SELECT upper(p_type) || 'USDT' AS symbol, date,
         {CENTS.format('l_discount')} / count(*) - CAST(0.05 AS DOUBLE) AS m,
         sum(l_quantity) AS volume, {CENTS.format('l_extendedprice')} AS quote_volume
  FROM s_trades GROUP BY 1, 2""")


def _walk(price: str) -> str:
    return f"""
  SELECT symbol, date, open_price, greatest(open_price, close_price * (1 + abs(m))) AS high_price,
         least(open_price, close_price * (1 - abs(m))) AS low_price, close_price, volume, quote_volume
  FROM (SELECT *, coalesce(lag(close_price) OVER (PARTITION BY symbol ORDER BY date), close_price) AS open_price
        FROM (SELECT *, {price} AS close_price FROM s_walk_base))"""


_SUM_M = "exp(sum(m) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) * 100"
step("s_walk", _walk(_SUM_M))
step("s_walk6", _walk(r(_SUM_M, 6)))
step("s_stocks", """
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         first(o_totalprice ORDER BY o_orderkey, o_totalprice) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, last(o_totalprice ORDER BY o_orderkey, o_totalprice) AS close,
         count(*) AS volume
  FROM orders GROUP BY 1, 2""")
step("s_tickers", """
  SELECT * FROM (VALUES ('ECONOMYUSDT', 'economy'), ('LARGEUSDT', 'large'), ('MEDIUMUSDT', 'medium'),
                        ('PROMOUSDT', 'promo'), ('SMALLUSDT', 'small')) t(ticker, asset_id)""")


def _metrics(source: str) -> str:
    change, span = "close_price - open_price", "high_price - low_price"
    return f"""
  SELECT symbol, date AS trade_date, open_price, high_price, low_price, close_price, volume, quote_volume,
         {r(change, 6)} AS price_change,
         {r(div(change, 'open_price') + ' * 100', 2)} AS price_change_percent,
         {r(div(span, 'open_price') + ' * 100', 2)} AS volatility_pct,
         CASE WHEN {div(span, 'open_price')} * 100 < 2 THEN 'LOW'
              WHEN {div(span, 'open_price')} * 100 < 5 THEN 'MEDIUM' ELSE 'HIGH' END AS volatility_label,
         date AS updated_at
  FROM {source}"""


def _unified(metrics: str, with_spot: bool) -> str:
    spot = """
  SELECT coin_id AS symbol, date, price, market_cap, total_volume, CAST(NULL AS DOUBLE) AS open_price,
         CAST(NULL AS DOUBLE) AS high_price, CAST(NULL AS DOUBLE) AS low_price, 'coingecko' AS source
  FROM s_spot UNION ALL""" if with_spot else ""
    return spot + f"""
  SELECT symbol, trade_date AS date, close_price AS price, CAST(NULL AS DOUBLE) AS market_cap,
         quote_volume AS total_volume, open_price, high_price, low_price, 'binance' AS source
  FROM {metrics}"""


def _merged(unified: str) -> str:
    return f"""
  SELECT CASE WHEN u.source = 'binance' THEN coalesce(t.asset_id, u.symbol) ELSE u.symbol END AS symbol, date,
         avg(price) AS price, sum(market_cap) AS market_cap, sum(total_volume) AS total_volume
  FROM {unified} u LEFT JOIN s_tickers t ON t.ticker = u.symbol GROUP BY 1, 2"""


def _market(merged: str) -> str:
    return f"""
  SELECT symbol, date, price, total_volume, 'unified' AS source, 'Crypto' AS asset_type FROM {merged}
  UNION ALL
  SELECT symbol, date, close, CAST(volume AS DOUBLE), 'alpha_vantage', 'Stock' FROM s_stocks"""


def _averages(merged: str) -> str:
    ma = ", ".join(f"{r(f'avg(price) OVER {rows(n)}', 2)} AS moving_avg_{n}d" for n in (7, 14, 30))
    return f"SELECT symbol AS coin_id, date, price, market_cap, total_volume, {ma} FROM {merged}"


def _returns(market: str) -> str:
    return f"""
  SELECT symbol, date, asset_type, price, prev_price,
         {r(div('price - prev_price', 'prev_price') + ' * 100', 4)} AS daily_return_pct
  FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY date) AS prev_price FROM {market})"""


def _rolled_volume(market: str) -> str:
    return f"""
  SELECT symbol, date, total_volume, asset_type, avg(total_volume) OVER {rows(7)} AS avg_volume_7d,
         avg(total_volume) OVER {rows(30)} AS avg_volume_30d FROM {market}"""


def _rolled_price(market: str) -> str:
    cols = ", ".join(
        f"avg(price) OVER {rows(n)} AS avg_price_{n}d, stddev_samp(price) OVER {rows(n)} AS stddev_price_{n}d"
        for n in (7, 30)
    )
    return f"SELECT symbol, date, price, asset_type, {cols} FROM {market}"


# --------------------------------------------------- one set per price source

step("s_snapshot", """
  SELECT coin_id AS asset_id, 'Crypto' AS asset_type, min(date) AS first_seen, max(date) AS last_seen
  FROM s_spot GROUP BY 1
  UNION ALL
  SELECT symbol, 'Stock', min(date), max(date) FROM s_stocks GROUP BY 1""")
step("s_dim_asset", """
  SELECT row_number() OVER (ORDER BY asset_id) AS asset_key, asset_id, asset_id AS symbol, asset_type,
         first_seen AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current
  FROM s_snapshot""")
step("s_dim_source", """
  SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'Alpha Vantage'), (2, 'Binance'), (3, 'CoinGecko')) t(source_key, source_name)""")

CORR = "corr(return_a, return_b) OVER {0}"
PAIR = "symbol_a, symbol_b"


def pit(fact: str, key: str, dim: str, alias: str = "da", date: str = "date") -> str:
    return (
        f"JOIN {dim} {alias} ON {fact}.{key} = {alias}.asset_id AND {fact}.{date} >= {alias}.valid_from "
        f"AND ({alias}.valid_to IS NULL OR {fact}.{date} < {alias}.valid_to)"
    )


def _build(tag: str, candles: str, with_spot: bool) -> None:
    m, u, g, k = f"s_{tag}_metrics", f"s_{tag}_unified", f"s_{tag}_merged", f"s_{tag}_market"
    dates, ret = f"s_{tag}_dim_date", f"s_{tag}_returns"
    step(m, _metrics(candles))
    step(u, _unified(m, with_spot))
    step(g, _merged(u))
    step(k, _market(g))
    step(f"s_{tag}_averages", _averages(g))
    step(ret, _returns(k))
    step(f"s_{tag}_rolled_volume", _rolled_volume(k))
    step(f"s_{tag}_rolled_price", _rolled_price(k))
    step(dates, f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, day(d) AS day, month(d) AS month,
         quarter(d) AS quarter, year(d) AS year, weekofyear(d) AS week, dayname(d) AS day_name,
         monthname(d) AS month_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT date AS d FROM {u} UNION SELECT date FROM s_stocks)""")
    step(f"s_{tag}_price_rows", f"""
  SELECT CASE WHEN u.source = 'binance' THEN coalesce(t.asset_id, u.symbol) ELSE u.symbol END AS asset_id, date, price,
         total_volume, open_price, high_price, low_price,
         CASE u.source WHEN 'coingecko' THEN 'CoinGecko' WHEN 'binance' THEN 'Binance' END AS source_name
  FROM {u} u LEFT JOIN s_tickers t ON t.ticker = u.symbol
  UNION ALL
  SELECT symbol, date, close, CAST(volume AS DOUBLE), NULL, NULL, NULL, 'Alpha Vantage' FROM s_stocks""")
    step(f"s_{tag}_prices", f"""
  SELECT da.asset_key, dd.date_key, ds.source_key, f.price, f.total_volume, f.open_price, f.high_price, f.low_price
  FROM s_{tag}_price_rows f {pit('f', 'asset_id', 's_dim_asset')}
  JOIN {dates} dd ON f.date = dd.full_date JOIN s_dim_source ds USING (source_name)""")
    step(f"s_{tag}_trends", f"""
  SELECT da.asset_key, dd.date_key, moving_avg_7d, moving_avg_14d, moving_avg_30d
  FROM s_{tag}_averages f {pit('f', 'coin_id', 's_dim_asset')} JOIN {dates} dd ON f.date = dd.full_date""")
    step(f"s_{tag}_volumes", f"""
  SELECT da.asset_key, dd.date_key,
         {r(div('total_volume - avg_volume_7d', 'avg_volume_7d') + ' * 100', 2)} AS volume_change_pct_7d,
         {r(div('total_volume - avg_volume_30d', 'avg_volume_30d') + ' * 100', 2)} AS volume_change_pct_30d,
         coalesce(avg_volume_30d > 0 AND total_volume > 2 * avg_volume_30d, false) AS is_volume_spike
  FROM s_{tag}_rolled_volume f {pit('f', 'symbol', 's_dim_asset')} JOIN {dates} dd ON f.date = dd.full_date""")
    step(f"s_{tag}_volatility", f"""
  SELECT da.asset_key, dd.date_key, cv AS coefficient_of_variation, z AS z_score,
         coalesce(abs(z) > 2, false) AS is_anomaly,
         CASE WHEN cv IS NULL THEN NULL WHEN cv < 0.05 THEN 'low' WHEN cv < 0.15 THEN 'medium' ELSE 'high' END AS risk_level
  FROM (SELECT symbol, date, {div('stddev_price_30d', 'avg_price_30d')} AS cv,
               {div('price - avg_price_30d', 'stddev_price_30d')} AS z FROM s_{tag}_rolled_price) f
  {pit('f', 'symbol', 's_dim_asset')} JOIN {dates} dd ON f.date = dd.full_date""")
    step(f"s_{tag}_pairs", f"""
  SELECT a.date, a.symbol AS symbol_a, b.symbol AS symbol_b, a.asset_type AS asset_type_a, b.asset_type AS asset_type_b,
         a.daily_return_pct AS return_a, b.daily_return_pct AS return_b
  FROM {ret} a JOIN {ret} b ON a.date = b.date AND a.symbol < b.symbol
  WHERE a.daily_return_pct IS NOT NULL AND b.daily_return_pct IS NOT NULL""")
    w30, w90 = rows(30, by=PAIR), rows(90, by=PAIR)
    step(f"s_{tag}_correlated", f"""
  SELECT symbol_a, symbol_b, date, {r('c30', 4)} AS correlation_30d, {r('c90', 4)} AS correlation_90d,
         observations_30d, observations_90d,
         CASE WHEN asset_type_a = asset_type_b THEN asset_type_a || '-' || asset_type_b ELSE 'Crypto-Stock' END AS pair_type,
         CASE WHEN c30 IS NULL THEN NULL WHEN c30 >= 0.7 THEN 'strong positive' WHEN c30 >= 0.3 THEN 'moderate positive'
              WHEN c30 > -0.3 THEN 'weak / none' WHEN c30 > -0.7 THEN 'moderate negative'
              ELSE 'strong negative' END AS correlation_strength_30d
  FROM (SELECT * REPLACE (CASE WHEN isnan(c30) THEN NULL ELSE c30 END AS c30, CASE WHEN isnan(c90) THEN NULL ELSE c90 END AS c90)
        FROM (SELECT *, {CORR.format(w30)} AS c30, {CORR.format(w90)} AS c90,
                     count(*) OVER {w30} AS observations_30d, count(*) OVER {w90} AS observations_90d
              FROM s_{tag}_pairs))""")
    step(f"s_{tag}_correlations", f"""
  SELECT da.asset_key AS asset_key_a, db.asset_key AS asset_key_b, dd.date_key, f.symbol_a, f.symbol_b, f.pair_type,
         f.correlation_30d, f.correlation_90d, f.correlation_strength_30d, f.observations_30d, f.observations_90d
  FROM s_{tag}_correlated f {pit('f', 'symbol_a', 's_dim_asset')} {pit('f', 'symbol_b', 's_dim_asset', 'db')}
  JOIN {dates} dd ON f.date = dd.full_date""")
    drop = div("price - prev_price", "prev_price")
    step(f"s_{tag}_alerts", f"""
  SELECT symbol, date, 'price_drop' AS alert_type,
         'Price dropped ' || {text(drop + ' * 100', 2)} || '% (from $' || {text('prev_price', 2)} || ' to $'
           || {text('price', 2)} || ')' AS alert_message
  FROM {ret} WHERE {drop} <= -0.10
  UNION ALL
  SELECT m.symbol, m.date, 'volume_spike',
         'Volume spiked ' || {text('f.volume_change_pct_30d', 2)} || '% above the 30-day average'
  FROM s_{tag}_volumes f JOIN s_dim_asset da USING (asset_key) JOIN {dates} dd USING (date_key)
  JOIN {k} m ON m.symbol = da.asset_id AND m.date = dd.full_date WHERE f.is_volume_spike
  UNION ALL
  SELECT m.symbol, m.date, 'high_volatility',
         'High volatility: 30-day price swing at ' || {text('f.coefficient_of_variation * 100', 1)}
           || '% of the average price (z-score ' || {text('f.z_score', 2)} || ')'
  FROM s_{tag}_volatility f JOIN s_dim_asset da USING (asset_key) JOIN {dates} dd USING (date_key)
  JOIN {k} m ON m.symbol = da.asset_id AND m.date = dd.full_date WHERE f.risk_level = 'high'""")


_build("c", "s_candles", True)
_build("w", "s_walk", False)
_build("f", "s_walk6", False)
_build("x", "s_wide_candles", False)

# -------------------------------------------------------------- forecasting

SERIES = {"price": "close_price", "volatility": "volatility_pct", "volume": "quote_volume"}

step("s_panel", f"""
  SELECT symbol, trade_date, close_price, volatility_pct, quote_volume
  FROM s_f_metrics WHERE trade_date < DATE '{AS_OF}'""")
step("s_long", " UNION ALL ".join(
    f"SELECT symbol, trade_date, '{name}' AS target_name, {col} AS x, "
    f"row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS i FROM s_panel"
    for name, col in SERIES.items()))
step("s_fold", """
  SELECT symbol, target_name, CAST(a.k AS DOUBLE), i, x, CAST(0 AS DOUBLE) FROM s_long, range(1, 21) a(k) WHERE i = 1
  UNION ALL
  SELECT f.symbol, f.target_name, f.k, l.i, (f.k / 20) * l.x + (1 - (f.k / 20)) * f.level,
         f.sse + (l.x - f.level) * (l.x - f.level)
  FROM s_fold f JOIN s_long l ON l.symbol = f.symbol AND l.target_name = f.target_name AND l.i = f.i + 1""")
step("s_best", """
  SELECT symbol, target_name, i, arg_min(k, row(sse, k)) / 20 AS alpha, arg_min(level, row(sse, k)) AS level
  FROM s_fold GROUP BY 1, 2, 3""")
step("s_ets", """
  SELECT l.symbol, l.target_name, l.trade_date, l.i, b.alpha, b.level
  FROM s_long l JOIN s_best b USING (symbol, target_name, i)""")
step("s_steps", """
  SELECT * FROM (SELECT d AS cutoff, row_number() OVER (ORDER BY d) - 1 AS step, lead(d) OVER (ORDER BY d) AS target_date
                 FROM (SELECT DISTINCT trade_date AS d FROM s_panel))
  WHERE step >= 150 AND target_date IS NOT NULL""")


def _alpha(x: str) -> str:
    return f"'alpha=' || CAST(CAST(round({x}, 2) AS DECIMAL(4,2)) AS VARCHAR)"


step("s_grid", """
  SELECT s.cutoff, s.target_date, k.symbol, k.target_name
  FROM s_steps s, (SELECT DISTINCT symbol, target_name FROM s_long) k""")
step("s_back_naive", """
  SELECT g.symbol, g.cutoff, g.target_date, g.target_name, 'naive' AS model_name, CAST(1 AS BIGINT) AS horizon_days,
         l.x AS predicted_value, CAST(NULL AS VARCHAR) AS model_params
  FROM s_grid g ASOF JOIN s_long l
    ON g.symbol = l.symbol AND g.target_name = l.target_name AND g.cutoff >= l.trade_date
  WHERE l.i >= 30""")
step("s_back_ets", f"""
  SELECT g.symbol, g.cutoff, g.target_date, g.target_name, 'ets' AS model_name, CAST(1 AS BIGINT) AS horizon_days,
         l.level AS predicted_value, {_alpha('l.alpha')} AS model_params
  FROM s_grid g ASOF JOIN s_ets l
    ON g.symbol = l.symbol AND g.target_name = l.target_name AND g.cutoff >= l.trade_date
  WHERE l.i >= 30""")


def _ensemble(a: str, b: str) -> str:
    return f"""
  SELECT n.symbol, n.cutoff, n.target_date, n.target_name, 'ensemble' AS model_name, CAST(1 AS BIGINT) AS horizon_days,
         (n.predicted_value + e.predicted_value) / 2 AS predicted_value, 'ets+naive' AS model_params
  FROM {a} n JOIN {b} e USING (symbol, cutoff, target_date, target_name)"""


step("s_back_ensemble", _ensemble("s_back_naive", "s_back_ets"))
step("s_back", "SELECT * FROM s_back_naive UNION ALL SELECT * FROM s_back_ets UNION ALL SELECT * FROM s_back_ensemble")
step("s_detail", f"""
  SELECT asset_key, date_key, asset_id, symbol, target_date, target_name, model_name, horizon_days, model_params,
         {r('predicted_value', 8)} AS predicted_value, {r('actual', 8)} AS actual_value,
         {r('actual - predicted_value', 8)} AS error, {r('abs(actual - predicted_value)', 8)} AS abs_error,
         {r(div('abs(actual - predicted_value)', 'actual') + ' * 100', 4)} AS abs_pct_error
  FROM (SELECT f.*, t.asset_id, da.asset_key, dd.date_key,
               CASE f.target_name WHEN 'price' THEN a.close_price WHEN 'volatility' THEN a.volatility_pct
                                  ELSE a.quote_volume END AS actual
        FROM s_back f
        JOIN s_f_metrics a ON a.symbol = f.symbol AND a.trade_date = f.target_date AND a.trade_date < DATE '{AS_OF}'
        JOIN s_tickers t ON t.ticker = f.symbol
        {pit('t', 'asset_id', 's_dim_asset').replace('t.target_date', 'f.target_date').replace('t.date', 'f.target_date')}
        JOIN s_f_dim_date dd ON dd.full_date = f.target_date)""")
step("s_accuracy", f"""
  SELECT asset_key, asset_id, symbol, target_name, model_name, horizon_days, n_predictions,
         {r('mae', 6)} AS mae, {r('rmse', 6)} AS rmse, {r('mape', 4)} AS mape,
         {r(div('base - mae', 'base') + ' * 100', 2)} AS vs_naive_pct
  FROM (SELECT p.*, b.mae AS base FROM s_per_model p
        LEFT JOIN s_per_model b ON b.model_name = 'naive' AND b.asset_key = p.asset_key AND b.symbol = p.symbol
          AND b.target_name = p.target_name AND b.horizon_days = p.horizon_days)""")
step("s_per_model", """
  SELECT asset_key, asset_id, symbol, target_name, model_name, horizon_days, count(*) AS n_predictions,
         CAST(sum(CAST(abs_error AS DECIMAL(28,8))) AS DOUBLE) / count(abs_error) AS mae,
         sqrt(sum(error * error) / count(abs_error)) AS rmse,
         CAST(sum(CAST(abs_pct_error AS DECIMAL(28,8))) AS DOUBLE) / count(abs_pct_error) AS mape
  FROM s_detail GROUP BY ALL""")


def cols(text_cols: list[str], rounds: dict[str, int] | None = None, plain: list[str] | None = None) -> str:
    out = [f"CAST({c} AS VARCHAR) AS {c}" for c in text_cols]
    out += [f"{r(c, n)} AS {c}" for c, n in (rounds or {}).items()]
    return ", ".join(out + (plain or []))


def rounds(n: int, *names: str) -> dict[str, int]:
    return {c: n for c in names}


ORACLE_SQL: dict[str, str] = {}

# feeds
ORACLE_SQL["candle_metrics"] = sql("SELECT " + cols(
    ["trade_date"], rounds(4, "open_price", "high_price", "low_price", "close_price", "quote_volume"),
    ["symbol", "volume", "price_change", "price_change_percent", "volatility_pct", "volatility_label",
     "strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at"]) + " FROM s_c_metrics")
ORACLE_SQL["spot_daily"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "market_cap", "total_volume"), ["coin_id"]) + " FROM s_spot")
ORACLE_SQL["unified_feed"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "market_cap", "total_volume", "open_price", "high_price", "low_price"),
    ["symbol", "source"]) + " FROM s_c_unified")
ORACLE_SQL["symbol_map_passthrough"] = sql("""
SELECT u.source, u.symbol, CAST(date AS VARCHAR) AS date,
       CASE WHEN u.source = 'binance' AND t.asset_id IS NOT NULL THEN t.asset_id ELSE u.symbol END AS asset_id
FROM s_c_unified u LEFT JOIN s_tickers t ON t.ticker = u.symbol""")
ORACLE_SQL["symbol_map_strict"] = sql("""
SELECT symbol, CAST(trade_date AS VARCHAR) AS trade_date, asset_id
FROM s_c_metrics JOIN s_tickers ON ticker = symbol""")
ORACLE_SQL["unify_sources"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "market_cap", "total_volume"), ["symbol"]) + " FROM s_c_merged")
ORACLE_SQL["market_comparison"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "total_volume"), ["symbol", "source", "asset_type"]) + " FROM s_c_market")
ORACLE_SQL["asset_returns"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "prev_price"), ["symbol", "asset_type", "daily_return_pct"]) + " FROM s_w_returns")

# windows
ORACLE_SQL["moving_averages"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "market_cap", "total_volume"),
    ["coin_id", "moving_avg_7d", "moving_avg_14d", "moving_avg_30d"]) + " FROM s_c_averages")
ORACLE_SQL["rolling_volume"] = sql("SELECT " + cols(
    ["date"], rounds(3, "total_volume", "avg_volume_7d", "avg_volume_30d"), ["symbol", "asset_type"])
    + " FROM s_c_rolled_volume")
ORACLE_SQL["rolling_volatility"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "avg_price_7d", "stddev_price_7d", "avg_price_30d", "stddev_price_30d"),
    ["symbol", "asset_type"]) + " FROM s_w_rolled_price")


def full_mean(col: str, n: int, order: str = "trade_date") -> str:
    w = rows(n, order)
    return f"CASE WHEN count({col}) OVER {w} = {n} THEN avg({col}) OVER {w} END"


ORACLE_SQL["full_window_mean"] = sql(f"""
SELECT symbol, CAST(trade_date AS VARCHAR) AS trade_date, {r('close_price', 4)} AS close_price,
       {r(full_mean('close_price', 7), 4)} AS ma_7, {r(full_mean('close_price', 30), 4)} AS ma_30
FROM s_c_metrics""")
step("s_w_latest", """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM s_w_returns)
  WHERE rn = 1""")
ORACLE_SQL["latest_per_symbol"] = sql("SELECT " + cols(
    ["date"], {"price": 4}, ["symbol", "asset_type", "daily_return_pct"]) + " FROM s_w_latest")
ORACLE_SQL["top_gainers_losers"] = sql(f"""
SELECT symbol, CAST(trade_date AS VARCHAR) AS trade_date, {r('close_price', 4)} AS close_price, price_change,
       price_change_percent, {r('volume', 4)} AS volume, volatility_label, gainer_rank, loser_rank,
       CASE WHEN gainer_rank = 1 AND price_change_percent > 0 THEN 'TOP GAINER'
            WHEN loser_rank = 1 AND price_change_percent < 0 THEN 'TOP LOSER'
            WHEN price_change_percent > 0 THEN 'GAINER' WHEN price_change_percent < 0 THEN 'LOSER'
            ELSE 'NEUTRAL' END AS performance_label
FROM (SELECT *, rank() OVER (PARTITION BY trade_date ORDER BY price_change_percent DESC NULLS FIRST) AS gainer_rank,
             rank() OVER (PARTITION BY trade_date ORDER BY price_change_percent ASC NULLS LAST) AS loser_rank
      FROM s_w_metrics)""")
step("s_w_best", """
  SELECT (SELECT symbol FROM s_w_latest WHERE daily_return_pct IS NOT NULL ORDER BY daily_return_pct DESC, asset_type, symbol LIMIT 1) AS best_symbol,
         (SELECT max(daily_return_pct) FROM s_w_latest) AS best_pct,
         (SELECT symbol FROM s_w_latest WHERE daily_return_pct IS NOT NULL ORDER BY daily_return_pct, asset_type DESC, symbol DESC LIMIT 1) AS worst_symbol,
         (SELECT min(daily_return_pct) FROM s_w_latest) AS worst_pct""")
ORACLE_SQL["best_worst"] = sql("SELECT * FROM s_w_best")

# dimensions and joins
ORACLE_SQL["dim_date"] = sql(
    "SELECT " + cols(["full_date"], None, ["* EXCLUDE (full_date)"]) + " FROM s_c_dim_date")
ORACLE_SQL["dim_source"] = sql("""
SELECT source_name, source_key, count(*) AS price_rows FROM s_c_price_rows JOIN s_dim_source USING (source_name) GROUP BY 1, 2""")
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
DIM_COLS = f"asset_key, asset_id, symbol, asset_type, is_current, {STAMP.format('valid_from')}, {STAMP.format('valid_to')}"
ORACLE_SQL["scd2_initial"] = sql(f"SELECT {DIM_COLS} FROM s_dim_asset")
step("s_dim_first", f"""
  SELECT row_number() OVER (ORDER BY asset_id) AS asset_key, asset_id, asset_type, first_seen AS valid_from
  FROM (SELECT coin_id AS asset_id, 'Crypto' AS asset_type, min(date) AS first_seen FROM s_spot
        WHERE date < DATE '{CUT}' AND coin_id <> 'small' GROUP BY 1
        UNION ALL SELECT symbol, 'Stock', min(date) FROM s_stocks WHERE date < DATE '{CUT}' GROUP BY 1)""")
step("s_snapshot_now", """
  SELECT * REPLACE (CASE WHEN asset_id = 'promo' THEN 'Stock' ELSE asset_type END AS asset_type) FROM s_snapshot""")
step("s_dim_new", """
  SELECT (SELECT max(asset_key) FROM s_dim_first) + row_number() OVER (ORDER BY n.asset_id) AS asset_key, n.asset_id,
         n.asset_type, CASE WHEN d.asset_id IS NULL THEN n.first_seen ELSE n.last_seen END AS valid_from
  FROM s_snapshot_now n LEFT JOIN s_dim_first d ON d.asset_id = n.asset_id
  WHERE d.asset_id IS NULL OR d.asset_type <> n.asset_type""")
step("s_dim_changed", """
  SELECT d.asset_key, d.asset_id, d.asset_id AS symbol, d.asset_type, d.valid_from,
         CASE WHEN d.asset_type <> n.asset_type THEN n.last_seen END AS valid_to,
         d.asset_type = n.asset_type AS is_current
  FROM s_dim_first d JOIN s_snapshot_now n ON n.asset_id = d.asset_id
  UNION ALL
  SELECT asset_key, asset_id, asset_id, asset_type, valid_from, NULL, true FROM s_dim_new""")
ORACLE_SQL["scd2_change"] = sql(f"SELECT {DIM_COLS} FROM s_dim_changed")
ORACLE_SQL["pit_join"] = sql(f"""
SELECT f.asset_id, CAST(f.date AS VARCHAR) AS date, f.source_name, da.asset_key, da.asset_type
FROM s_c_price_rows f {pit('f', 'asset_id', 's_dim_changed')}""")
ORACLE_SQL["pit_unmatched"] = sql("""
SELECT asset_id, count(*) AS facts_lost FROM s_c_price_rows f
WHERE NOT EXISTS (SELECT 1 FROM s_dim_asset d WHERE d.asset_id = f.asset_id AND f.date >= d.valid_from)
GROUP BY 1""")
ORACLE_SQL["return_pairs"] = sql("SELECT " + cols(
    ["date"], None, ["symbol_a", "symbol_b", "asset_type_a", "asset_type_b", "return_a AS daily_return_pct_a",
                     "return_b AS daily_return_pct_b"]) + " FROM s_w_pairs")

# facts
ORACLE_SQL["fact_market_prices"] = sql("SELECT " + cols(
    [], rounds(4, "price", "total_volume", "open_price", "high_price", "low_price"),
    ["asset_key", "date_key", "source_key"]) + " FROM s_c_prices")
ORACLE_SQL["fact_price_trends"] = sql("SELECT * FROM s_c_trends")
ORACLE_SQL["fact_volume_analysis"] = sql("SELECT * FROM s_c_volumes")
ORACLE_SQL["fact_market_volatility"] = sql("SELECT " + cols(
    [], rounds(6, "coefficient_of_variation", "z_score"), ["asset_key", "date_key", "is_anomaly", "risk_level"])
    + " FROM s_w_volatility")
ORACLE_SQL["fact_asset_correlation"] = sql("SELECT * FROM s_w_correlations")
ORACLE_SQL["incremental_correlation"] = sql("SELECT * FROM s_w_correlations")
ORACLE_SQL["asset_correlation"] = sql(
    "SELECT " + cols(["date"], None, ["* EXCLUDE (date)"]) + " FROM s_w_correlated")
ORACLE_SQL["asset_correlation_wide"] = sql("""
SELECT symbol_a, symbol_b, count(*) AS days, max_by(correlation_30d, date) AS correlation_30d,
       max_by(observations_90d, date) AS observations_90d
FROM s_x_correlated GROUP BY 1, 2""")
ORACLE_SQL["market_alerts"] = sql("SELECT " + cols(
    ["date"], None, ["symbol", "alert_type", "alert_message"]) + " FROM s_c_alerts")

# writes and increments
step("s_stored", f"""
  SELECT symbol, trade_date AS date, close_price AS price, volume AS quantity, 0 AS seq
  FROM s_c_metrics WHERE trade_date < DATE '{CUT}'""")
step("s_batch", f"""
  SELECT upper(p_type) || 'USDT' AS symbol, date, unit AS price, l_quantity AS quantity,
         l_orderkey * 10 + l_linenumber AS seq
  FROM s_trades WHERE date >= DATE '{CUT}' - 30""")
step("s_kept", """
  SELECT * FROM s_stored s WHERE NOT EXISTS (SELECT 1 FROM s_batch b WHERE b.symbol = s.symbol AND b.date = s.date)""")
_STORED = "SELECT symbol, CAST(date AS VARCHAR) AS date, " + r("price", 4) + " AS price, quantity, seq FROM "
ORACLE_SQL["upsert_last_wins"] = sql(_STORED + """(
  SELECT * FROM s_kept UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC, price DESC, quantity DESC) AS rn
                              FROM s_batch) WHERE rn = 1)""")
ORACLE_SQL["upsert_arrival_order"] = sql(f"""
SELECT lower(p_type) AS coin_id, CAST(date AS VARCHAR) AS date, {r('last(unit ORDER BY l_orderkey, l_linenumber, unit)', 4)} AS price
FROM s_trades GROUP BY 1, 2""")
ORACLE_SQL["delete_insert"] = sql(_STORED + "(SELECT * FROM s_kept UNION ALL SELECT * FROM s_batch)")
_LOG = "symbol AS asset_id, CAST(date AS VARCHAR) AS alert_date, alert_type, alert_message"
ORACLE_SQL["append_new_only"] = sql(f"SELECT {_LOG} FROM s_c_alerts WHERE date >= DATE '{CUT}'")
ORACLE_SQL["unsent_alerts"] = sql(f"""
SELECT {_LOG} FROM s_c_alerts a WHERE NOT EXISTS (
  SELECT 1 FROM s_c_alerts l WHERE l.date < DATE '{CUT}' AND l.symbol = a.symbol AND l.date = a.date
    AND l.alert_type = a.alert_type)""")
SHOWN = "upper({0}[1]) || {0}[2:]"
ORACLE_SQL["alert_digest"] = sql(f"""
SELECT 'subject' AS kind, CAST(NULL AS VARCHAR) AS alert_date, CAST(NULL AS VARCHAR) AS symbol,
       CAST(NULL AS VARCHAR) AS alert_type, count(*) || ' new market alert(s)' AS line
FROM s_c_alerts WHERE date >= DATE '{CUT}'
UNION ALL
SELECT 'line', CAST(date AS VARCHAR), symbol, alert_type, '- ' || {SHOWN.format('symbol')} || ': ' || alert_message
FROM s_c_alerts WHERE date >= DATE '{CUT}'""")
ORACLE_SQL["high_water_mark"] = sql("""
SELECT CAST(d AS VARCHAR) AS high_water_mark, CAST(d - 3 AS VARCHAR) AS reprocess_metrics_from,
       CAST(d - 7 AS VARCHAR) AS reprocess_facts_from
FROM (SELECT coalesce(max(trade_date), DATE '1900-01-01') AS d FROM s_c_metrics)""")
step("s_corrected", "SELECT * REPLACE (close_price * CAST(1.1 AS DOUBLE) AS close_price) FROM s_candles")
step("s_corrected_metrics", _metrics("s_corrected"))
_MARK = f"(SELECT max(trade_date) FROM s_c_metrics WHERE trade_date < DATE '{CUT}')"
_INC = f"symbol, CAST(trade_date AS VARCHAR) AS trade_date, {r('close_price', 4)} AS close_price, price_change_percent, volatility_label"
ORACLE_SQL["incremental_candles"] = sql(f"""
SELECT {_INC} FROM s_corrected_metrics WHERE trade_date >= {_MARK} - 3
UNION ALL
SELECT {_INC} FROM s_c_metrics o WHERE trade_date < DATE '{CUT}' AND NOT (trade_date >= {_MARK} - 3)""")
ORACLE_SQL["incremental_per_key"] = sql(f"""
SELECT c.symbol, CAST(min(c.date) AS VARCHAR) AS reprocessed_from, count(*) AS candles
FROM s_candles c JOIN (
  SELECT symbol, max(trade_date) AS mark FROM s_c_metrics
  WHERE trade_date < CASE WHEN symbol < 'N' THEN DATE '{CUT}' - 90 ELSE DATE '{CUT}' END GROUP BY 1) k ON k.symbol = c.symbol
WHERE c.date >= k.mark - 3 GROUP BY 1""")
step("s_corr_unified", _unified("s_corrected_metrics", True))
step("s_corr_merged", _merged("s_corr_unified"))
step("s_corr_averages", _averages("s_corr_merged"))
step("s_old_trends", f"SELECT * FROM s_c_trends WHERE date_key < {CUT.replace('-', '')}")
step("s_new_trends", f"""
  SELECT da.asset_key, dd.date_key, moving_avg_7d, moving_avg_14d, moving_avg_30d
  FROM s_corr_averages f {pit('f', 'coin_id', 's_dim_asset')} JOIN s_c_dim_date dd ON f.date = dd.full_date
  WHERE f.date >= (SELECT max(full_date) FROM s_old_trends JOIN s_c_dim_date USING (date_key)) - 7""")
ORACLE_SQL["incremental_facts"] = sql("""
SELECT * FROM s_new_trends UNION ALL
SELECT * FROM s_old_trends o WHERE NOT EXISTS (
  SELECT 1 FROM s_new_trends n WHERE n.asset_key = o.asset_key AND n.date_key = o.date_key)""")
ORACLE_SQL["backfill_window"] = sql(f"""
SELECT symbol AS pipeline_name, CAST(d AS VARCHAR) AS last_load,
       CASE WHEN n < 10 THEN 30 ELSE greatest(1, least(DATE '{NOW}' - d + 1, 30)) END AS backfill_days,
       CASE WHEN n < 10 THEN 7 ELSE greatest(1, least(DATE '{NOW}' - d + 1, 7)) END AS capped_days,
       greatest(DATE '{NOW}' - d + 1 - 30, 0) AS days_uncovered
FROM (SELECT symbol, max(trade_date) AS d, count(*) AS n FROM s_c_metrics GROUP BY 1)""")
step("s_loaded", f"""
  SELECT source_name AS source, asset_id AS symbol, CAST(sum(CASE WHEN date >= DATE '{LOAD_FROM}' THEN 1 ELSE 0 END) AS BIGINT) AS inserted
  FROM s_c_price_rows GROUP BY 1, 2""")
step("s_status", """
  SELECT source, CAST(sum(inserted) AS BIGINT) AS records, count(*) FILTER (inserted = 0) AS failed_symbols,
         CASE WHEN min(inserted) = 0 THEN 'failed' ELSE 'success' END AS status
  FROM s_loaded GROUP BY 1""")
ORACLE_SQL["source_status"] = sql("""
SELECT source, records, failed_symbols, status FROM s_status""")
ORACLE_SQL["failed_symbols"] = sql("SELECT source, symbol FROM s_loaded WHERE inserted = 0")
ORACLE_SQL["run_status"] = sql("""
SELECT count(*) AS sources, CAST(sum(records) AS BIGINT) AS records,
       CASE WHEN sum(records) = 0 THEN 'FAILED' WHEN max(failed_symbols) > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS run_status
FROM s_status""")
ORACLE_SQL["run_log"] = sql("""
SELECT 'run-1' AS run_id, source, status, records AS records_inserted FROM s_status
UNION ALL SELECT 'run-0', source, 'failed', 0 FROM s_status""")
ORACLE_SQL["load_errors"] = sql(f"""
SELECT 'run-1' AS run_id, CAST(3 AS BIGINT) AS connection_id, symbol AS source_symbol,
       '0 rows inserted' AS error_message, '{NOW} 00:00:00' AS occurred_at
FROM s_loaded WHERE inserted = 0""")

_FEEDS = [(1, "coingecko", "coingecko_daily", "s_spot", "coin_id"), (2, "binance", "binance_daily", "s_candles", "symbol"),
          (3, "alpha_vantage", "alpha_vantage", "s_good_stocks", "symbol")]
_SEEDED = {i: len(ASSETS[source]) for i, source, *_ in _FEEDS}
step("s_good_stocks", "SELECT * FROM s_stocks WHERE NOT high > 400000")
_RUN = []
for _i, _source, _table, _rows, _symbol in _FEEDS:
    _RUN += [
        f"SELECT 'pipeline_logs' AS item, 'run-1 {_source} failed ' || count(*) AS key, CAST(1 AS BIGINT) AS rows FROM {_rows}",
        f"SELECT 'load_errors', '{_i} 0 rows inserted', {_SEEDED[_i]}",
        f"SELECT 'failed_symbols', '{_source}', {_SEEDED[_i]}",
        f"SELECT 'landing {_table}', '', count(*) FROM {_rows}",
        f"SELECT 'raw {_table}', '', count(*) FROM {_rows}",
        f"SELECT 'asset_mapping', '{_i}', {_SEEDED[_i]} + count(DISTINCT {_symbol}) FROM {'s_stocks' if _i == 3 else _rows}",
    ]
_RUN += [
    "SELECT 'quarantine', 'alpha_vantage volume', count(*) FROM s_stocks WHERE high > 400000 HAVING count(*) > 0",
    "SELECT 'etl_control', 'market_daily PARTIAL_SUCCESS false', 1",
    "SELECT 'market_summaries', 'daily', 1",
    f"SELECT 'checks', '0', {len(mart_checks() + invariant_checks())}",
]
ORACLE_SQL["daily_run_twice"] = sql("\nUNION ALL ".join(_RUN))

# adapters: the payloads are made from these tables, so parsing gives them back
ORACLE_SQL["parse_parallel_arrays"] = sql("SELECT " + cols(
    ["date"], rounds(4, "price", "market_cap", "total_volume"), ["coin_id AS symbol"]) + " FROM s_spot")
_KLINE = {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price", "volume": "volume",
          "close_time": "close_time", "quote_volume": "quote_volume", "number_of_trades": "number_of_trades",
          "taker_buy_base_vol": "taker_buy_base_vol", "taker_buy_quote_vol": "taker_buy_quote_vol"}
ORACLE_SQL["parse_klines"] = sql(
    "SELECT symbol, CAST(date AS VARCHAR) AS date, "
    + ", ".join(f"{r(f'CAST({c} AS DOUBLE)', 4)} AS {name}" for name, c in _KLINE.items()) + " FROM s_candles")
ORACLE_SQL["parse_series_map"] = sql("""
SELECT symbol, CAST(date AS VARCHAR) AS date, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM s_stocks""")
ORACLE_SQL["newest_series"] = sql(f"""
SELECT symbol, CAST(date AS VARCHAR) AS date, open, high, low, close, CAST(volume AS DOUBLE) AS volume
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('month', date) ORDER BY date DESC) AS rn FROM s_stocks)
WHERE rn <= {MONTH_ROWS}""")
ORACLE_SQL["column_mapping"] = sql("SELECT " + cols(
    ["date"], rounds(4, "open_price", "high_price", "low_price", "close_price", "quote_volume", "taker_buy_quote_vol"),
    ["symbol", "volume", "close_time", "number_of_trades", "taker_buy_base_vol"]) + " FROM s_candles")
ORACLE_SQL["quarantine_bad_rows"] = sql("""
SELECT symbol, CAST(date AS VARCHAR) AS date,
       CASE WHEN high > 400000 THEN volume || '.5' ELSE CAST(volume AS VARCHAR) END AS volume,
       CASE WHEN high > 400000 THEN 'volume' ELSE '' END AS bad_fields
FROM s_stocks""")

# forecasting
ORACLE_SQL["completed_panel"] = sql("SELECT " + cols(
    ["trade_date"], rounds(4, "close_price", "quote_volume"), ["symbol", "volatility_pct"]) + " FROM s_panel")
ORACLE_SQL["panel_profile"] = sql("""
SELECT count(*) AS rows, count(DISTINCT symbol) AS symbols, CAST(min(trade_date) AS VARCHAR) AS first_date,
       CAST(max(trade_date) AS VARCHAR) AS last_date FROM s_panel""")
_BY_DAY = "OVER (PARTITION BY symbol ORDER BY trade_date)"
step("s_changes", f"""
  SELECT *, close_price / lag(close_price) {_BY_DAY} - 1 AS ret,
         quote_volume / lag(quote_volume) {_BY_DAY} - 1 AS volume_ret FROM s_panel""")
step("s_features", f"""
  SELECT symbol, trade_date, close_price, volatility_pct, quote_volume, ret, lag(ret, 1) {_BY_DAY} AS ret_lag1,
         lag(ret, 2) {_BY_DAY} AS ret_lag2, lag(ret, 6) {_BY_DAY} AS ret_lag6,
         close_price / ({full_mean('close_price', 7)}) - 1 AS price_vs_ma7,
         close_price / ({full_mean('close_price', 30)}) - 1 AS price_vs_ma30,
         {full_mean('volatility_pct', 7)} AS vol_ma_7,
         quote_volume / ({full_mean('quote_volume', 30)}) AS volume_ratio,
         isodow(trade_date) - 1 AS dow, lead(ret) {_BY_DAY} AS target_price_ret,
         lead(volatility_pct) {_BY_DAY} AS target_volatility, lead(volume_ret) {_BY_DAY} AS target_volume_ret
  FROM s_changes""")
ORACLE_SQL["forecast_features"] = sql("SELECT " + cols(
    ["trade_date"], rounds(6, "close_price", "volatility_pct", "quote_volume", "ret", "ret_lag1", "ret_lag2", "ret_lag6",
                           "price_vs_ma7", "price_vs_ma30", "vol_ma_7", "volume_ratio", "target_price_ret",
                           "target_volatility", "target_volume_ret"), ["symbol", "dow"]) + " FROM s_features")
step("s_cut_long", f"SELECT * FROM s_long WHERE trade_date <= DATE '{CUT}'")
step("s_cut_last", "SELECT symbol, target_name, max(i) AS i FROM s_cut_long GROUP BY 1, 2 HAVING max(i) >= 30")
ORACLE_SQL["forecast_naive"] = sql(f"""
SELECT symbol, target_name, {r('x', 4)} AS predicted_value FROM s_long JOIN s_cut_last USING (symbol, target_name, i)""")
ORACLE_SQL["ets_alpha"] = sql(f"""
SELECT symbol, target_name, {r('alpha', 4)} AS alpha, {r('level', 4)} AS level
FROM s_best JOIN (SELECT symbol, target_name, max(i) AS i FROM s_long GROUP BY 1, 2) USING (symbol, target_name, i)
WHERE i >= 30""")
ORACLE_SQL["forecast_ets"] = sql(f"""
SELECT symbol, target_name, {r('level', 4)} AS predicted_value, {_alpha('alpha')} AS model_params
FROM s_best JOIN s_cut_last USING (symbol, target_name, i)""")
_FC = ("symbol, CAST(cutoff AS VARCHAR) AS cutoff, CAST(target_date AS VARCHAR) AS target_date, target_name, model_name, "
       f"horizon_days, {r('predicted_value', 4)} AS predicted_value, model_params")
step("s_last_day", "SELECT max(trade_date) AS cutoff, max(trade_date) + 1 AS target_date FROM s_panel")
step("s_newest", """
  SELECT e.*, l.x FROM s_ets e JOIN s_long l USING (symbol, target_name, i)
  JOIN (SELECT symbol, target_name, max(i) AS i FROM s_long GROUP BY 1, 2) USING (symbol, target_name, i) WHERE i >= 30""")
step("s_round_naive", """
  SELECT symbol, cutoff, target_date, target_name, 'naive' AS model_name, CAST(1 AS BIGINT) AS horizon_days, x AS predicted_value,
         CAST(NULL AS VARCHAR) AS model_params FROM s_newest, s_last_day""")
step("s_round_ets", f"""
  SELECT symbol, cutoff, target_date, target_name, 'ets' AS model_name, CAST(1 AS BIGINT) AS horizon_days, level AS predicted_value,
         {_alpha('alpha')} AS model_params FROM s_newest, s_last_day""")
step("s_round_ensemble", _ensemble("s_round_naive", "s_round_ets"))
ORACLE_SQL["forecast_round"] = sql(" UNION ALL ".join(
    f"SELECT {_FC} FROM {t}" for t in ("s_round_naive", "s_round_ets", "s_round_ensemble")))
_KNOWN = " AND ".join(
    f"{c} IS NOT NULL AND NOT isnan({c})"
    for c in ("ret", "ret_lag1", "ret_lag2", "ret_lag6", "price_vs_ma7", "price_vs_ma30", "vol_ma_7", "volume_ratio"))
step("s_complete", f"SELECT * FROM s_features WHERE {_KNOWN} AND volatility_pct IS NOT NULL")
step("s_training", " UNION ALL ".join(
    f"SELECT '{t}' AS target_name, count({c}) AS training_rows FROM s_complete, s_last_day WHERE trade_date < cutoff"
    for t, c in (("price", "target_price_ret"), ("volatility", "target_volatility"), ("volume", "target_volume_ret"))))
step("s_tree_rows", """
  SELECT symbol, trade_date, target_date, target_name, training_rows
  FROM s_complete, s_training, s_last_day WHERE trade_date = cutoff AND training_rows >= 300""")


def grow(p: str, due: str, before: str, rounds: int) -> None:
    """Steps ``{p}_made``: boosted trees on the rows of ``due``, by the rules of ``boosting``."""
    n = range(len(FEATURES))
    fields = [r(c, 6) if c != "dow" else "CAST(dow AS DOUBLE)" for c in FEATURES]
    labels = ["target_price_ret", "target_volatility", "target_volume_ret"]
    units = [f"CASE WHEN isnan({c}) THEN NULL ELSE CAST(round({r(c, 6)} * {UNIT}) AS BIGINT) END" for c in labels]
    step(f"{p}_rows", f"SELECT symbol, trade_date, first, of_, until, " + ", ".join(
        [f"{x} AS f{i}" for i, x in enumerate(fields)] + [f"{x} AS l{i}" for i, x in enumerate(units)]
        + [f"CAST({c} AS DOUBLE) AS t{i}" for i, c in enumerate(SERIES.values())]) + f" FROM {due}")
    step(f"{p}_range", "SELECT " + ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in n) + f" FROM {p}_rows WHERE {before}")
    step(f"{p}_cells", "SELECT t.*, " + ", ".join(
        f"CASE WHEN hi{i} > lo{i} THEN greatest(0, least({CELLS - 1}, CAST(floor((f{i} - lo{i}) / (hi{i} - lo{i}) * {CELLS}) AS INTEGER))) ELSE 0 END AS c{i}"
        for i in n) + f" FROM {p}_rows t, {p}_range")
    step(f"{p}_counts", " UNION ALL ".join(f"SELECT {i} AS feature, c{i} AS cell, count(*) AS n FROM {p}_cells WHERE {before} GROUP BY c{i}" for i in n))
    step(f"{p}_edges", f"""
      SELECT feature, cell, (sum(n) OVER (PARTITION BY feature ORDER BY cell) - n) * {BINS} // sum(n) OVER (PARTITION BY feature) AS bin FROM {p}_counts""")
    step(f"{p}_firsts", f"SELECT feature, bin, min(cell) AS cell FROM {p}_edges GROUP BY 1, 2")
    step(f"{p}_starts", f"SELECT feature, list(cell) AS cells FROM {p}_firsts GROUP BY 1")
    step(f"{p}_binned", f"SELECT t.*, [" + ", ".join(
        f"greatest(0, len(list_filter((SELECT cells FROM {p}_starts WHERE feature = {i}), lambda x: x <= c{i})) - 1)" for i in n) + f"] AS b FROM {p}_cells t")
    step(f"{p}_every", " UNION ALL ".join(f"""
      SELECT symbol, trade_date, w * 3 + {i} AS model, {i} AS target, b, l{i} AS label, t{i} AS today, coalesce(first = w, false) AS due
      FROM (SELECT *, unnest(range(of_, until + 1)) AS w FROM {p}_binned)""" for i in range(3)))
    step(f"{p}_known", f"SELECT *, NOT due AND label IS NOT NULL AS training FROM {p}_every WHERE due OR label IS NOT NULL")
    step(f"{p}_enough", f"SELECT model FROM {p}_known WHERE training GROUP BY 1 HAVING count(*) >= {TREE_MIN_ROWS}")
    step(f"{p}_q0", f"SELECT *, CAST(0 AS BIGINT) AS pred, label AS res, 1 AS node FROM {p}_known WHERE model IN (SELECT model FROM {p}_enough)")

    def score(total: str, rows: str) -> str:
        return f"CAST({total} AS DOUBLE) * CAST({total} AS DOUBLE) / CAST({rows} + {SHRINK} AS DOUBLE)"

    def leaf(total: str, rows: str) -> str:
        part = f"(({rows} + {SHRINK}) * {RATE})"
        return f"(({total}) - ((({total}) % {part}) + {part}) % {part}) // {part}"

    right = "CASE WHEN g.feature IS NOT NULL AND b[g.feature + 1] > g.bin THEN 1 ELSE 0 END"
    for k in range(rounds):
        at = f"{p}_q{k}"
        for level in range(DEPTH):
            name = f"{p}_x{k}{level}"
            step(f"{name}_sums", f"""
              SELECT model, node, feature, bin, CAST(sum(res) AS BIGINT) AS s, count(*) AS n
              FROM (SELECT model, node, res, unnest(range(0, {len(FEATURES)})) AS feature, unnest(b) AS bin FROM {at} WHERE training) GROUP BY ALL""")
            step(f"{name}_sides", f"""
              SELECT model, node, feature, bin, CAST(sum(s) OVER u AS BIGINT) AS ls, CAST(sum(n) OVER u AS BIGINT) AS ln,
                CAST(sum(s) OVER w AS BIGINT) AS s, CAST(sum(n) OVER w AS BIGINT) AS n FROM {name}_sums
              WINDOW u AS (PARTITION BY model, node, feature ORDER BY bin), w AS (PARTITION BY model, node, feature)""")
            step(f"{name}_gains", f"""
              SELECT *, CASE WHEN ln >= {MIN_LEAF} AND n - ln >= {MIN_LEAF} THEN greatest(0, {score('ls', 'ln')} + {score('(s - ls)', '(n - ln)')} - {score('s', 'n')})
                ELSE 0 END AS gain FROM {name}_sides""")
            step(f"{name}_split", f"""
              SELECT model, node, CASE WHEN gain > 0 THEN feature END AS feature, CASE WHEN gain > 0 THEN bin END AS bin,
                CASE WHEN gain > 0 THEN ls ELSE s END AS ls, CASE WHEN gain > 0 THEN ln ELSE n END AS ln,
                CASE WHEN gain > 0 THEN s - ls ELSE 0 END AS rs, CASE WHEN gain > 0 THEN n - ln ELSE 0 END AS rn
              FROM {name}_gains QUALIFY row_number() OVER (PARTITION BY model, node ORDER BY gain DESC, feature, bin) = 1""")
            if level < DEPTH - 1:
                step(f"{name}_down", f"SELECT t.* REPLACE (t.node * 2 + {right} AS node) FROM {at} t LEFT JOIN {name}_split g ON g.model = t.model AND g.node = t.node")
                at = f"{name}_down"
        step(f"{p}_moved{k}", f"""
          SELECT t.*, coalesce(CASE WHEN {right} = 1 THEN {leaf('rs', 'rn')} ELSE {leaf('ls', 'ln')} END, 0) AS more
          FROM {at} t LEFT JOIN {p}_x{k}{DEPTH - 1}_split g ON g.model = t.model AND g.node = t.node""")
        step(f"{p}_q{k + 1}", f"SELECT * EXCLUDE (more) REPLACE (pred + more AS pred, res - more AS res, 1 AS node) FROM {p}_moved{k}")
    raw = f"(CAST(pred AS DOUBLE) / {UNIT}.0)"
    step(f"{p}_made", f"""
      SELECT symbol, trade_date, ['price', 'volatility', 'volume'][target + 1] AS target_name,
        CASE WHEN target = 1 THEN {raw} ELSE today * (1 + {raw}) END AS predicted_value,
        CASE WHEN target = 1 THEN 'pred=' || {text(raw, 4)}
          ELSE 'ret=' || CASE WHEN {raw} < 0 THEN '-' ELSE '+' END || {text(f'abs({raw})', 4)} END AS model_params
      FROM {p}_q{rounds} WHERE due""")


step("s_today", """
  SELECT f.*, CASE WHEN trade_date = cutoff THEN 0 END AS first, 0 AS of_, 0 AS until FROM s_complete f, s_last_day""")
grow("s_t", "s_today", "first IS NULL", TREE_ROUNDS)
ORACLE_SQL["forecast_gbt"] = sql(f"""
SELECT symbol, CAST(trade_date AS VARCHAR) AS trade_date, target_name, training_rows, {r('predicted_value', 4)} AS predicted_value, model_params
FROM s_t_made JOIN s_training USING (target_name)""")
step("s_round_gbt", """
  SELECT symbol, trade_date AS cutoff, target_date, target_name, 'gbt' AS model_name, CAST(1 AS BIGINT) AS horizon_days, predicted_value, model_params
  FROM s_t_made, s_last_day""")
step("s_round_three", "SELECT * FROM s_round_naive UNION ALL SELECT * FROM s_round_ets UNION ALL SELECT * FROM s_round_gbt")
step("s_round_mean", """
  SELECT symbol, cutoff, target_date, target_name, 'ensemble' AS model_name, CAST(1 AS BIGINT) AS horizon_days,
         list_sum(list(predicted_value ORDER BY model_name)) / count(*) AS predicted_value,
         string_agg(model_name, '+' ORDER BY model_name) AS model_params
  FROM s_round_three GROUP BY ALL HAVING count(*) >= 2""")
ORACLE_SQL["forecast_round_trees"] = sql(f"SELECT {_FC} FROM s_round_three UNION ALL SELECT {_FC} FROM s_round_mean")
step("s_days", """
  SELECT trade_date, row_number() OVER (ORDER BY trade_date) - 1 AS step, lead(trade_date) OVER (ORDER BY trade_date) AS target_date
  FROM (SELECT DISTINCT trade_date FROM s_panel)""")
step("s_windows", f"""
  SELECT *, CASE WHEN step >= {BACKTEST_MIN_TRAIN} THEN (step - {BACKTEST_MIN_TRAIN}) // {REFIT_EVERY} END AS first,
    greatest(0, (step - {BACKTEST_MIN_TRAIN}) // {REFIT_EVERY}) AS of_, max((step - {BACKTEST_MIN_TRAIN}) // {REFIT_EVERY}) OVER () AS until
  FROM s_days WHERE target_date IS NOT NULL""")
step("s_walked", "SELECT f.*, first, of_, until FROM s_complete f JOIN s_windows USING (trade_date)")
grow("s_g", "s_walked", "first IS NULL", TREE_ROUNDS)
ORACLE_SQL["backtest_gbt"] = sql(f"""
SELECT symbol, CAST(trade_date AS VARCHAR) AS cutoff, CAST(target_date AS VARCHAR) AS target_date, target_name, 'gbt' AS model_name,
  CAST(1 AS BIGINT) AS horizon_days, {r('predicted_value', 4)} AS predicted_value, model_params
FROM s_g_made JOIN s_days USING (trade_date)""")
ORACLE_SQL["ensemble"] = sql(f"SELECT {_FC} FROM s_back_ensemble")
ORACLE_SQL["backtest_naive"] = sql(f"SELECT {_FC} FROM s_back_naive")
ORACLE_SQL["backtest_ets"] = sql(f"SELECT {_FC} FROM s_back_ets")
_HIGHER = r(f"predicted_value * CASE WHEN target_date >= DATE '{CUT}' THEN CAST(1.01 AS DOUBLE) ELSE 1 END", 8)
ORACLE_SQL["forecast_upsert"] = sql(f"""
SELECT symbol, CAST(target_date AS VARCHAR) AS target_date, target_name, model_name, horizon_days,
       {r(_HIGHER, 4)} AS predicted_value, model_params FROM s_back_naive""")
ORACLE_SQL["forecast_detail"] = sql("SELECT " + cols(
    ["target_date"], rounds(3, "predicted_value", "actual_value", "error", "abs_error", "abs_pct_error"),
    ["asset_key", "date_key", "asset_id", "symbol", "target_name", "model_name", "horizon_days", "model_params"])
    + " FROM s_detail")
ORACLE_SQL["forecast_accuracy"] = sql("SELECT " + cols(
    [], rounds(3, "mae", "rmse", "mape"), ["* EXCLUDE (mae, rmse, mape)"]) + " FROM s_accuracy")
ORACLE_SQL["leaderboard"] = sql(f"""
SELECT target_name, model_name, count(*) AS assets, CAST(sum(n_predictions) AS BIGINT) AS n_predictions,
       {mean('mape', 3, 4)} AS mean_mape, {mean('vs_naive_pct', 2, 2)} AS mean_vs_naive_pct
FROM s_accuracy GROUP BY 1, 2""")
step("s_lagged", "SELECT symbol, daily_return_pct AS x, " + ", ".join(
    f"lag(daily_return_pct, {k}) OVER (PARTITION BY symbol ORDER BY date) AS p{k}" for k in (1, 2, 5))
    + " FROM s_w_returns WHERE daily_return_pct IS NOT NULL")
ORACLE_SQL["autocorrelation"] = sql(" UNION ALL ".join(
    f"SELECT symbol, CAST({k} AS BIGINT) AS lag, {r(f'corr(x, p{k})', 4)} AS autocorrelation, "
    f"{r(f'corr(abs(x), abs(p{k}))', 4)} AS abs_autocorrelation, count(p{k}) AS observations FROM s_lagged GROUP BY 1"
    for k in (1, 2, 5)))


# checks
def check_sql(check: Check, table: dict[str, str]) -> str:
    t, c = table[check.model], check.column
    if check.kind == "not_null":
        n = f"SELECT count(*) FROM {t} WHERE {c} IS NULL"
    elif check.kind == "accepted_values":
        allowed = ", ".join(str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in check.arg)
        n = f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN ({allowed})"
    elif check.kind in ("unique", "unique_key"):
        keys = check.arg or (c,)
        known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        n = (f"SELECT count(*) FROM (SELECT 1 FROM {t} WHERE {known} GROUP BY {', '.join(keys)} "
             "HAVING count(*) > 1)")
    elif check.kind == "relationships":
        parent, field = check.arg
        n = (f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN "
             f"(SELECT {field} FROM {table[parent]} WHERE {field} IS NOT NULL)")
    else:
        n = (f"SELECT count(*) FROM (SELECT valid_from AS f, lag(coalesce(valid_to, DATE '9999-12-31')) OVER "
             f"(PARTITION BY {c} ORDER BY valid_from) AS e FROM {t}) WHERE e > f")
    return f"""SELECT '{check.kind}' AS "check", '{check.model}' AS model, '{c}' AS "column", ({n}) AS failures"""


MART_STEPS = {
    "dim_date": "s_f_dim_date", "dim_source": "s_dim_source", "dim_asset": "s_dim_asset",
    "fact_market_prices": "s_f_prices", "fact_price_trends": "s_f_trends", "fact_volume_analysis": "s_f_volumes",
    "fact_market_volatility": "s_f_volatility", "fact_market_alerts": "s_f_alerts",
    "fact_asset_correlation": "s_f_correlations", "fact_forecast_detail": "s_detail",
    "fact_forecast_accuracy": "s_accuracy",
}
ORACLE_SQL["dq_report"] = sql("\nUNION ALL ".join(check_sql(c, MART_STEPS) for c in mart_checks() + invariant_checks()))
ORACLE_SQL["dq_raw"] = "\nUNION ALL ".join(
    check_sql(c, {t: t for t in ("lineitem", "orders", "part", "customer")}) for c in RAW_CHECKS)


# reports
def _rollup(alerts: str, day: str) -> str:
    return f"""
  SELECT alert_type, symbol, count(*) AS alert_count FROM {alerts} WHERE date = {day} GROUP BY 1, 2"""


ORACLE_SQL["alert_rollup"] = sql(_rollup("s_c_alerts", "(SELECT max(date) FROM s_c_alerts)"))
step("s_pair_types", f"""
  SELECT pair_type, {mean('correlation_30d', 2, 4)} AS avg_correlation, count(*) AS pair_count
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol_a, symbol_b ORDER BY date_key DESC) AS rn
        FROM s_w_correlations WHERE correlation_30d IS NOT NULL) WHERE rn = 1 GROUP BY 1""")
ORACLE_SQL["pair_type_correlation"] = sql("SELECT * FROM s_pair_types")


def money(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'n/a' WHEN {x} >= 1 THEN '$' || format('{{:,.2f}}', {r(x, 2)}) "
            f"ELSE '$' || format('{{:,.4f}}', {r(x, 4)}) END")


def signed(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'n/a' ELSE CASE WHEN {x} < 0 THEN '-' ELSE '+' END || {text(f'abs({x})', 2)} || '%' END"


step("s_as_of", "SELECT max(date) AS d FROM s_w_returns")


def _lines(source: str) -> str:
    return f"""
  SELECT asset_type, symbol, '  ' || {SHOWN.format('symbol')} || ': ' || ({money('price')}) || ' (' ||
         ({signed('daily_return_pct')}) || ')' ||
         CASE WHEN date <> (SELECT d FROM s_as_of) THEN ' [as of ' || CAST(date AS VARCHAR) || ']' ELSE '' END AS line
  FROM {source}"""


step("s_price_lines", _lines("s_w_latest"))
ORACLE_SQL["format_snapshot"] = sql(_lines("s_w_returns"))
step("s_w_rollup", _rollup("s_w_alerts", "(SELECT d FROM s_as_of)"))
ORACLE_SQL["snapshot_lines"] = sql(f"""
SELECT CAST(0 AS BIGINT) AS section, '' AS item, 'Market data for ' || CAST(d AS VARCHAR) || ':' AS line FROM s_as_of
UNION ALL SELECT DISTINCT CASE asset_type WHEN 'Crypto' THEN 1 ELSE 2 END, '', upper(asset_type) || ':' FROM s_price_lines
UNION ALL SELECT CASE asset_type WHEN 'Crypto' THEN 1 ELSE 2 END, symbol, line FROM s_price_lines
UNION ALL SELECT 3, '', CASE WHEN count(*) = 0 THEN 'ACTIVE ALERTS: none'
                             ELSE 'ACTIVE ALERTS (' || CAST(sum(alert_count) AS BIGINT) || '):' END FROM s_w_rollup
UNION ALL SELECT 3, alert_type, '  ' || alert_type || ' x' || CAST(sum(alert_count) AS BIGINT) || ':' FROM s_w_rollup GROUP BY alert_type
UNION ALL SELECT 3, alert_type || ' ' || symbol, '    ' || {SHOWN.format('symbol')} FROM s_w_rollup
UNION ALL SELECT 4, '', '30-DAY RETURN CORRELATION (latest per pair, averaged):' WHERE (SELECT count(*) FROM s_pair_types) > 0
UNION ALL SELECT 4, pair_type, '  ' || pair_type || ': ' || {text('avg_correlation', 2)} || ' (' || pair_count ||
  CASE WHEN pair_count = 1 THEN ' pair)' ELSE ' pairs)' END FROM s_pair_types""")
ORACLE_SQL["daily_summary"] = sql(f"""
SELECT CAST(d AS VARCHAR) AS summary_date,
  'Market summary for ' || CAST(d AS VARCHAR) || '. Best performer: ' || {SHOWN.format('best_symbol')} || ' at ' ||
  ({signed('best_pct')}) || '. Weakest: ' || {SHOWN.format('worst_symbol')} || ' at ' || ({signed('worst_pct')}) || '. ' ||
  (SELECT CASE WHEN count(*) = 0 THEN 'No alerts active.'
               ELSE CAST(sum(alert_count) AS BIGINT) || ' alert(s) active (' || string_agg(DISTINCT alert_type, ', ' ORDER BY alert_type) || ').' END
   FROM s_w_rollup) ||
  coalesce((SELECT ' Average 30-day crypto correlation: ' || {text('avg_correlation', 2)} FROM s_pair_types WHERE pair_type = 'Crypto-Crypto') ||
           coalesce((SELECT ', crypto-to-stock: ' || {text('avg_correlation', 2)} FROM s_pair_types WHERE pair_type = 'Crypto-Stock'), '') || '.', '')
  AS summary_text
FROM s_w_best, s_as_of""")

# streaming
ORACLE_SQL["stream_candles"] = f"""
SELECT event_type AS symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       {r('first(value ORDER BY ts, value)', 4)} AS open_price, {r('max(value)', 4)} AS high_price,
       {r('min(value)', 4)} AS low_price, {r('last(value ORDER BY ts, value)', 4)} AS close_price,
       CAST(count(*) AS DOUBLE) AS volume, {r('sum(value)', 4)} AS quote_volume, count(*) AS number_of_trades
FROM events GROUP BY event_type, CAST(ts AS DATE)"""
ORACLE_SQL["stream_alert_dedupe"] = f"""
SELECT event_type AS asset_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS alert_date, 'price_spike' AS alert_type,
       'Price at ' || {text('first(value ORDER BY ts)', 2)} AS alert_message
FROM events WHERE value > {TICK_ALERT} GROUP BY event_type, CAST(ts AS DATE)"""
