"""Table schemas, as Spark DDL strings."""

SPOT = (
    "coin_id string, date date, price double, market_cap double, "
    "total_volume double, updated_at timestamp"
)

CANDLES = (
    "symbol string, date date, open_price double, high_price double, low_price double, "
    "close_price double, volume double, close_time bigint, quote_volume double, "
    "number_of_trades bigint, taker_buy_base_vol double, taker_buy_quote_vol double, "
    "updated_at timestamp"
)

STOCKS = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, updated_at timestamp"
)

CONNECTIONS = "id int, source_name string, is_active boolean"
ASSET_MAPPING = "id int, connection_id int, source_symbol string, display_name string, is_active boolean"
COLUMN_MAPPING = (
    "id int, connection_id int, source_field string, target_column string, "
    "data_type string, is_active boolean"
)
TABLE_MAPPING = (
    "id int, connection_id int, destination_schema string, destination_table string, "
    "pk_columns array<string>"
)
LOAD_ERRORS = (
    "run_id string, connection_id int, source_symbol string, error_message string, "
    "occurred_at timestamp"
)
QUARANTINE = (
    "run_id string, source string, symbol string, date date, payload bigint, record bigint, bad_fields string"
)
FAILED_SYMBOLS = "run_id string, source string, symbol string"
CONTROL = (
    "pipeline_name string, last_load_timestamp timestamp, is_first_load boolean, "
    "last_run_status string, updated_at timestamp"
)
BUILD_MARKS = "table_name string, updated_at timestamp"
RUN_LOG = (
    "run_id string, source string, status string, records_inserted bigint, "
    "duration_seconds double, error_message string, run_timestamp timestamp"
)

DIM_ASSET = (
    "asset_key bigint, asset_id string, symbol string, asset_type string, "
    "valid_from timestamp, valid_to timestamp, is_current boolean"
)

FORECASTS = (
    "symbol string, target_date date, target_name string, model_name string, "
    "horizon_days int, predicted_value double, model_params string"
)
ALERT_LOG = "asset_id string, alert_date date, alert_type string, alert_message string"
SUMMARIES = "summary_date date, period_type string, summary_text string, generated_by string"
# As stored by a run: with the time it was made or sent.
STORED_FORECASTS = f"{FORECASTS}, generated_at timestamp"
STORED_ALERTS = f"{ALERT_LOG}, sent_at timestamp"
STORED_SUMMARIES = f"{SUMMARIES}, created_at timestamp"

TREND_FACT = "asset_key bigint, date_key int, moving_avg_7d double, moving_avg_14d double, moving_avg_30d double"
PRICE_FACT = (
    "asset_key bigint, date_key int, source_key int, price double, total_volume double, "
    "open_price double, high_price double, low_price double"
)
CORRELATION_FACT = (
    "asset_key_a bigint, asset_key_b bigint, date_key int, symbol_a string, symbol_b string, pair_type string, "
    "correlation_30d double, correlation_90d double, correlation_strength_30d string, "
    "observations_30d bigint, observations_90d bigint"
)
