"""Names, labels and limits that results are compared on."""

# Source ids as they appear in the unified feed, and their display names.
SPOT_SOURCE = "coingecko"
CANDLE_SOURCE = "binance"
STOCK_SOURCE = "alpha_vantage"
MERGED_SOURCE = "unified"
SOURCE_NAMES = {
    SPOT_SOURCE: "CoinGecko",
    CANDLE_SOURCE: "Binance",
    STOCK_SOURCE: "Alpha Vantage",
}

# Asset types.
CRYPTO = "Crypto"
STOCK = "Stock"

# Exchange ticker -> asset id.
TICKERS = [
    ("BTCUSDT", "bitcoin"),
    ("ETHUSDT", "ethereum"),
    ("SOLUSDT", "solana"),
    ("BNBUSDT", "binancecoin"),
    ("ADAUSDT", "cardano"),
]

# First date used when an incremental target is still empty.
EPOCH_SENTINEL = "1900-01-01"

# Incremental look-back, in days.
METRICS_LOOKBACK = 3
FACTS_LOOKBACK = 7

# Backfill window, in days.
MIN_BACKFILL_DAYS = 1
MAX_BACKFILL_DAYS = 30

# Price change that raises a price_drop alert.
DROP_THRESHOLD = -0.10

# Forecasting.
HORIZON_DAYS = 1
MIN_HISTORY_ROWS = 30
BACKTEST_MIN_TRAIN = 150
TREE_MIN_ROWS = 300
ALPHA_STEPS = 20

# Check lists.
ALERT_TYPES = ["price_drop", "volume_spike", "high_volatility"]
RISK_LEVELS = ["low", "medium", "high"]
PAIR_TYPES = ["Crypto-Crypto", "Crypto-Stock", "Stock-Stock"]
STRENGTHS = ["strong positive", "moderate positive", "weak / none", "moderate negative", "strong negative"]
TARGET_NAMES = ["price", "volatility", "volume"]
MODEL_NAMES = ["naive", "ets", "gbt", "ensemble"]
