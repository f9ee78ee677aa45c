"""Fixed values the pipeline must agree on.

FIXED VALUES — these are behavioural constants of the market/orders pipeline
(allowed vocabularies, cut-offs, limits). They are stated here once, in natural
order, and every module imports them from here.
"""

from __future__ import annotations

# --- FIXED VALUES: market feed vocabulary --------------------------------------------
ALLOWED_SOURCES = ("nasdaq", "coinbase")
ALLOWED_ASSET_TYPES = ("stock", "crypto")
CRYPTO_PRODUCTS = {"BTC-USD": "BTCUSD", "ETH-USD": "ETHUSD", "SOL-USD": "SOLUSD"}

# --- FIXED VALUES: market gold layer -------------------------------------------------
TOP_K = 5                      # rows kept per asset type in the top-transaction tables
VALUE_TOLERANCE = 0.0001       # |transaction_value - price * volume| allowed by QA
DEDUP_KEYS = ("batch_id", "symbol", "event_time")

# --- FIXED VALUES: vendor request window ---------------------------------------------
LOOKBACK_DAYS = 45
BARS_PER_SYMBOL = 5
VENDOR_OK_CODE = 200

# --- FIXED VALUES: orders ------------------------------------------------------------
COMPLETE_STATUS = "complete"
HIGH_AMOUNT_THRESHOLD = 50
HIGH_BUCKET = "high"
STANDARD_BUCKET = "standard"

# --- FIXED VALUES: dashboard export caps ---------------------------------------------
DASH_BRONZE_LIMIT = 10
DASH_SUMMARY_LIMIT = 10
DASH_TOP_LIMIT = 5

# --- FIXED VALUES: table-name suffix -------------------------------------------------
NAME_SANITISE_PATTERN = "[^a-z0-9_]"
PRINCIPAL_KEY_LEN = 32
PRINCIPAL_HASH_LEN = 8

MARKET_TABLE_PREFIXES = (
    "bronze_market_events",
    "silver_market_ticks",
    "gold_market_summary",
    "gold_top_stock_transactions",
    "gold_top_crypto_transactions",
)
ORDER_TABLE_PREFIXES = ("proof_bronze_orders", "proof_silver_orders")

# --- FIXED VALUES: compact number suffixes (en-US compact notation) -------------------
COMPACT_STEPS = ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K"))
