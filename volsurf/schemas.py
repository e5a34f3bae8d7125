"""Schemas (as DDL), enumerations and constants of the option datasets."""

from __future__ import annotations

RAW_OPTION_DAY = "ticker string, volume long, open double, close double, high double, low double, window_start long, transactions long"
STOCK_HISTORY = "symbol string, trade_date date, close double, dividend_yield double"
RATES = "rate_date date, rate double"
SNAPSHOTS = "snapshot_date date, symbol string"
WINDOWS = "symbol string, start_date date, end_date date"
ISSUES = "severity string, area string, item string, message string"
LEDGER = "trade_date date, symbols string, status string, note string, option_rows long, feature_path string"
MISMATCH = "symbol string, trade_date date, clean_close double, raw_close double, ratio double, split_factor double"
MANIFEST = "dataset string, trade_date date, schema_version int, source_version long, min_dte int, max_dte int, rows long"

# These decide results and must be as they are.
OPTION_SYMBOL = r"^O:([A-Z]{1,6})(\d{6})([CP])(\d{8})$"
SUPPORTED_UNDERLYING = r"^[A-Z]{1,5}$"
UNDERLYING = "[A-Z]{1,5}"
#: An option symbol whose underlying is supported.
SUPPORTED_OPTION = rf"^O:{UNDERLYING}\d{{6}}[CP]\d{{8}}$"
MIN_DTE, MAX_DTE = 30, 90
YEAR_DAYS = 365.25
MIN_CLOSE = 5.0
MIN_STEPS, MAX_STEPS, STEPS_PER_DAY = 101, 1001, 4
IV_LOW, IV_HIGH, IV_TOLERANCE, IV_ROUNDS = 0.001, 5.0, 1e-6, 200
ARBITRAGE_TOLERANCE = 1e-6
ZERO_YIELD = 1e-12
DIVIDE_EPSILON = 1e-12
RATE_LOOKBACK_DAYS = 14
SPLIT_FACTORS = (2.0, 3.0, 4.0, 5.0, 10.0, 20.0)
SPLIT_TOLERANCE = 0.08
TERMINAL_STATUSES = ("repaired", "missing_input", "missing_risk_free_rate", "no_repaired_rows")
DTE_BUCKETS = {"30d": (30, 45), "60d": (46, 70), "90d": (71, 90)}
#: name: (option type, target delta, tolerance)
DELTA_TARGETS = {
    "put_10_delta": ("put", -0.10, 0.05),
    "put_25_delta": ("put", -0.25, 0.075),
    "atm_call": ("call", 0.50, 0.10),
    "atm_put": ("put", -0.50, 0.10),
    "call_25_delta": ("call", 0.25, 0.075),
    "call_10_delta": ("call", 0.10, 0.05),
}
NEAR_ATM = (0.97, 1.03)
RIC_ALIASES = {"BFB": ("BFb.N", "BFb"), "BRKB": ("BRKb.N", "BRKb")}

GREEKS = ("delta", "gamma", "theta", "vega")
ATM_GREEKS = tuple(f"atm_{g}" for g in GREEKS)
ATM_CONTRACT_COLUMNS = (
    "ticker volume open close high low window_start transactions trade_date underlying expiration_date option_type strike dte_days "
    "time_to_expiry_years underlying_close dividend_yield risk_free_rate implied_volatility iv_failure_reason"
).split() + list(ATM_GREEKS)
DAILY_FEATURES = [f"avg_{side}_{m}" for m in ("iv", *GREEKS) for side in ("call", "put")]
