"""Defaults of the modelled system.

Fixed values: these must equal the modelled system's defaults for the
results to agree. They are kept together, in natural order, as plain text.
"""

# --- fixed values -----------------------------------------------------------
ALERT_THRESHOLD = 0.0025          # |change| must be strictly greater
CANDLE_WINDOW = "1 minute"
WATERMARK_DELAY = "1 second"
MAX_ALERTS_STORED = 200           # bounded alert log
MAX_ALERTS_SHOWN = 20             # newest-first view
DEFAULT_PAIRS = "btcusdt,ethusdt"
TOPIC_PARTITIONS = 3
RETENTION_MINUTES = 15
UNKNOWN_SYMBOL = "unknown"
MICROS_DIGITS = 16                # a trade time must have 16 digits (µs)

# Histogram bucket upper bounds (seconds), one tuple per instrumented metric.
BOUNDS_PRODUCER_LATENCY = (0.00005, 0.0001, 0.00025, 0.0005, 0.001, 0.0025, 0.005,
                           0.01, 0.025, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0)
BOUNDS_NETWORK_LATENCY = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)
BOUNDS_E2E_LATENCY = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0,
                      10.0, 30.0, 60.0)
BOUNDS_SYSTEM_LATENCY = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
BOUNDS_PRICE_PROCESSING = (0.0001, 0.0005, 0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1,
                           0.5, 1.0, 5.0)
BOUNDS_ALERT_PROCESSING = (0.0001, 0.0005, 0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1,
                           0.5, 1.0, 5.0, 10.0)
BOUNDS_BATCH_DURATION = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, 120.0)

# Error-rate status steps (errors/s): green from 0, yellow from 0.01, red from 0.1.
ERROR_STATUS_STEPS = ((0.0, "green"), (0.01, "yellow"), (0.1, "red"))

# Metric evaluation: 5 s scrape and step, 1 minute range, 5 minute gauge lookback.
SCRAPE_SECONDS = 5
RANGE_SECONDS = 60
LOOKBACK_SECONDS = 300
# --- end of fixed values ----------------------------------------------------

# Sampling used over the driver tables: the 5 s : 60 s ratio kept at one hour :
# twelve hours (see FIXTURES.md, part 2). The grid itself follows from the data.
FIXTURE_STEP = 3600
FIXTURE_RANGE = 43200
FIXTURE_LOOKBACK = 216000         # 300 s scaled by 3600/5
