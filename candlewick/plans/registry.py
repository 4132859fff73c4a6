"""Import every query module so its ``register`` calls run."""

from candlewick.plans import (q_candles, q_export, q_latency, q_messages, q_prices, q_series,  # noqa: F401
                              q_streams)
from candlewick.plans.common import ORACLES, QUERIES


def entry_query(spark, sf_dir):
    """Flagship: 1-hour alerts over the tick tape."""
    return QUERIES["alerts_1h"](spark, sf_dir)
