"""Candles and alerts."""

from __future__ import annotations


from candlewick.config import ALERT_THRESHOLD, MAX_ALERTS_SHOWN, MAX_ALERTS_STORED
from candlewick.operators import alerts as A
from candlewick.operators.candles import candles
from candlewick.plans import sql as S
from candlewick.plans.common import finish, register, ticks
from candlewick.sources.tables import load
from candlewick.sources.ticks import ticks_from_orders

T_CTE = f"WITH t AS ({S.TICKS})"


def _candles(spark, sf_dir, window):
    return candles(ticks(spark, sf_dir), window)


for _name, _win, _us in (("candles_1m", "1 minute", S.MINUTE_US),
                         ("candles_1h", "1 hour", S.HOUR_US),
                         ("candles_1d", "1 day", S.DAY_US)):
    def _q(spark, sf_dir, _win=_win):
        return finish(_candles(spark, sf_dir, _win))
    register(_name, T_CTE + (S.with_change(S.candles_sql(_us))))(_q)


ORDERS_CTE = """WITH o AS (
  SELECT o_orderpriority AS symbol, o_totalprice AS price, epoch_us(o_orderdate) AS bts,
         (epoch_us(o_orderdate) // 86400000000) * 1000000000000 + o_orderkey AS tick_order
  FROM orders)"""


@register("candles_orders_1w", ORDERS_CTE + (S.with_change(
    S.candles_sql(7 * S.DAY_US, source="o", order="tick_order"))))
def candles_orders_1w(spark, sf_dir):
    """Day-grained tape with many equal times: ties broken by order key."""
    tape = ticks_from_orders(load(spark, sf_dir, "orders"))
    return finish(candles(tape, "7 days", order_col="tick_order"))


def alerts_1h(spark, sf_dir, threshold=ALERT_THRESHOLD):
    return A.alerts(_candles(spark, sf_dir, "1 hour"), threshold)


_ALERTS_1H = S.alerts_sql(S.candles_sql(S.HOUR_US), ALERT_THRESHOLD)
_ALERTS_1H_50 = S.alerts_sql(S.candles_sql(S.HOUR_US), 0.5)

register("alerts_1h", T_CTE + (_ALERTS_1H))(
    lambda spark, sf_dir: finish(alerts_1h(spark, sf_dir)))
register("alerts_1h_threshold_50pct", T_CTE + (_ALERTS_1H_50))(
    lambda spark, sf_dir: finish(alerts_1h(spark, sf_dir, 0.5)))


@register("alert_counts", T_CTE + f"""
  SELECT alert_type, symbol, count(*) AS alerts FROM ({_ALERTS_1H}) GROUP BY 1, 2""")
def alert_counts(spark, sf_dir):
    return A.alert_counts(alerts_1h(spark, sf_dir))


@register("alert_buy_sell", T_CTE + f"""
  SELECT symbol, count(*) FILTER (WHERE alert_type = 'BUY') AS buy_alerts,
         count(*) FILTER (WHERE alert_type = 'SELL') AS sell_alerts, count(*) AS all_alerts
  FROM ({_ALERTS_1H}) GROUP BY 1""")
def alert_buy_sell(spark, sf_dir):
    return A.buy_sell_counts(alerts_1h(spark, sf_dir))


@register("recent_alerts_20", T_CTE + (
    f"SELECT * FROM ({_ALERTS_1H}) ORDER BY window_end DESC, symbol LIMIT {MAX_ALERTS_SHOWN}"))
def recent_alerts_20(spark, sf_dir):
    return finish(A.newest_alerts(alerts_1h(spark, sf_dir), MAX_ALERTS_SHOWN))


@register("alert_log_200", T_CTE + (
    f"SELECT * FROM ({_ALERTS_1H}) ORDER BY window_end DESC, symbol LIMIT {MAX_ALERTS_STORED}"))
def alert_log_200(spark, sf_dir):
    return finish(A.alert_log(alerts_1h(spark, sf_dir), MAX_ALERTS_STORED))
