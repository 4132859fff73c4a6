"""Latest prices, the ordered board and the display cards."""

from __future__ import annotations


from candlewick.functions import normalize as N
from candlewick.functions import present as P
from candlewick.operators.latest import configured_symbols, current_prices, latest_price, max_configured
from candlewick.plans import sql as S
from candlewick.plans.common import finish, register
from candlewick.plans.q_candles import T_CTE, _ALERTS_1H, alerts_1h
from candlewick.plans.q_messages import MSG_CTE, consumed

# A configuration value as a user would type it: blanks, case and a repeat.
BOARD_PAIRS = " view, CLICK ,,purchase ,nosuch,view "
BOARD_SQL = "(VALUES (0, 'view'), (1, 'click'), (2, 'purchase'), (3, 'nosuch')) cfg(pos, symbol)"

LATEST_SQL = MSG_CTE + """, latest AS (
  SELECT symbol, arg_max(price, offs) AS price, arg_max(bts, offs) AS binance_timestamp,
         arg_max(rts, offs) AS received_timestamp
  FROM m WHERE error_type IS NULL GROUP BY symbol)"""


def valid_prices(spark, sf_dir):
    return N.good(consumed(spark, sf_dir))


def latest(spark, sf_dir, by="offset"):
    return latest_price(valid_prices(spark, sf_dir), by=by)


@register("latest_price", LATEST_SQL + f"""
  SELECT symbol, price, binance_timestamp, received_timestamp FROM latest""")
def q_latest_price(spark, sf_dir):
    return finish(latest(spark, sf_dir))


@register("latest_by_event_time", MSG_CTE + f"""
  SELECT symbol, arg_max(price, bts) AS price, max(bts) AS binance_timestamp,
         arg_max(rts, bts) AS received_timestamp
  FROM m WHERE error_type IS NULL GROUP BY symbol""")
def q_latest_by_event_time(spark, sf_dir):
    return finish(latest(spark, sf_dir, by="binance_timestamp"))


def board(spark, sf_dir):
    return current_prices(latest(spark, sf_dir), configured_symbols(spark, BOARD_PAIRS),
                          max_configured(BOARD_PAIRS))


@register("current_prices_ordered", LATEST_SQL + f"""
  SELECT cfg.pos, l.symbol, l.price, l.binance_timestamp, l.received_timestamp
  FROM {BOARD_SQL} JOIN latest l USING (symbol) ORDER BY cfg.pos""")
def q_current_prices(spark, sf_dir):
    return finish(board(spark, sf_dir))


def _money_sql(x: str) -> str:
    return f"('$' || format('{{:,}}', {x}))"


def _signed2_sql(x: str) -> str:
    return f"printf('%+.2f', {x})"


@register("price_cards", LATEST_SQL + f"""
  SELECT cfg.pos, upper(l.symbol) AS label, {_money_sql('l.price')} AS price_text,
         'Last trade time (UTC): ' || strftime(make_timestamp(l.binance_timestamp), '%Y-%m-%d %H:%M:%S.%g')
           AS caption
  FROM {BOARD_SQL} JOIN latest l USING (symbol)""")
def q_price_cards(spark, sf_dir):
    return P.present_prices(board(spark, sf_dir))


@register("alert_cards", T_CTE + f"""
  SELECT upper(symbol) AS symbol, alert_type,
         CASE WHEN alert_type = 'BUY' THEN 'green' WHEN alert_type = 'SELL' THEN 'red' ELSE 'gray' END
           AS colour,
         {_signed2_sql('percent_change * 100')} || '%' AS change_text,
         {_money_sql('open_price')} || ' -> ' || {_money_sql('close_price')} AS price_text,
         window_start, window_end
  FROM ({_ALERTS_1H})""")
def q_alert_cards(spark, sf_dir):
    return P.present_alerts(alerts_1h(spark, sf_dir))
