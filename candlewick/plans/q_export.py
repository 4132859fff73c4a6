"""Exports, topics and files over the tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from candlewick.config import FIXTURE_LOOKBACK, FIXTURE_RANGE, FIXTURE_STEP
from candlewick.functions import latency as L
from candlewick.functions import normalize as N
from candlewick.operators import export as X
from candlewick.operators.alerts import ALERT_COLUMNS
from candlewick.operators.metrics import evaluate
from candlewick.plans import q_series as QS
from candlewick.plans import sql as S
from candlewick.plans import sql_series as Q
from candlewick.plans.catalog import CATALOG
from candlewick.plans.common import finish, register, ticks
from candlewick.plans.q_candles import _ALERTS_1H, T_CTE, alerts_1h
from candlewick.plans.q_latency import LAT_CTE
from candlewick.plans.q_prices import valid_prices
from candlewick.session import checkpoint_root
from candlewick.sources.catalog import load_specs, spot_symbol_list
from candlewick.sources.tables import load
from candlewick.sources.ticks import epoch_micros, price_records
from candlewick.streaming.jobs import decode_alert_records, write_alerts, write_ticks


def _folder(spark, what):
    return f"{checkpoint_root(spark)}/export-{what}-{uuid.uuid4().hex[:12]}"


def _iso(spark, epoch):
    import datetime as dt
    return (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=epoch)).isoformat()


def exported(spark, sf_dir):
    """One export run over the whole grid of a table folder; returns its folder."""
    path, grid = _folder(spark, "run"), QS.grid_of(spark, sf_dir)
    c, g = QS.stored(spark, sf_dir)
    X.run_export(spark, c, g, _iso(spark, grid.start), _iso(spark, grid.end), FIXTURE_STEP, "replay", path,
                 CATALOG, FIXTURE_RANGE, FIXTURE_LOOKBACK)
    return path


_WIDE = ", ".join(f'{S.r6(chr(34) + n + chr(34))} AS "{n}"' for n in QS._WITH_DATA)


@register("export_csv", QS.CATALOG_SQL + f""",
  longv AS (SELECT metric, {QS._t()} AS "timestamp", value FROM catalog WHERE metric IN ({QS._CAT_NAMES})),
  wide AS (SELECT * FROM (PIVOT longv ON metric IN ({QS._CAT_WITH_DATA}) USING first(value) GROUP BY "timestamp"))
  SELECT "timestamp", {_WIDE} FROM wide""")
def export_csv(spark, sf_dir):
    """The CSV of an export run, read back."""
    back = X.read_metrics_csv(spark, f"{exported(spark, sf_dir)}/metrics", QS._WITH_DATA)
    return finish(back, tuple(QS._WITH_DATA))


@register("export_extended", f"""{QS.CATALOG_SQL},
  longv AS (SELECT metric, {QS._t()} AS "timestamp", value FROM catalog WHERE metric IN ({QS._CAT_NAMES})),
  wide AS (SELECT * FROM (PIVOT longv ON metric IN ({QS._CAT_WITH_DATA}) USING first(value) GROUP BY "timestamp"))
  SELECT "timestamp", {_WIDE} FROM wide""")
def export_extended(spark, sf_dir):
    """An export that grew in two runs, the second one repeated (A11-A13): the same
    rows as one long run."""
    path, grid = _folder(spark, "grown"), QS.grid_of(spark, sf_dir)
    c, g = QS.stored(spark, sf_dir)
    middle = grid.origin + (grid.first + grid.last) // 2 * grid.step
    for upto in (middle, grid.end, grid.end):
        X.extend_export(spark, c, g, _iso(spark, grid.start), _iso(spark, upto), FIXTURE_STEP, path, CATALOG,
                        FIXTURE_RANGE, FIXTURE_LOOKBACK)
    return finish(X.read_export(spark, path), tuple(QS._WITH_DATA))


# fixture: alert records whose key is missing, or whose value is no object
_NO_KEY, _NO_OBJECT = 53, 47


@register("alert_rejects", T_CTE + f"""
  SELECT coalesce(error_type, 'good') AS outcome, count(*) AS alerts FROM (
    SELECT CASE WHEN epoch_us(window_end) // 3600000000 % {_NO_KEY} = 0
                  OR epoch_us(window_end) // 3600000000 % {_NO_OBJECT} = 0 THEN 'invalid_message' END AS error_type
    FROM ({_ALERTS_1H})) GROUP BY 1""")
def alert_rejects(spark, sf_dir):
    """The alerts consumer's check of its records."""
    a = alerts_1h(spark, sf_dir)
    hour = F.floor(epoch_micros("window_end") / F.lit(3600_000_000))
    recs = a.select(
        F.when(hour % _NO_KEY != 0, F.col("symbol")).cast("binary").alias("key"),
        F.when(hour % _NO_OBJECT != 0, F.to_json(F.struct(*ALERT_COLUMNS))).otherwise(F.lit("[1]"))
        .cast("binary").alias("value"))
    return N.classify_alert_records(recs).groupBy(F.coalesce("error_type", F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("alerts"))


@register("export_run", f"""WITH {Q.GRID_CTE}
  SELECT 'replay' AS experiment_name, CAST((k - 1) * {FIXTURE_STEP} AS DOUBLE) AS duration_seconds,
         '{FIXTURE_STEP}s' AS step, CAST({len(CATALOG)} AS INTEGER) AS metrics, {len(QS._WITH_DATA)} AS columns,
         CAST(k AS BIGINT) AS num_timestamps FROM s_g""")
def export_run(spark, sf_dir):
    """The metadata of an export run, read back."""
    meta = spark.read.json(f"{exported(spark, sf_dir)}/metadata")
    return meta.select("experiment_name", "duration_seconds", "step", F.size("metrics_exported").alias("metrics"),
                       F.size("columns").alias("columns"), "num_timestamps")


@register("alert_topic", T_CTE + _ALERTS_1H)
def alert_topic(spark, sf_dir):
    """Alerts as records of the alerts topic, written, read and decoded."""
    path = _folder(spark, "alerts")
    write_alerts(alerts_1h(spark, sf_dir), path=path)
    records = spark.read.parquet(path).select(*[F.col(c).cast("binary").alias(c) for c in ("key", "value")])
    a = decode_alert_records(records)
    return finish(a.select("symbol", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")],
                           "open_price", "close_price", "percent_change", "alert_type"))


@register("price_topic", T_CTE + """
  SELECT symbol, price, bts AS binance_timestamp, rts AS received_timestamp FROM t""")
def price_topic(spark, sf_dir):
    """Ticks as records of the prices topic, written, read and decoded."""
    path = _folder(spark, "prices")
    write_ticks(price_records(ticks(spark, sf_dir)), path=path)
    d = N.decode_price_records(spark.read.parquet(path))
    return finish(d.select("symbol", "price", "binance_timestamp", "received_timestamp"))


@register("spot_symbols", """
  SELECT string_agg(lower(symbol), ',' ORDER BY symbol) AS symbols FROM (
    SELECT event_type AS symbol FROM events GROUP BY event_type HAVING max(event_id) % 2 = 0)""")
def q_spot_symbols(spark, sf_dir):
    """Exchange metadata of the symbols in the tape, as a file, and its spot list."""
    path = _folder(spark, "symbols")
    s = load(spark, sf_dir, "events").groupBy("event_type").agg((F.max("event_id") % 2 == 0).alias("spot")) \
        .select(F.struct(F.upper("event_type").alias("symbol"), F.col("spot").alias("isSpotTradingAllowed")).alias("s"))
    s.agg(F.array_sort(F.collect_list("s")).alias("symbols")).coalesce(1).write.json(path)
    return spot_symbol_list(spark, path)


@register("step_latency", LAT_CTE + """
  SELECT symbol, min(system_seconds) AS shortest, max(system_seconds) AS longest, count(*) AS steps
  FROM lat GROUP BY symbol""")
def q_step_latency(spark, sf_dir):
    """The step from receipt to storage, per symbol."""
    step = F.when(F.coalesce("received_timestamp", F.lit(0)) != 0,
                  L.step_latency("stored_timestamp", "received_timestamp"))
    return valid_prices(spark, sf_dir).groupBy("symbol").agg(
        F.min(step).alias("shortest"), F.max(step).alias("longest"), F.count(F.lit(1)).alias("steps"))


_USER = [
    {"component": "user", "metric": "view_rate", "kind": "rate_sum", "family": "producer_messages_received_total",
     "matchers": [{"label": "symbol", "op": "=", "value": "view"}], "unit": "msg/s"},
    {"component": "user", "metric": "rate_by_symbol", "kind": "rate_sum", "by": "symbol",
     "family": "producer_messages_received_total",
     "matchers": [{"label": "symbol", "op": "!=", "value": v} for v in ("view", "click", "a", "b")]},
]


@register("catalog_file", QS.RATES + f"""
  SELECT 'user_view_rate' AS metric, '' AS by_value, {QS._t()} AS t, {S.r6('sum(value)')} AS value
  FROM rates WHERE family = 'ticks_total' AND symbol = 'view' GROUP BY t
  UNION ALL SELECT 'user_rate_by_symbol', symbol, {QS._t()}, {S.r6('sum(value)')}
  FROM rates WHERE family = 'ticks_total' AND symbol NOT IN ('view', 'click') GROUP BY symbol, t""")
def catalog_file(spark, sf_dir):
    """Metrics that a user defines in a file, evaluated like the built-in ones."""
    path = _folder(spark, "catalog")
    spark.createDataFrame([(json.dumps(_USER),)], "value string").coalesce(1).write.text(path)
    c, g = QS.stored(spark, sf_dir)
    m = evaluate(spark, c, g, QS.grid_of(spark, sf_dir), FIXTURE_RANGE, FIXTURE_LOOKBACK,
                 specs=load_specs(spark, path))
    return finish(m.select("metric", "by_value", QS.ts_col(), "value"), ("value",))
