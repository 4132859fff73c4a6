"""Metric samples and their evaluation (A11 B26 C1 C3 C5-C9 D6-D10 D12 D17 D18
E2-E4 B30 K L C2 F3 G1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.config import ALERT_THRESHOLD, FIXTURE_LOOKBACK, FIXTURE_RANGE, FIXTURE_STEP
from candlewick.functions.present import status_of
from candlewick.operators import series as SE
from candlewick.operators.histogram import series_summary
from candlewick.operators.metrics import evaluate, panel_series, spec_plan
from candlewick.plans import sql as S
from candlewick.plans import sql_series as Q
from candlewick.plans.catalog import CATALOG, PANELS
from candlewick.plans.common import finish, register
from candlewick.plans.q_candles import _ALERTS_1H, alerts_1h
from candlewick.plans.planted import source_samples
from candlewick.sources.samples import scrape_grid
from candlewick.sources.tables import load

HEAD = f"WITH t AS ({S.TICKS}), " + Q.samples_ctes(_ALERTS_1H)
RATES = HEAD + "," + Q.rate_ctes()


def ts_col(c="t"):
    return F.timestamp_seconds(F.col(c)).cast("timestamp_ntz").alias(c)


def grid_of(spark, sf_dir):
    """The scrape grid of a table folder: it covers all of its events."""
    return scrape_grid(load(spark, sf_dir, "events"))


def samples(spark, sf_dir):
    """Samples derived afresh from the events."""
    return source_samples(load(spark, sf_dir, "events"), alerts_1h(spark, sf_dir)).drop("kind")


def stored(spark, sf_dir):
    """(counters, gauges) from the sample store of this input snapshot."""
    from candlewick.sources.samples import split
    from candlewick.sources.store import materialised

    def build():
        return {"samples": samples(spark, sf_dir)}
    parts = materialised(spark, "samples", [f"{sf_dir.rstrip('/')}/events.parquet"], build,
                         extra=f"{ALERT_THRESHOLD}|{FIXTURE_STEP}")
    return split(parts["samples"])


def stored_samples(spark, sf_dir):
    c, g = stored(spark, sf_dir)
    return c.unionByName(g)


def rates_of(spark, sf_dir, family, parts=None):
    """Rates of one family (optionally some parts); filters apply to the scan."""
    s = stored(spark, sf_dir)[0].where(F.col("family") == family)
    if parts is not None:
        s = s.where(F.col("part").isin(*parts))
    return SE.range_rate(s, FIXTURE_RANGE, grid_of(spark, sf_dir))


def _t(expr="t"):
    return f"make_timestamp(CAST({expr} AS BIGINT) * 1000000)"


@register("rate_by_series", RATES + f"""
  SELECT symbol, {_t()} AS t, {S.r6('value')} AS rate FROM rates WHERE family = 'ticks_total'""")
def rate_by_series(spark, sf_dir):
    r = rates_of(spark, sf_dir, "ticks_total")
    return finish(r.select(F.col("labels")["symbol"].alias("symbol"), ts_col(), F.col("value").alias("rate")), ("rate",))


@register("rate_total", RATES + f"""
  SELECT {_t()} AS t, {S.r6('sum(value)')} AS rate FROM rates WHERE family = 'ticks_total' GROUP BY t""")
def rate_total(spark, sf_dir):
    s = SE.sum_by(rates_of(spark, sf_dir, "ticks_total"))
    return finish(s.select(ts_col(), F.col("value").alias("rate")), ("rate",))


_MEAN_SQL = """
  SELECT t, CASE WHEN s IS NOT NULL AND c IS NOT NULL THEN s / c END AS value FROM (
    SELECT t, sum(value) FILTER (WHERE part = 'sum') AS s, sum(value) FILTER (WHERE part = 'count') AS c
    FROM rates WHERE family = '{fam}' GROUP BY t) WHERE s IS NOT NULL AND c IS NOT NULL"""


@register("rate_mean", RATES + f"""
  SELECT {_t()} AS t, {S.r6('value')} AS mean_seconds FROM ({_MEAN_SQL.format(fam='e2e_latency_seconds')})""")
def rate_mean(spark, sf_dir):
    m = SE.rate_mean(rates_of(spark, sf_dir, "e2e_latency_seconds", parts=("sum", "count")))
    return finish(m.select(ts_col(), F.col("value").alias("mean_seconds")), ("mean_seconds",))


for _q in (0.5, 0.95, 0.99):
    _n = f"hist_p{int(round(_q * 100))}"

    def _fn(spark, sf_dir, _q=_q):
        b = rates_of(spark, sf_dir, "e2e_latency_seconds", parts=("bucket",))
        h = SE.histogram_quantile(_q, b)
        return finish(h.select(ts_col(), F.col("value").alias("quantile_seconds")), ("quantile_seconds",))
    register(_n, RATES + f""",
hsrc AS (SELECT t, {_q!r} AS q, le, sum(value) AS r FROM rates
         WHERE family = 'e2e_latency_seconds' AND part = 'bucket' GROUP BY t, le),
{Q.quantile_ctes('hsrc', 't', 'hq')}
  SELECT {_t()} AS t, {S.r6('value')} AS quantile_seconds FROM hq""")(_fn)


ASOF = HEAD + "," + Q.asof_ctes()


def gauges_of(spark, sf_dir, family):
    s = stored(spark, sf_dir)[1].where(F.col("family") == family)
    return SE.asof(s, FIXTURE_LOOKBACK, grid_of(spark, sf_dir))


@register("gauge_asof", ASOF + f"""
  SELECT name, {_t()} AS t, value AS bytes FROM gpts WHERE family = 'memory_working_set_bytes'""")
def gauge_asof(spark, sf_dir):
    g = gauges_of(spark, sf_dir, "memory_working_set_bytes")
    return finish(g.select(F.col("labels")["name"].alias("name"), ts_col(), F.col("value").alias("bytes")))


@register("gauge_total", ASOF + f"""
  SELECT {_t()} AS t, sum(value) AS bytes FROM gpts
  WHERE family = 'memory_working_set_bytes' AND coalesce(name, '') <> '' GROUP BY t""")
def gauge_total(spark, sf_dir):
    g = SE.match(gauges_of(spark, sf_dir, "memory_working_set_bytes"), name=("!=", ""))
    return finish(SE.sum_by(g).select(ts_col(), F.col("value").alias("bytes")))


_RANGE = 100 * FIXTURE_STEP, 160 * FIXTURE_STEP      # from the first scrape on
_LABEL_COLS = ("symbol", "name", "error_type", "alert_type")


def _flat(df):
    return df.select("family", "part", "le", *[F.col("labels")[c].alias(c) for c in _LABEL_COLS],
                     F.col("labels")["partition"].alias("partition"), ts_col("ts"), "value")


@register("samples_in_range", HEAD + f"""
  SELECT family, part, le, symbol, name, error_type, alert_type, pno AS "partition", {_t('ts')} AS ts,
         value
  FROM samples WHERE ts > {Q.O} + {_RANGE[0] - FIXTURE_RANGE} AND ts <= {Q.O} + {_RANGE[1]}""")
def samples_in_range(spark, sf_dir):
    """A filter on the stored samples that reaches the parquet scan."""
    origin = grid_of(spark, sf_dir).origin
    s = SE.scan_samples(stored_samples(spark, sf_dir), origin + _RANGE[0], origin + _RANGE[1], FIXTURE_RANGE)
    return finish(_flat(s))


@register("label_match", HEAD + f"""
  SELECT family, part, le, symbol, name, error_type, alert_type, pno AS "partition", {_t('ts')} AS ts,
         value
  FROM samples WHERE coalesce(error_type, '') = 'missing_timestamp' OR
                     (family = 'alerts_total' AND coalesce(alert_type, '') = 'SELL' AND coalesce(symbol, '') <> 'view')""")
def label_match(spark, sf_dir):
    s = stored_samples(spark, sf_dir)
    a = SE.match(s, error_type="missing_timestamp")
    b = SE.match(s.where(F.col("family") == "alerts_total"), alert_type="SELL", symbol=("!=", "view"))
    return finish(_flat(a.unionByName(b)))


@register("alerts_buy_sell_rate", RATES + f"""
  SELECT {_t()} AS t, {S.r6("sum(value) FILTER (WHERE alert_type = 'BUY')")} AS buy_per_sec,
         {S.r6("sum(value) FILTER (WHERE alert_type = 'SELL')")} AS sell_per_sec
  FROM rates WHERE family = 'alerts_total' GROUP BY t""")
def alerts_buy_sell_rate(spark, sf_dir):
    r = rates_of(spark, sf_dir, "alerts_total")
    at = SE.label("alert_type")
    g = r.groupBy("t").agg(F.sum(F.when(at == "BUY", F.col("value"))).alias("buy_per_sec"),
                           F.sum(F.when(at == "SELL", F.col("value"))).alias("sell_per_sec"))
    return finish(g.select(ts_col(), "buy_per_sec", "sell_per_sec"), ("buy_per_sec", "sell_per_sec"))


@register("latency_breakdown", RATES + f""",
  n AS ({_MEAN_SQL.format(fam='network_latency_seconds')}),
  s AS ({_MEAN_SQL.format(fam='system_latency_seconds')})
  SELECT {_t('coalesce(n.t, s.t)')} AS t, {S.r6('n.value')} AS network_avg, {S.r6('s.value')} AS system_avg
  FROM n FULL OUTER JOIN s ON n.t = s.t""")
def latency_breakdown(spark, sf_dir):
    s = stored(spark, sf_dir)[0].where(F.col("family").isin("network_latency_seconds", "system_latency_seconds")
                                     & (F.col("part") != "bucket"))
    r = SE.range_rate(s, FIXTURE_RANGE, grid_of(spark, sf_dir))
    m = SE.rate_mean(r, keys=("t", "family"))
    g = m.groupBy("t").agg(
        F.max(F.when(F.col("family") == "network_latency_seconds", F.col("value"))).alias("network_avg"),
        F.max(F.when(F.col("family") == "system_latency_seconds", F.col("value"))).alias("system_avg"))
    return finish(g.select(ts_col(), "network_avg", "system_avg"), ("network_avg", "system_avg"))


_GRID_SQL = f"(SELECT {Q.O} + k * {FIXTURE_STEP} AS t FROM {Q.SCRAPES}) g"


def _or0_sql(fam):
    return f"""SELECT g.t, coalesce(x.v, 0.0) AS value FROM {_GRID_SQL}
    LEFT JOIN (SELECT t, sum(value) AS v FROM rates WHERE family = '{fam}' GROUP BY t) x ON x.t = g.t"""


def _or0(spark, sf_dir, fam):
    return SE.default_on_grid(SE.sum_by(rates_of(spark, sf_dir, fam)), grid_of(spark, sf_dir), 0.0, spark)


@register("error_rate_default0", RATES + f"""
  SELECT {_t()} AS t, {S.r6('value')} AS errors_per_sec FROM ({_or0_sql('feed_errors_total')})""")
def error_rate_default0(spark, sf_dir):
    return finish(_or0(spark, sf_dir, "feed_errors_total").select(ts_col(), F.col("value").alias("errors_per_sec")), ("errors_per_sec",))


@register("error_rate_total", RATES + f"""
  SELECT {_t('a.t')} AS t, {S.r6('a.value + b.value')} AS errors_per_sec
  FROM ({_or0_sql('consumer_rejects_total')}) a JOIN ({_or0_sql('feed_errors_total')}) b ON a.t = b.t""")
def error_rate_total(spark, sf_dir):
    r = stored(spark, sf_dir)[0].where(F.col("family").isin("consumer_rejects_total", "feed_errors_total"))
    grid = grid_of(spark, sf_dir)
    per = SE.range_rate(r, FIXTURE_RANGE, grid).groupBy("t", "family").agg(F.sum("value").alias("v"))
    g = SE.default_on_grid(
        per.groupBy("t").agg(F.sum("v").alias("value")), grid, 0.0, spark)
    return finish(g.select(ts_col(), F.col("value").alias("errors_per_sec")), ("errors_per_sec",))


@register("error_status", RATES + f"""
  SELECT {_t()} AS t, {S.r6('value')} AS errors_per_sec,
         CASE WHEN value >= 0.1 THEN 'red' WHEN value >= 0.01 THEN 'yellow' ELSE 'green' END AS status
  FROM ({_or0_sql('feed_errors_total')})""")
def error_status(spark, sf_dir):
    g = _or0(spark, sf_dir, "feed_errors_total")
    return finish(g.select(ts_col(), F.col("value").alias("errors_per_sec"), status_of("value").alias("status")), ("errors_per_sec",))


@register("resource_rate_by_name", RATES + f"""
  SELECT name, {_t()} AS t, {S.r6('sum(value)')} AS cores FROM rates
  WHERE family = 'cpu_seconds_total' AND coalesce(name, '') <> '' GROUP BY name, t""")
def resource_rate_by_name(spark, sf_dir):
    r = SE.match(rates_of(spark, sf_dir, "cpu_seconds_total"), name=("!=", ""))
    return finish(SE.sum_by(r, by=("name",)).select("name", ts_col(), F.col("value").alias("cores")), ("cores",))


CATALOG_SQL = HEAD + "," + Q.catalog_ctes()


def catalog_long(spark, sf_dir, specs=None):
    from candlewick.plans.catalog import ALL_SPECS
    c, g = stored(spark, sf_dir)
    return evaluate(spark, c, g, grid_of(spark, sf_dir), FIXTURE_RANGE, FIXTURE_LOOKBACK, specs=specs or ALL_SPECS)


VALUE = ("value",)
_WITH_DATA = sorted({r[0] for r in spec_plan(CATALOG)})      # metrics that some source feeds
_CAT_WITH_DATA = ", ".join(f"'{n}'" for n in _WITH_DATA)
_CAT_NAMES = ", ".join(f"'{s.name}'" for s in CATALOG)


@register("catalog_metrics", CATALOG_SQL + f"""
  SELECT metric, {_t()} AS t, {S.r6('value')} AS value FROM catalog WHERE metric IN ({_CAT_NAMES})""")
def catalog_metrics(spark, sf_dir):
    c = catalog_long(spark, sf_dir, CATALOG)
    return finish(c.select("metric", ts_col(), "value"), VALUE)


@register("metric_coverage", CATALOG_SQL + f"""
  SELECT count(DISTINCT metric) AS metrics, count(DISTINCT t) AS timestamps FROM catalog
  WHERE metric IN ({_CAT_NAMES})""")
def metric_coverage(spark, sf_dir):
    from candlewick.operators.counts import coverage
    return coverage(catalog_long(spark, sf_dir, CATALOG), metric="metric", ts="t")


PANEL_SQL_PARTS = []
for _p in PANELS:
    if _p.op == "ref":
        PANEL_SQL_PARTS.append(
            f"SELECT '{_p.panel}' AS panel, '{_p.legend}' || CASE WHEN by_value = '' THEN '' ELSE ' ' || by_value END "
            f"AS series, t, value FROM catalog WHERE metric = '{_p.terms[0]}'")
    elif _p.op == "by":
        PANEL_SQL_PARTS.append(
            f"SELECT '{_p.panel}' AS panel, by_value AS series, t, value FROM catalog "
            f"WHERE metric = '{_p.terms[0]}'")
    elif _p.op in ("or0", "sum_or0"):
        terms = " + ".join(
            f"coalesce((SELECT sum(value) FROM catalog c WHERE c.metric = '{m}' AND c.t = g.t), 0.0)"
            for m in _p.terms)
        PANEL_SQL_PARTS.append(f"SELECT '{_p.panel}' AS panel, '{_p.legend}' AS series, g.t, {terms} AS value "
                               f"FROM {_GRID_SQL}")
    elif _p.op == "ratio":
        a, b = _p.terms
        PANEL_SQL_PARTS.append(
            f"SELECT '{_p.panel}' AS panel, '{_p.legend}' AS series, x.t, x.value / y.value AS value "
            f"FROM catalog x JOIN catalog y ON x.t = y.t WHERE x.metric = '{a}' AND y.metric = '{b}'")
PANELS_SQL = CATALOG_SQL + ", panels AS (\n    " + "\n    UNION ALL ".join(PANEL_SQL_PARTS) + ")"


def panels(spark, sf_dir):
    return panel_series(spark, catalog_long(spark, sf_dir), grid_of(spark, sf_dir), PANELS)


@register("panel_series", PANELS_SQL + f"""
  SELECT panel, series, {_t()} AS t, {S.r6('value')} AS value FROM panels""")
def q_panel_series(spark, sf_dir):
    return finish(panels(spark, sf_dir).select("panel", "series", ts_col(), "value"), VALUE)


@register("panel_summary", PANELS_SQL + f"""
  SELECT panel, series, {S.r6('avg(value)')} AS mean, {S.r6('median(value)')} AS median,
         {S.r6('stddev_pop(value)')} AS std_dev, {S.r6('min(value)')} AS "min", {S.r6('max(value)')} AS "max",
         {S.r6('arg_max(value, t)')} AS "last"
  FROM panels WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY panel, series""")
def q_panel_summary(spark, sf_dir):
    return finish(series_summary(panels(spark, sf_dir), keys=("panel", "series")),
                  ("mean", "median", "std_dev", "min", "max", "last"))


@register("metrics_wide", CATALOG_SQL + f""",
  longv AS (SELECT metric, {_t()} AS "timestamp", {S.r6('value')} AS value FROM catalog
            WHERE metric IN ({_CAT_NAMES}))
  SELECT * FROM (PIVOT longv ON metric IN ({_CAT_WITH_DATA}) USING first(value) GROUP BY "timestamp")""")
def q_metrics_wide(spark, sf_dir):
    from candlewick.operators.export import wide
    c = finish(catalog_long(spark, sf_dir, CATALOG).select("metric", ts_col(), "value"), VALUE)
    return wide(c, metrics=_WITH_DATA)
