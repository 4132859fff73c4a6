"""Catalogue evaluation: every spec from one shared rate pass and one as-of pass.

Plan shape (independent of the number of specs):
  counter samples -> Generate(blocks) -> Exchange(series, block) -> Window(lag)
                  -> Generate(grid points) -> HashAggregate(series, block, t)  [no shuffle]
  gauge samples   -> Generate(blocks) -> Exchange(series, block) -> Window(lead)
                  -> Generate(grid points)
  -> one BroadcastHashJoin on (family, part, kind) with the fixed plan table
     (catalogue x family mapping, resolved once in Python)
  -> HashAggregate(spec, t, le) -> one array of buckets per (spec, t) -> value per kind
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from candlewick.operators.series import Grid, _div, asof, range_rate, series_key, with_quantile
from candlewick.plans.catalog import ALL_SPECS, FAMILY_SOURCES, Spec
from candlewick.session import bounded_broadcast

PLAN_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("q", T.DoubleType(), True),
    T.StructField("by", T.StringType(), True),
    T.StructField("source", T.StringType(), False),
    T.StructField("src_part", T.StringType(), False),
    T.StructField("src_kind", T.StringType(), False),
    T.StructField("matchers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("op", T.StringType()),
        T.StructField("value", T.StringType())])), False),
])
_PARTS = {"rate_sum": ("",), "rate": ("",), "rate_mean": ("sum", "count"), "hist_q": ("bucket",),
          "gauge_sum": ("",), "gauge": ("",)}


def spec_plan(specs: list[Spec] = ALL_SPECS, mapping=FAMILY_SOURCES) -> list[tuple]:
    """Resolve the fixed catalogue against the fixed family mapping.

    One row per (spec, source family, part). Matchers on labels that the
    mapping injects are decided here, once; the rest stay as (key, op, value)
    checks on the source labels.
    """
    rows = []
    for sp in specs:
        for cat_family, source, extra in mapping:
            if cat_family != sp.family:
                continue
            extra = dict(extra)
            keep, ok = [], True
            for key, op, val in sp.matchers:
                if key in extra:
                    ok &= (extra[key] == val) if op == "=" else (extra[key] != val)
                else:
                    keep.append((key, op, val))
            if not ok:
                continue
            kind = "gauge" if sp.kind.startswith("gauge") else "rate"
            for part in _PARTS[sp.kind]:
                rows.append((sp.name, sp.kind, sp.q, sp.by, source, part, kind, keep))
    return rows


def _matched() -> Column:
    """Whether a sample's labels pass every matcher of its plan row."""
    def one(m):
        v = F.coalesce(F.element_at(F.col("labels"), m["key"]), F.lit(""))
        return F.when(m["op"] == "=", v == m["value"]).otherwise(v != m["value"])
    return F.forall("matchers", one)


def evaluate(spark: SparkSession, counters: DataFrame, gauges: DataFrame, grid: Grid, range_s: int,
             lookback_s: int, specs: list[Spec] = ALL_SPECS, mapping=FAMILY_SOURCES) -> DataFrame:
    """All specs over counter and gauge samples -> (metric, by_value, t, value)."""
    plan_rows = spec_plan(specs, mapping)
    plan = spark.createDataFrame(plan_rows, PLAN_SCHEMA)
    fam = F.col("family")
    needed = sorted({r[4] for r in plan_rows})
    rates = range_rate(counters.where(fam.isin(needed)), range_s, grid)
    gauge_pts = asof(gauges.where(fam.isin(needed)), lookback_s, grid)
    cols = ["family", "part", "labels", "le", "t", "value"]
    pts = rates.select(*cols, F.lit("rate").alias("kind_of")).unionByName(
        gauge_pts.select(*cols, F.lit("gauge").alias("kind_of")))
    # Equi-join on (family, part, kind) against the small fixed plan table.
    cond = ((pts["family"] == plan["source"]) & (pts["part"] == plan["src_part"])
            & (pts["kind_of"] == plan["src_kind"]))
    j = pts.join(bounded_broadcast(plan, len(plan_rows)), cond).where(_matched())
    # ``sum by (label)`` keeps one line per label value; a bare selector (gauge or
    # rate) keeps every series apart (so an export can refuse several series per
    # metric); every other kind sums to a single line.
    by_value = (F.when(F.col("by").isNotNull(), F.coalesce(F.element_at("labels", F.col("by")), F.lit("")))
                .when(F.col("kind").isin("gauge", "rate") & (F.size("labels") > 0), series_key(F.col("labels")))
                .otherwise(F.lit("")))
    j = j.select("name", "kind", "q", by_value.alias("by_value"), "t", "le", "part", "value")
    keys = ["name", "kind", "q", "by_value", "t"]
    lvl1 = j.groupBy(*keys, "le").agg(
        F.sum("value").alias("v"),
        F.sum(F.when(F.col("part") == "sum", F.col("value"))).alias("s"),
        F.sum(F.when(F.col("part") == "count", F.col("value"))).alias("c"))
    # One row per key: the buckets of a histogram as an array; outside histograms
    # ``le`` is NULL, so there is one row per key already.
    hist = F.col("kind") == "hist_q"
    g = lvl1.groupBy(*keys).agg(
        F.collect_list(F.when(hist, F.struct("le", F.col("v").alias("r")))).alias("buckets"),
        F.max("v").alias("v"), F.max("s").alias("s"), F.max("c").alias("c"))
    g = with_quantile(g, "buckets", F.col("q"), "quantile")
    s, c = F.col("s"), F.col("c")
    value = (F.when(hist, F.col("quantile"))
             .when(F.col("kind") == "rate_mean", F.when(s.isNotNull() & c.isNotNull(), _div(s, c)))
             .otherwise(F.col("v")))
    return g.select(F.col("name").alias("metric"), "by_value", "t", value.alias("value")) \
        .where(F.col("value").isNotNull())


def panel_frame(spark: SparkSession, panels) -> DataFrame:
    rows = []
    for p in panels:
        for i, term in enumerate(p.terms):
            rows.append((p.panel, p.legend, p.op, term, i))
    return spark.createDataFrame(rows, "panel string, legend string, op string, term string, pos int")


def panel_series(spark: SparkSession, metrics: DataFrame, grid: Grid, panels) -> DataFrame:
    """Panel lines from evaluated metrics -> (panel, series, t, value).

    ``or0`` / ``sum_or0`` lines are defined on every grid point (absent terms
    count as 0); ``ratio`` needs both terms; ``by`` lines are one per label value.
    """
    pf = panel_frame(spark, panels)
    n_terms = sum(len(p.terms) for p in panels)
    m = metrics.join(bounded_broadcast(pf, n_terms), metrics["metric"] == pf["term"])
    # several series of a bare selector stay lines of their own
    several = (F.col("op") == "ref") & (F.col("by_value") != "")
    series = (F.when(F.col("op") == "by", F.col("by_value"))
              .when(several, F.concat_ws(" ", "legend", "by_value")).otherwise(F.col("legend")))
    m = m.select("panel", series.alias("series"), "op", "pos", "t", "value")
    # Grid points for lines that default to 0: generated per line, not joined.
    defaults = pf.where(F.col("op").isin("or0", "sum_or0")).select("panel", "legend", "op").distinct()
    g = defaults.select("panel", F.col("legend").alias("series"), "op",
                        F.lit(-1).alias("pos"),
                        F.explode(F.sequence(F.lit(grid.first), F.lit(grid.last))).alias("j"))
    g = g.select("panel", "series", "op", "pos", grid.t(F.col("j")).cast("long").alias("t"),
                 F.lit(0.0).alias("value"))
    u = m.unionByName(g)
    op = F.first("op")
    num = F.sum(F.when(F.col("pos") == 0, F.col("value")))
    den = F.sum(F.when(F.col("pos") == 1, F.col("value")))
    agg = u.groupBy("panel", "series", "t").agg(
        op.alias("op"), num.alias("num"), den.alias("den"),
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    value = (F.when(F.col("op") == "ratio",
                    F.when(F.col("num").isNotNull() & F.col("den").isNotNull(), _div(F.col("num"), F.col("den"))))
             .otherwise(F.col("total")))
    return agg.select("panel", "series", "t", value.alias("value")).where(F.col("value").isNotNull())
