"""Time-series evaluation over long-form metric samples.

Samples: (family, part, labels map<string,string>, le, ts, value) where
``part`` is 'bucket' / 'sum' / 'count' for histogram parts and '' otherwise,
``ts`` is epoch seconds. Evaluation happens on a grid t = origin + j*step.

No range join is ever planned: every sample is exploded to the (few) grid
points whose window covers it - at most range/step points for a rate, and
for an as-of lookup only the points before the next sample of its series -
and then grouped on equality keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

SERIES_KEYS = ("family", "part", "series", "le")
#: Evaluation points of one block of a series. A long series is evaluated in blocks, so
#: no task holds all of it.
BLOCK_POINTS = 1024
NAN = float("nan")
INF = float("inf")


def series_id(*cols: str) -> Column:
    """One string key for a series. Windows partition on it rather than on the
    separate columns: Spark normalises floating keys (``le``) in a window's
    partitioning but not in a later aggregate's distribution, which would cost
    an extra shuffle; hash partitioning on this single key satisfies both."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


@dataclass(frozen=True)
class Grid:
    """Evaluation grid: t = origin + j*step for j in [first, last]."""
    origin: int
    step: int
    first: int
    last: int

    def t(self, j: Column) -> Column:
        return F.lit(self.origin) + j * F.lit(self.step)

    @property
    def start(self) -> int:
        return self.origin + self.first * self.step

    @property
    def end(self) -> int:
        return self.origin + self.last * self.step


_ENTRIES = "array<struct<key:string,value:string>>"


def series_key(labels: Column) -> Column:
    """Canonical text of a label set (maps cannot be grouped on): its entries in
    key order as JSON, so that any character and NULL survive."""
    return F.coalesce(F.to_json(F.array_sort(F.map_entries(labels))), F.lit("[]"))


def labels_of(key: Column) -> Column:
    """The label map that ``series_key`` was made from."""
    return F.map_from_entries(F.from_json(key, _ENTRIES))


def with_series(samples: DataFrame) -> DataFrame:
    if "series" in samples.columns:
        return samples
    return samples.withColumn("series", series_key(F.col("labels")))


def label(name: str) -> Column:
    """A label's value; an absent label reads as the empty string."""
    return F.coalesce(F.col("labels")[name], F.lit(""))


def match(samples: DataFrame, **matchers) -> DataFrame:
    """Label matchers: ``name="v"`` means equal, ``name=("!=", "v")`` not equal."""
    cond = F.lit(True)
    for k, v in matchers.items():
        op, val = v if isinstance(v, tuple) else ("=", v)
        c = label(k)
        cond = cond & ((c == val) if op == "=" else (c != val))
    return samples.where(cond)


def scan_samples(samples: DataFrame, start: int, end: int, lookback: int = 0) -> DataFrame:
    """Samples needed to evaluate [start, end]: the range or lookback widens
    the lower bound. A plain filter on ``ts``: it reaches the parquet scan."""
    return samples.where((F.col("ts") > F.lit(start - lookback)) & (F.col("ts") <= F.lit(end)))


def _served(ts: Column, width: Column | int, grid: Grid) -> tuple[Column, Column]:
    """First and last grid index j with ts <= t_j < ts + width, within the grid."""
    def index(x):
        return F.ceil((x - F.lit(grid.origin)) / F.lit(float(grid.step)))
    lo = F.greatest(index(ts), F.lit(grid.first)).cast("long")
    hi = F.least(index(ts + width) - F.lit(1), F.lit(grid.last)).cast("long")
    return lo, hi


def in_blocks(samples: DataFrame, width_s: int, grid: Grid, block: int) -> DataFrame:
    """Each sample in every block of ``block`` grid points that it serves (ts <= t_j <
    ts + width), with ``lo`` and ``hi``, the points it serves there, and ``_sk``, the
    key of (series, block).

    A sample near the end of a block also stands in the next one, as far as ``width_s``
    reaches. All samples of any evaluated range so meet in the block of its point, in
    order, and so does the predecessor or successor that matters at that point: blocks
    are evaluated apart and give what the whole series would."""
    lo, hi = _served(F.col("ts"), F.lit(float(width_s)), grid)
    s = samples.withColumn("_lo", lo).withColumn("_hi", hi).where("_hi >= _lo")
    number = lambda j: F.floor((F.col(j) - F.lit(grid.first)) / F.lit(block)).cast("long")
    s = s.withColumn("_b", F.explode(F.sequence(number("_lo"), number("_hi"))))
    start = F.col("_b") * F.lit(block) + F.lit(grid.first)
    return (s.withColumn("lo", F.greatest(F.col("_lo"), start))
            .withColumn("hi", F.least(F.col("_hi"), start + F.lit(block - 1)))
            .withColumn("_sk", F.concat_ws("\x1e", series_id(*SERIES_KEYS), "_b")).drop("_lo", "_hi", "_b"))


def _div(num: Column, den: Column) -> Column:
    """IEEE division: x/0 = +-Inf, 0/0 = NaN (a present point, not a missing one)."""
    return (F.when(den != 0, num / den)
            .when(num == 0, F.lit(NAN))
            .when(num > 0, F.lit(INF))
            .when(num < 0, F.lit(-INF)))


def range_rate(samples: DataFrame, range_s: int, grid: Grid, is_rate: bool = True,
               block: int = BLOCK_POINTS) -> DataFrame:
    """Per-series extrapolated counter rate (or increase) over (t - range, t].

    Output: family, part, series, labels, le, t, value. A series needs at
    least two samples in the range for a point. Reset correction counts a
    drop only when the previous sample is inside the same range.
    """
    # Only samples some grid point can see: (start - range, end]. A drop is a
    # reset only when its predecessor is in the same range, so samples before
    # the first range never matter. The filter reaches the scan.
    samples = scan_samples(samples, grid.start, grid.end, range_s)
    s = in_blocks(with_series(samples).select(*SERIES_KEYS, F.col("ts").cast("double").alias("ts"),
                                              F.col("value").cast("double").alias("v")), range_s, grid, block)
    w = Window.partitionBy("_sk").orderBy("ts")
    s = s.withColumn("pv", F.lag("v").over(w)).withColumn("pts", F.lag("ts").over(w))
    e = s.select("*", F.explode(F.sequence("lo", "hi")).alias("j")).withColumn("t", grid.t(F.col("j")).cast("double"))
    lower = F.col("t") - F.lit(float(range_s))
    reset = F.when((F.col("pts") > lower) & (F.col("v") < F.col("pv")), F.col("pv")).otherwise(F.lit(0.0))
    g = e.groupBy("_sk", *SERIES_KEYS, "t").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("t0"), F.max("ts").alias("t1"),
        F.min_by("v", "ts").alias("v0"), F.max_by("v", "ts").alias("v1"),
        F.sum(reset).alias("resets"),
    ).where((F.col("n") >= 2) & (F.col("t1") > F.col("t0")))   # two distinct sample times
    inc = F.col("v1") - F.col("v0") + F.col("resets")
    si = F.col("t1") - F.col("t0")
    av = si / (F.col("n") - F.lit(1))
    thr = av * F.lit(1.1)
    ds0 = F.col("t0") - (F.col("t") - F.lit(float(range_s)))
    ds1 = F.when(ds0 >= thr, av / 2).otherwise(ds0)
    dz = F.when(inc != 0, si * (F.col("v0") / inc))
    ds = F.when((inc > 0) & (F.col("v0") >= 0) & (dz < ds1), dz).otherwise(ds1)
    de0 = F.col("t") - F.col("t1")
    de = F.when(de0 >= thr, av / 2).otherwise(de0)
    factor = (si + ds + de) / si
    if is_rate:
        factor = factor / F.lit(float(range_s))
    return g.select(*SERIES_KEYS, labels_of(F.col("series")).alias("labels"),
                    F.col("t").cast("long").alias("t"), (inc * factor).alias("value"))


def asof(samples: DataFrame, lookback_s: int, grid: Grid, block: int = BLOCK_POINTS) -> DataFrame:
    """Gauge value at each grid point: the latest sample in (t - lookback, t].

    ``lead`` gives each sample's successor, so a sample is exploded only to
    the grid points before the next sample of its series; each (series, t)
    then has exactly one row and no aggregation is needed.
    """
    # Only samples some grid point can see: (start - lookback, end]; a sample
    # whose successor lies beyond ``end`` still serves at most up to ``end``.
    samples = scan_samples(samples, grid.start, grid.end, lookback_s)
    s = in_blocks(with_series(samples).select(*SERIES_KEYS, F.col("ts").cast("double").alias("ts"), "value"),
                  lookback_s, grid, block)
    nts = F.lead("ts").over(Window.partitionBy("_sk").orderBy("ts"))
    before = F.ceil((nts - F.lit(grid.origin)) / F.lit(float(grid.step))).cast("long") - F.lit(1)
    s = s.withColumn("hi", F.least("hi", before)).where("hi >= lo")
    e = s.select(*SERIES_KEYS, "value", F.explode(F.sequence("lo", "hi")).alias("j"))
    return e.select(*SERIES_KEYS, labels_of(F.col("series")).alias("labels"),
                    grid.t(F.col("j")).cast("long").alias("t"), F.col("value").cast("double").alias("value"))


def sum_by(points: DataFrame, by=()) -> DataFrame:
    """``sum by (labels...)`` per t (``by`` empty = plain ``sum``)."""
    keys = [label(b).alias(b) for b in by]
    return points.groupBy(*keys, "t").agg(F.sum("value").alias("value"))


def ratio(num: DataFrame, den: DataFrame, keys=("t",)) -> DataFrame:
    """One-to-one match of two vectors on ``keys``; NaN for 0/0."""
    j = num.withColumnRenamed("value", "_n").join(den.withColumnRenamed("value", "_d"), list(keys))
    return j.select(*keys, _div(F.col("_n"), F.col("_d")).alias("value"))


def rate_mean(rates: DataFrame, keys=("t",)) -> DataFrame:
    """sum(rate(x_sum)) / sum(rate(x_count)) from one pass of conditional sums.
    A point needs both parts present (inner vector match)."""
    p = F.col("part")
    g = rates.groupBy(*keys).agg(
        F.sum(F.when(p == "sum", F.col("value"))).alias("_n"),
        F.sum(F.when(p == "count", F.col("value"))).alias("_d"))
    return g.where(F.col("_n").isNotNull() & F.col("_d").isNotNull()).select(
        *keys, _div(F.col("_n"), F.col("_d")).alias("value"))


def with_quantile(df: DataFrame, buckets: str, q: Column, name: str) -> DataFrame:
    """Column ``name``: histogram_quantile of an array column of (le, r), r the
    cumulative count or rate; null where the array is.

    Buckets are made monotonic (the first r at or above the rank is the first running
    maximum there, too). NaN when there is no +Inf bucket, fewer than two buckets or no
    observations; the largest finite bound when the rank falls in +Inf; else linear
    interpolation inside the bucket (from 0 for the first). Each array is made once, in
    a projection of its own."""
    kept = df.columns
    d = df.withColumn("_a", F.array_sort(F.col(buckets))).withColumn("_q", q)
    d = d.withColumn("_le", F.col("_a.le")).withColumn("_r", F.col("_a.r"))
    d = d.withColumn("_total", F.array_max("_r")).withColumn("_n", F.size("_a"))
    rank = F.col("_q") * F.col("_total")
    d = d.withColumn("_pick", F.array_position(F.transform("_r", lambda x: x >= rank), True).cast("int"))
    pick = F.col("_pick")
    d = (d.withColumn("_le_b", F.get("_le", pick - 1)).withColumn("_r_b", F.get("_r", pick - 1))
         .withColumn("_lo", F.coalesce(F.get("_le", pick - 2), F.lit(0.0)))
         .withColumn("_r_lo", F.coalesce(F.array_max(F.slice("_r", F.lit(1), F.greatest(pick - 1, F.lit(0)))),
                                         F.lit(0.0))))
    qq, total, n, lo, le_b = (F.col(c) for c in ("_q", "_total", "_n", "_lo", "_le_b"))
    value = (F.when(F.col("_a").isNull(), F.lit(None).cast("double"))
             .when(qq < 0, F.lit(-INF)).when(qq > 1, F.lit(INF))
             .when(n < 2, F.lit(NAN))
             .when(F.get("_le", n - 1) != F.lit(INF), F.lit(NAN))
             .when(total.isNull() | (total == 0) | F.isnan(total), F.lit(NAN))
             .when(pick == n, F.array_max(F.filter("_le", lambda x: x != F.lit(INF))))
             .when((pick == 1) & (le_b <= 0), le_b)
             .otherwise(lo + (le_b - lo) * _div(rank - F.col("_r_lo"), F.col("_r_b") - F.col("_r_lo"))))
    return d.select(*kept, value.alias(name))


def bucket_quantile(per_le: DataFrame, keys, q: Column | float | str = "q", r: str = "r") -> DataFrame:
    """histogram_quantile over cumulative bucket values ``per_le(keys.., le, r)``: the
    buckets of a key (its histogram's few bounds) become one array, folded in place."""
    keys = list(keys)
    qc = F.first(q) if isinstance(q, str) and q not in keys else F.col(q) if isinstance(q, str) \
        else q if isinstance(q, Column) else F.lit(float(q))
    g = per_le.groupBy(*keys).agg(F.collect_list(F.struct("le", F.col(r).alias("r"))).alias("_b"), qc.alias("_q"))
    return with_quantile(g.withColumnRenamed("_q", "_at"), "_b", F.col("_at"), "value").select(*keys, "value")


def histogram_quantile(q: float, bucket_rates: DataFrame, keys=("t",)) -> DataFrame:
    """``histogram_quantile(q, sum by (le) (rate(x_bucket)))`` per key."""
    per_le = bucket_rates.groupBy(*keys, "le").agg(F.sum("value").alias("r"))
    return bucket_quantile(per_le, keys, float(q))


def default_on_grid(points: DataFrame, grid: Grid, default: float = 0.0, spark=None) -> DataFrame:
    """``expr or vector(default)``: every grid point gets a value.

    The grid is generated (its size is the number of evaluation steps) and
    left-joined by t."""
    spark = spark or points.sparkSession
    g = spark.range(grid.first, grid.last + 1).select(grid.t(F.col("id")).cast("long").alias("t"))
    return g.join(points, "t", "left").select(
        "t", F.coalesce(F.col("value"), F.lit(default)).alias("value"))
