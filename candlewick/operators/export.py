"""Wide export of evaluated metrics."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.operators.metrics import evaluate, spec_plan
from candlewick.operators.series import Grid
from candlewick.session import checkpoint_root

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def single_series(long_df: DataFrame, metric: str = "metric", time: str = "t") -> None:
    """Each catalogue entry must evaluate to one series: at most one value per
    (metric, timestamp). Raises otherwise (one aggregate, stops at the first hit)."""
    dup = long_df.groupBy(metric, time).count().where(F.col("count") > 1)
    if dup.limit(1).count() > 0:
        raise ValueError("a metric has several series at one timestamp")


def wide(long_df: DataFrame, metric: str = "metric", time: str = "t", value: str = "value",
         metrics: list[str] | None = None) -> DataFrame:
    """Long (metric, t, value) -> one row per timestamp, one column per metric,
    columns sorted (an N-way full outer merge as one shuffle). With the metric
    names given the input is evaluated once; without, a first pass finds those
    that have data."""
    out = long_df.groupBy(time).pivot(metric, metrics).agg(F.first(value))
    cols = sorted(c for c in out.columns if c != time)
    return out.select(F.col(time).alias("timestamp"), *[F.col(f"`{c}`") for c in cols])


def write_metrics_csv(wide_df: DataFrame, path: str) -> None:
    """CSV with a header, rows in time order, ISO timestamps, empty string for a
    missing value. Epoch seconds become timestamps."""
    kind = wide_df.schema["timestamp"].dataType.typeName()
    time = F.col("timestamp") if kind.startswith("timestamp") else F.timestamp_seconds("timestamp")
    (wide_df.withColumn("timestamp", time.cast("timestamp_ntz")).orderBy("timestamp")
     .write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "")
     .option("timestampNTZFormat", ISO).csv(path))


def export_metrics(long_df: DataFrame, path: str, metrics: list[str] | None = None) -> DataFrame:
    """Check single series, pivot wide, write the CSV; returns the wide frame. The
    evaluated metrics are materialised once for the three passes."""
    checkpoint_root(long_df.sparkSession)
    once = long_df.checkpoint()
    single_series(once)
    w = wide(once, metrics=metrics)
    write_metrics_csv(w, path)
    return w


def read_metrics_csv(spark: SparkSession, path: str, metrics: list[str]) -> DataFrame:
    """An export read back: ISO timestamps and one double column per metric."""
    schema = "timestamp timestamp_ntz, " + ", ".join(f"`{m}` double" for m in sorted(metrics))
    return spark.read.option("header", True).option("timestampNTZFormat", ISO).schema(schema).csv(path)


def export_metadata(spark: SparkSession, wide_df: DataFrame, name: str, start: str, end: str,
                    step: str, metrics: list[str]) -> DataFrame:
    """One-row run description: experiment name, range, duration, step, the
    metrics asked for, the columns that had data and the timestamp count."""
    cols = [c for c in wide_df.columns if c != "timestamp"]
    base = spark.createDataFrame(
        [(name, start, end, step, metrics, cols)],
        "experiment_name string, start_time string, end_time string, step string, "
        "metrics_exported array<string>, columns array<string>")
    n = wide_df.agg(F.count_distinct("timestamp").alias("num_timestamps"))
    dur = (F.unix_timestamp(F.to_timestamp("end_time")) - F.unix_timestamp(F.to_timestamp("start_time")))
    # ``n`` is a one-row aggregate: a scalar subquery, not a join.
    return base.select("experiment_name", "start_time", "end_time", dur.cast("double").alias("duration_seconds"),
                       "step", "metrics_exported", "columns",
                       n.select("num_timestamps").scalar().alias("num_timestamps"))


def write_metadata(meta_df: DataFrame, path: str) -> None:
    meta_df.coalesce(1).write.mode("overwrite").json(path)


def metadata_dict(meta_df: DataFrame) -> dict:
    """The one metadata row as a plain dict (a single row by construction)."""
    row = meta_df.first()
    return json.loads(json.dumps(row.asDict(recursive=True), default=str))


def _epoch(t: str) -> int:
    return int(dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc).timestamp())


def run_export(spark: SparkSession, counters: DataFrame, gauges: DataFrame, start: str, end: str,
               step_seconds: int, name: str, path: str, specs, range_s: int, lookback_s: int) -> DataFrame:
    """Evaluate ``specs`` at start, start + step, ... up to end (ISO times, UTC), write
    ``path``/metrics as CSV and ``path``/metadata as JSON; returns the wide frame."""
    grid = Grid(_epoch(start) - step_seconds, step_seconds, 1, (_epoch(end) - _epoch(start)) // step_seconds + 1)
    long = evaluate(spark, counters, gauges, grid, range_s, lookback_s, specs=specs)
    names = sorted({r[0] for r in spec_plan(specs)})
    out = export_metrics(long.select("metric", "t", "value"), f"{path}/metrics", names)
    write_metadata(export_metadata(spark, out, name, start, end, f"{step_seconds}s", [s.name for s in specs]),
                   f"{path}/metadata")
    return out


_MANIFEST = "first long, last long, step long, metrics array<string>"


def _manifest(spark: SparkSession, path: str) -> list:
    """Finished pieces of a growing export, in time order (one row per run)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return []
    return sorted(spark.read.schema(_MANIFEST).json(f"{path}/manifest").collect(), key=lambda r: r["first"])


def extend_export(spark: SparkSession, counters: DataFrame, gauges: DataFrame, start: str, end: str,
                  step_seconds: int, path: str, specs, range_s: int, lookback_s: int) -> int:
    """Bring a growing export up to ``end``: only the points after the last one written
    are evaluated (from samples that reach at most a range or lookback further back).
    Returns the number of points added.

    A run writes ``metrics/<first>-<last>`` and then one manifest entry. Readers take
    the pieces of the manifest, so a run that died leaves nothing behind that counts,
    and its repetition overwrites the same piece; a run up to a point already there
    adds nothing. Samples that arrive for points already written are not taken up."""
    done = _manifest(spark, path)
    if done and done[0]["step"] != step_seconds:
        raise ValueError("the export was begun with another step")
    first = _epoch(start) if not done else max(r["last"] for r in done) + step_seconds
    points = (_epoch(end) - first) // step_seconds + 1
    if points <= 0:
        return 0
    last = first + (points - 1) * step_seconds
    grid = Grid(first - step_seconds, step_seconds, 1, points)
    long = evaluate(spark, counters, gauges, grid, range_s, lookback_s, specs=specs)
    names = sorted({r[0] for r in spec_plan(specs)})
    export_metrics(long.select("metric", "t", "value"), f"{path}/metrics/{first}-{last}", names)
    spark.createDataFrame([(first, last, step_seconds, names)], _MANIFEST).coalesce(1) \
        .write.mode("overwrite").json(f"{path}/manifest/run={first}")
    return points


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """All finished pieces of a growing export; a metric that a piece does not have is
    null there."""
    out = None
    for r in _manifest(spark, path):
        piece = read_metrics_csv(spark, f"{path}/metrics/{r['first']}-{r['last']}", r["metrics"])
        out = piece if out is None else out.unionByName(piece, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no finished export under {path}")
    return out
