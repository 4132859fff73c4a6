"""Wide export: CSV layout and run metadata."""

import csv
import glob

import pytest

from candlewick.operators.export import (export_metadata, export_metrics, metadata_dict, read_metrics_csv, wide,
                                         write_metadata, write_metrics_csv)


def test_wide_csv_and_metadata(spark, scratch):
    long = spark.createDataFrame(
        [("b_metric", 10, 1.5), ("a_metric", 10, 2.0), ("b_metric", 5, 0.5)],
        "metric string, t long, value double")
    w = wide(long)
    assert w.columns == ["timestamp", "a_metric", "b_metric"]
    write_metrics_csv(w, f"{scratch}/csv")
    rows = []
    for p in sorted(glob.glob(f"{scratch}/csv/part-*.csv")):
        with open(p) as f:
            rows += list(csv.reader(f))
    header = rows[0]
    body = [r for r in rows if r != header]
    assert header == ["timestamp", "a_metric", "b_metric"]
    assert body == [["1970-01-01T00:00:05", "", "0.5"], ["1970-01-01T00:00:10", "2.0", "1.5"]]
    back = read_metrics_csv(spark, f"{scratch}/csv", ["b_metric", "a_metric"]).orderBy("timestamp").collect()
    assert [(r.timestamp.second, r.a_metric, r.b_metric) for r in back] == [(5, None, 0.5), (10, 2.0, 1.5)]
    meta = metadata_dict(export_metadata(spark, w, "exp1", "2024-01-01T00:00:00", "2024-01-01T00:02:00", "5s",
                                         ["a_metric", "b_metric", "c_metric"]))
    assert meta["duration_seconds"] == 120.0
    assert meta["columns"] == ["a_metric", "b_metric"]
    assert meta["metrics_exported"] == ["a_metric", "b_metric", "c_metric"]
    assert meta["num_timestamps"] == 2
    m = export_metadata(spark, w, "exp1", "2024-01-01T00:00:00", "2024-01-01T00:02:00", "5s", ["a_metric"])
    write_metadata(m, f"{scratch}/meta")
    import json
    files = glob.glob(f"{scratch}/meta/part-*.json")
    assert len(files) == 1 and json.loads(open(files[0]).read())["experiment_name"] == "exp1"


def test_duplicate_series_rejected(spark, scratch):
    import pytest
    long = spark.createDataFrame([("m", 1, 1.0), ("m", 1, 2.0)], "metric string, t long, value double")
    with pytest.raises(ValueError):
        export_metrics(long, f"{scratch}/dup")


def test_a_growing_export_equals_one_long_run(spark, scratch):
    """Pieces, a repeated run, and a run that died before its manifest entry."""
    from candlewick.operators.export import extend_export, read_export, run_export
    from candlewick.plans.catalog import Spec
    rows = [("f_total", "", {"s": s}, None, 100 + 5 * k, float(k * k)) for k in range(60) for s in ("a", "b")]
    counters = spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, "
                                           "ts long, value double")
    gauges = counters.where("family = 'none'")
    spec = [Spec("x", "m", "rate_sum", "f_total")]
    import candlewick.operators.export as X
    old = X.evaluate
    X.evaluate = lambda *a, **kw: old(*a, **kw, mapping=[("f_total", "f_total", ())])
    plan = X.spec_plan
    X.spec_plan = lambda specs: plan(specs, [("f_total", "f_total", ())])
    try:
        iso = lambda t: f"1970-01-01T00:{t // 60:02d}:{t % 60:02d}"
        args = (5, f"{scratch}/grown", spec, 30, 60)
        assert extend_export(spark, counters, gauges, iso(120), iso(200), *args) == 17
        assert extend_export(spark, counters, gauges, iso(120), iso(200), *args) == 0
        spark.range(3).write.csv(f"{scratch}/grown/metrics/205-250")         # what a dead run left
        assert extend_export(spark, counters, gauges, iso(120), iso(250), *args) == 10
        assert extend_export(spark, counters, gauges, iso(120), iso(390), *args) == 28
        with pytest.raises(ValueError):
            extend_export(spark, counters, gauges, iso(120), iso(395), 10, *args[1:])
        run_export(spark, counters, gauges, iso(120), iso(390), 5, "one", f"{scratch}/one", spec, 30, 60)
    finally:
        X.evaluate, X.spec_plan = old, plan
    grown = sorted(tuple(r) for r in read_export(spark, f"{scratch}/grown").collect())
    one = sorted(tuple(r) for r in X.read_metrics_csv(spark, f"{scratch}/one/metrics", ["x_m"]).collect())
    assert grown == one and len(one) == 55
