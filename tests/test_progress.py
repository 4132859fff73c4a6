"""A job's own progress as metric samples: lag, rates and quantiles of the catalogue."""

import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators.metrics import evaluate
from candlewick.operators.series import Grid
from candlewick.plans.catalog import CATALOG, live_sources
from candlewick.streaming.listener import progress_frame, progress_lag, progress_row, progress_samples


def report(batch, second, seconds, rows, end, latest):
    """A progress report as ``recentProgress`` gives it, offsets as text or parsed."""
    return {"id": "q1", "batchId": batch, "timestamp": f"2024-01-01T00:00:{second:02d}.000Z",
            "batchDuration": int(seconds * 1000), "numInputRows": rows,
            "stateOperators": [{"numRowsDroppedByWatermark": 1}], "sink": {"numOutputRows": rows // 2},
            "sources": [{"description": "KafkaV2[Subscribe[prices]]", "startOffset": None,
                         "endOffset": end if batch % 2 else json.dumps(end), "latestOffset": latest},
                        {"description": "FileStreamSource", "startOffset": None, "endOffset": {"logOffset": 3},
                         "latestOffset": None}]}


@pytest.fixture()
def progress(spark):
    return progress_frame(spark, [
        report(k, 5 * k, 0.2 if k % 2 else 3.0, 10 * k, {"prices": {"0": 100 * k, "1": 50 * k}},
               {"prices": {"0": 100 * k + 7, "1": 50 * k, "2": 4}}) for k in range(1, 11)])


def test_lag_per_partition(spark, progress):
    got = {(r.labels["partition"], r.ts): r.value for r in progress_lag(progress, "g").collect()}
    t = 1704067200.0
    assert got == {(p, t + 5 * k): v for k in range(1, 11) for p, v in (("0", 7.0), ("1", 0.0), ("2", 4.0))}
    labels = progress_lag(progress, "g").first().labels
    assert labels["consumergroup"] == "g" and labels["topic"] == "prices"


def test_catalogue_metrics_from_progress(spark, progress):
    """The job's entries of the catalogue without stand-ins, by hand."""
    specs = [s for s in CATALOG if s.component == "spark_processor" or s.metric == "lag_messages"]
    grid = Grid(1704067200, 5, 1, 10)
    gauges = progress_lag(progress, "prices_consumer_group")
    out = evaluate(spark, progress_samples(progress), gauges, grid, 60, 300, specs=specs, mapping=live_sources())
    at = {(r.metric, r.t - 1704067200): r.value for r in out.collect()}
    assert at[("prices_consumer_lag_messages", 50)] == 11.0
    assert ("alerts_consumer_lag_messages", 50) not in at
    # ten samples 5 s apart, one more batch at each: 9 in 45 s, drawn out half a step to the empty start
    batches = at[("spark_processor_batches_per_sec", 50)]
    assert batches == pytest.approx(9 * (45 + 2.5) / 45 / 60, rel=1e-9)
    # the summed seconds begin at 0.2 of 15.8, so they are drawn out to their zero only
    seconds = 4 * 0.2 + 5 * 3.0
    assert at[("spark_processor_batch_duration_avg", 50)] == pytest.approx(
        seconds * (45 + 45 * 0.2 / seconds) / (9 * (45 + 2.5)), rel=1e-9)
    assert 2.5 <= at[("spark_processor_batch_duration_p95", 50)] <= 5.0
    assert ("spark_processor_errors_per_sec", 50) not in at


def test_events_and_dicts_give_the_same_row():
    class O:
        def __init__(self, **kw):
            self.__dict__.update(kw)
    d = report(3, 15, 0.5, 30, {"prices": {"0": 5}}, {"prices": {"0": 9}})
    e = O(id="q1", batchId=3, timestamp=d["timestamp"], batchDuration=500, numInputRows=30, sink=O(numOutputRows=15),
          stateOperators=[O(numRowsDroppedByWatermark=1)],
          sources=[O(endOffset=json.dumps(s["endOffset"]), latestOffset=s["latestOffset"] and json.dumps(s["latestOffset"]))
                   for s in d["sources"]])
    assert progress_row(d) == progress_row(e)


def test_a_real_run_reports_rows(spark, scratch):
    spark.range(20).write.parquet(f"{scratch}/in")
    q = spark.readStream.schema("id long").parquet(f"{scratch}/in").writeStream.format("noop") \
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    p = progress_frame(spark, q.recentProgress)
    assert p.agg(F.sum("input_rows")).first()[0] == 20 and progress_lag(p, "g").count() == 0
