"""Plan-shape guards: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def plan_of(spark, name):
    df = E.queries()[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["alerts_1h", "candles_1m", "candles_orders_1w", "latest_price",
                                  "latency_histogram", "throughput", "message_counts"])
def test_one_shuffle_hash_aggregation(static, name):
    p = plan_of(static, name)
    assert "SortAggregate" not in p             # fixed-width buffers: partial + final hash aggregate
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_" in p                     # map-side combine before the shuffle


def test_scan_reads_only_needed_columns(static):
    p = plan_of(static, "alerts_1h")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p
    assert "props" not in p and "user_id" not in p


@pytest.mark.parametrize("name", ["rate_total", "hist_p95", "gauge_total", "catalog_metrics", "samples_in_range"])
def test_no_range_or_cross_join(static, name):
    p = plan_of(static, name)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_only_configuration_is_broadcast(static):
    p = plan_of(static, "current_prices_ordered")
    assert p.count("BroadcastExchange") == 1
    assert "Range (0, 1" in p.split("BroadcastExchange")[1]   # the configured list, not the prices


def test_exact_quantiles_never_gather_a_group(static):
    """No exact percentile aggregate (it buffers a whole group); the final
    window sees only bracketed candidates."""
    for name in ("latency_quantiles", "latency_quantiles_bracketed"):
        p = plan_of(static, name)
        assert "percentile(" not in p.replace("percentile_approx", "")


def test_series_are_combined_before_colocation(static):
    """Samples are aggregated per (series, scrape) with a map-side combine
    before any exchange that co-locates a whole series."""
    from candlewick.sources.samples import increments, per_scrape, scrape_grid
    events = static.read.parquet(f"{SF001}/events.parquet")
    p = per_scrape(increments(events, None, scrape_grid(events)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by(value" in p and "partial_sum(inc" in p


def test_labels_are_not_encoded_or_parsed_per_sample(static):
    """JSON texts of label sets are made below the generator of the increments, and read
    back below the join with the blocks of series: never per sample."""
    from candlewick.plans import planted
    from candlewick.sources import samples as SA

    def above(df, node):
        lines = df._jdf.queryExecution().optimizedPlan().toString().lower().split("\n")
        at = next(i for i, x in enumerate(lines) if node in x)
        return "\n".join(lines[:at])
    events = static.read.parquet(f"{SF001}/events.parquet")
    grid = SA.scrape_grid(events)
    made = above(SA.per_scrape(SA.increments(events, None, grid)), "generate inline")
    assert "to_json" not in made and "structstojson" not in made
    filled = SA.cumulative(SA.increments(events, None, grid), grid)
    stored = SA.as_samples(planted.spoiled(filled), grid)
    assert "from_json" not in above(stored, "join ") and "from_json" in stored._jdf.queryExecution().optimizedPlan().toString()


def test_no_window_holds_a_whole_series(static):
    """Grid filling and evaluation work on (series, block); only the one-row-per-block
    table is windowed by series."""
    from candlewick.plans.q_series import samples
    import re
    for df in (samples(static, SF001), E.queries()["rate_by_series"](static, SF001),
               E.queries()["gauge_asof"](static, SF001)):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        specs = re.findall(r"Window \[(.*?)\], \[(.*?)\]", p)
        assert specs
        for made, by in specs:
            assert "_before" in made or "k0" in made or by.count(",") >= 1 or "\x1e" in p


def test_catalogue_is_evaluated_in_one_pass(static):
    p = plan_of(static, "catalog_metrics")
    assert p.count("BroadcastHashJoin") == 1 and p.count("Generate explode") == 4   # blocks and points, twice
    assert p.count("Window [") <= 2             # lag and lead; no window over buckets


def test_a_range_reaches_the_sample_scan(static):
    p = plan_of(static, "samples_in_range")
    assert "GreaterThan(ts" in p and "LessThanOrEqual(ts" in p
