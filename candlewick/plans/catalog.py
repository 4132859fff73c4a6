"""The metric catalogue (52 metrics) and the dashboard panels (19), as data.

A catalogue entry is a typed spec, not query text:
  kind  rate_sum   sum(rate(family[R]))                (counters)
        rate       rate(family[R])                     (single series)
        rate_mean  sum(rate(family_sum[R])) / sum(rate(family_count[R]))
        hist_q     histogram_quantile(q, sum by (le) (rate(family_bucket[R])))
        gauge_sum  sum(family)                         (as-of lookup)
        gauge      family                              (as-of lookup)
  matchers  ((label, op, value), ...) with op '=' or '!='
  by        optional label to keep (``sum by (name)``)
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Spec:
    component: str
    metric: str
    kind: str
    family: str
    matchers: tuple = ()
    q: float | None = None
    unit: str = ""
    by: str | None = None

    @property
    def name(self) -> str:
        return f"{self.component}_{self.metric}"


P = (("consumer", "=", "prices"),)
A = (("consumer", "=", "alerts"),)
NAMED = (("name", "!=", ""),)


def _hist(component, prefix, family, matchers=()):
    return [Spec(component, f"{prefix}_avg", "rate_mean", family, matchers, None, "seconds"),
            Spec(component, f"{prefix}_p50", "hist_q", family, matchers, 0.50, "seconds"),
            Spec(component, f"{prefix}_p95", "hist_q", family, matchers, 0.95, "seconds"),
            Spec(component, f"{prefix}_p99", "hist_q", family, matchers, 0.99, "seconds")]


# --- fixed values: metric names, base series, matchers and units ------------
CATALOG: list[Spec] = [
    *_hist("binance_producer", "latency", "producer_latency_seconds"),
    *_hist("binance_producer", "network_latency", "binance_network_latency_seconds"),
    Spec("binance_producer", "receive_rate_msg_per_sec", "rate_sum", "producer_messages_received_total", unit="msg/s"),
    Spec("binance_producer", "throughput_msg_per_sec", "rate_sum", "producer_messages_sent_total", unit="msg/s"),
    Spec("binance_producer", "errors_per_sec", "rate_sum", "producer_errors_total", unit="errors/s"),
    *_hist("prices_consumer", "e2e_latency", "consumer_e2e_latency_seconds", P),
    *_hist("prices_consumer", "system_latency", "consumer_system_latency_seconds", P),
    *_hist("prices_consumer", "processing_latency", "consumer_processing_latency_seconds", P),
    Spec("prices_consumer", "throughput_msg_per_sec", "rate_sum", "consumer_messages_processed_total", P, unit="msg/s"),
    Spec("prices_consumer", "errors_per_sec", "rate_sum", "consumer_errors_total", P, unit="errors/s"),
    Spec("prices_consumer", "lag_messages", "gauge_sum", "kafka_consumergroup_lag",
         (("consumergroup", "=", "prices_consumer_group"), ("topic", "=", "prices")), unit="messages"),
    *_hist("alerts_consumer", "processing_latency", "consumer_processing_latency_seconds", A),
    Spec("alerts_consumer", "alerts_stored_per_sec", "rate_sum", "consumer_alerts_stored_total", A, unit="alerts/s"),
    Spec("alerts_consumer", "buy_alerts_per_sec", "rate_sum", "consumer_alerts_stored_total",
         A + (("alert_type", "=", "BUY"),), unit="alerts/s"),
    Spec("alerts_consumer", "sell_alerts_per_sec", "rate_sum", "consumer_alerts_stored_total",
         A + (("alert_type", "=", "SELL"),), unit="alerts/s"),
    Spec("alerts_consumer", "errors_per_sec", "rate_sum", "consumer_errors_total", A, unit="errors/s"),
    Spec("alerts_consumer", "lag_messages", "gauge_sum", "kafka_consumergroup_lag",
         (("consumergroup", "=", "alerts_consumer_group"), ("topic", "=", "alerts")), unit="messages"),
    *_hist("spark_processor", "batch_duration", "spark_batch_duration_seconds"),
    Spec("spark_processor", "input_rate_rows_per_sec", "rate_sum", "spark_input_rows_total", unit="rows/s"),
    Spec("spark_processor", "output_rate_rows_per_sec", "rate_sum", "spark_output_rows_total", unit="rows/s"),
    Spec("spark_processor", "batches_per_sec", "rate_sum", "spark_batches_completed_total", unit="batches/s"),
    Spec("spark_processor", "errors_per_sec", "rate_sum", "spark_errors_total", unit="errors/s"),
    Spec("infrastructure", "cpu_usage_total", "rate_sum", "container_cpu_usage_seconds_total", NAMED, unit="cores"),
    Spec("infrastructure", "memory_usage_total", "gauge_sum", "container_memory_working_set_bytes", NAMED, unit="bytes"),
    Spec("infrastructure", "network_receive_bytes_per_sec", "rate_sum", "container_network_receive_bytes_total", NAMED, unit="bytes/s"),
    Spec("infrastructure", "network_transmit_bytes_per_sec", "rate_sum", "container_network_transmit_bytes_total", NAMED, unit="bytes/s"),
    Spec("infrastructure", "disk_read_bytes_per_sec", "rate_sum", "container_fs_reads_bytes_total", NAMED, unit="bytes/s"),
    Spec("infrastructure", "disk_write_bytes_per_sec", "rate_sum", "container_fs_writes_bytes_total", NAMED, unit="bytes/s"),
    Spec("clock_monitoring", "clock_skew_seconds", "gauge", "binance_clock_skew_seconds", unit="seconds"),
    Spec("clock_monitoring", "api_round_trip_seconds", "gauge", "binance_api_round_trip_seconds", unit="seconds"),
    Spec("clock_monitoring", "clock_skew_errors_per_sec", "rate", "binance_time_request_errors_total", unit="errors/s"),
]
# --- end of fixed values -----------------------------------------------------

# Per-container panel queries keep the ``name`` label (``sum by (name)``).
BY_NAME: list[Spec] = [
    Spec("panel", "cpu_by_name", "rate_sum", "container_cpu_usage_seconds_total", NAMED, by="name"),
    Spec("panel", "memory_by_name", "gauge_sum", "container_memory_working_set_bytes", NAMED, by="name"),
    Spec("panel", "network_receive_by_name", "rate_sum", "container_network_receive_bytes_total", NAMED, by="name"),
    Spec("panel", "network_transmit_by_name", "rate_sum", "container_network_transmit_bytes_total", NAMED, by="name"),
    Spec("panel", "disk_read_by_name", "rate_sum", "container_fs_reads_bytes_total", NAMED, by="name"),
    Spec("panel", "disk_write_by_name", "rate_sum", "container_fs_writes_bytes_total", NAMED, by="name"),
]

# Catalogue base series -> series derived from the driver tables (+ labels).
FAMILY_SOURCES: list[tuple[str, str, tuple]] = [
    ("producer_latency_seconds", "producer_latency_seconds", ()),
    ("binance_network_latency_seconds", "network_latency_seconds", ()),
    ("producer_messages_received_total", "ticks_total", ()),
    ("producer_messages_sent_total", "ticks_total", ()),
    ("producer_errors_total", "feed_errors_total", ()),
    ("consumer_e2e_latency_seconds", "e2e_latency_seconds", (("consumer", "prices"),)),
    ("consumer_system_latency_seconds", "system_latency_seconds", (("consumer", "prices"),)),
    ("consumer_processing_latency_seconds", "processing_latency_seconds", (("consumer", "prices"),)),
    ("consumer_processing_latency_seconds", "alert_processing_seconds", (("consumer", "alerts"),)),
    ("consumer_messages_processed_total", "ticks_total", (("consumer", "prices"),)),
    ("consumer_errors_total", "consumer_rejects_total", (("consumer", "prices"),)),
    ("consumer_errors_total", "alert_rejects_total", (("consumer", "alerts"),)),
    ("kafka_consumergroup_lag", "partition_lag",
     (("consumergroup", "prices_consumer_group"), ("topic", "prices"))),
    ("kafka_consumergroup_lag", "alert_lag",
     (("consumergroup", "alerts_consumer_group"), ("topic", "alerts"))),
    ("consumer_alerts_stored_total", "alerts_total", (("consumer", "alerts"),)),
    ("spark_batch_duration_seconds", "e2e_latency_seconds", ()),
    ("spark_input_rows_total", "ticks_total", ()),
    ("spark_output_rows_total", "alerts_total", ()),
    ("spark_batches_completed_total", "network_transmit_bytes_total", ()),
    ("spark_errors_total", "feed_errors_total", ()),
    ("container_cpu_usage_seconds_total", "cpu_seconds_total", ()),
    ("container_memory_working_set_bytes", "memory_working_set_bytes", ()),
    ("container_network_receive_bytes_total", "network_receive_bytes_total", ()),
    ("container_network_transmit_bytes_total", "network_transmit_bytes_total", ()),
    ("container_fs_reads_bytes_total", "fs_reads_bytes_total", ()),
    ("container_fs_writes_bytes_total", "fs_writes_bytes_total", ()),
    ("binance_clock_skew_seconds", "clock_skew_seconds", ()),
    ("binance_api_round_trip_seconds", "api_round_trip_seconds", ()),
    ("binance_time_request_errors_total", "time_request_errors_total", ()),
]
# A running job's own samples (``streaming.listener``) instead of derived ones: what the
# progress of its batches reports needs no stand-in.
PROGRESS_FAMILIES = ("spark_batch_duration_seconds", "spark_input_rows_total", "spark_output_rows_total",
                     "spark_batches_completed_total", "kafka_consumergroup_lag")


def live_sources(mapping=None) -> list[tuple[str, str, tuple]]:
    """``FAMILY_SOURCES`` with the families of a job's progress fed by themselves."""
    kept = [m for m in mapping or FAMILY_SOURCES if m[0] not in PROGRESS_FAMILIES]
    return kept + [(f, f, ()) for f in PROGRESS_FAMILIES]


GAUGE_SOURCES = {"memory_working_set_bytes", "clock_skew_seconds", "api_round_trip_seconds",
                 "partition_lag", "alert_lag"}


@dataclass(frozen=True)
class PanelSeries:
    """One legend line of a panel. ``op``: ref (a metric), or0 (a metric, 0
    where absent), sum_or0 (sum of metrics, each 0 where absent), ratio
    (first / second), by (one line per label value of a by-label spec)."""
    panel: str
    legend: str
    op: str
    terms: tuple = field(default_factory=tuple)


# --- fixed values: dashboard panels (title, legend, expression) -------------
PANELS: list[PanelSeries] = [
    PanelSeries("End-to-End Latency (Binance → Consumer)", "avg", "ref", ("prices_consumer_e2e_latency_avg",)),
    PanelSeries("End-to-End Latency (Binance → Consumer)", "p95", "ref", ("prices_consumer_e2e_latency_p95",)),
    PanelSeries("End-to-End Latency (Binance → Consumer)", "p99", "ref", ("prices_consumer_e2e_latency_p99",)),
    PanelSeries("Consumer Throughput", "msg/s", "ref", ("prices_consumer_throughput_msg_per_sec",)),
    PanelSeries("Consumer Lag (Prices Topic)", "lag", "ref", ("prices_consumer_lag_messages",)),
    PanelSeries("Latency Breakdown (Network vs System)", "system", "ref", ("prices_consumer_system_latency_avg",)),
    PanelSeries("Latency Breakdown (Network vs System)", "network", "ref", ("binance_producer_network_latency_avg",)),
    PanelSeries("Total Error Rate (Consumer + Producer)", "errors/s", "sum_or0",
                ("prices_consumer_errors_per_sec", "binance_producer_errors_per_sec")),
    PanelSeries("System Latency %", "system share", "ratio",
                ("prices_consumer_system_latency_avg", "prices_consumer_e2e_latency_avg")),
    PanelSeries("Estimated Clock Skew (Local − Binance)", "skew", "ref", ("clock_monitoring_clock_skew_seconds",)),
    PanelSeries("Binance API Round Trip Time", "rtt", "ref", ("clock_monitoring_api_round_trip_seconds",)),
    PanelSeries("Spark Batch Processing Time", "avg", "ref", ("spark_processor_batch_duration_avg",)),
    PanelSeries("Spark Batch Processing Time", "p95", "ref", ("spark_processor_batch_duration_p95",)),
    PanelSeries("Spark Batch Processing Time", "p99", "ref", ("spark_processor_batch_duration_p99",)),
    PanelSeries("Spark Input Rate (from prices topic)", "rows/s", "ref", ("spark_processor_input_rate_rows_per_sec",)),
    PanelSeries("Spark Output Rate (to alerts topic)", "rows/s", "ref", ("spark_processor_output_rate_rows_per_sec",)),
    PanelSeries("Spark Error Rate", "errors/s", "or0", ("spark_processor_errors_per_sec",)),
    PanelSeries("Alerts Consumer Error Rate", "errors/s", "or0", ("alerts_consumer_errors_per_sec",)),
    PanelSeries("CPU Usage per Container", "", "by", ("panel_cpu_by_name",)),
    PanelSeries("Memory Usage per Container (Working Set)", "", "by", ("panel_memory_by_name",)),
    PanelSeries("Network Receive per Container", "", "by", ("panel_network_receive_by_name",)),
    PanelSeries("Network Transmit per Container", "", "by", ("panel_network_transmit_by_name",)),
    PanelSeries("Disk Read per Container", "", "by", ("panel_disk_read_by_name",)),
    PanelSeries("Disk Write per Container", "", "by", ("panel_disk_write_by_name",)),
]
# --- end of fixed values -----------------------------------------------------

ALL_SPECS = CATALOG + BY_NAME
assert len(CATALOG) == 52 and len({s.name for s in CATALOG}) == 52
