"""Summarise the physical plans of registered queries (shuffles, joins,
aggregates, scans with their pushed filters and read schema).

usage: python tools/plan_report.py [sf_dir] [name ...]  -> markdown on stdout
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewick.session import get_session  # noqa: E402

DEFAULT = ["alerts_1h", "candles_orders_1w", "latest_price", "current_prices_ordered", "normalized_ticks",
           "latency_histogram", "latency_quantiles", "consumer_lag", "replay_15m", "rate_total",
           "hist_p95", "gauge_total", "samples_in_range", "catalog_metrics"]


def summary(plan: str) -> dict:
    ops = re.findall(r"^\(\d+\) ([A-Za-z]+(?: [A-Za-z]+)*)", plan, flags=re.M)
    count = {}
    for o in ops:
        count[o] = count.get(o, 0) + 1
    scans = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    pushed = [p for p in re.findall(r"PushedFilters: (\[[^\n]*\])", plan) if p != "[]"]
    return {"ops": count, "scans": scans, "pushed": pushed}


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or DEFAULT
    from candlewick.plans.registry import QUERIES
    spark = get_session("local[4]", shuffle_partitions=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    print(f"Plans at `{sf_dir}` (AQE off to show the static plan).\n")
    print("| query | shuffles | broadcasts | aggregates | windows / generates | scans (read schema) | pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summary(plan)
        o = s["ops"]
        aggs = ", ".join(f"{k}×{v}" for k, v in o.items() if "Aggregate" in k) or "-"
        wg = ", ".join(f"{k}×{v}" for k, v in o.items() if k in ("Window", "Generate")) or "-"
        bj = ", ".join(f"{k}×{v}" for k, v in o.items() if "Join" in k or "NestedLoop" in k) or "-"
        sc = "; ".join(sorted(set(x.replace("struct<", "").rstrip(">") for x in s["scans"])))
        pf = "; ".join(sorted(set(s["pushed"]))) or "-"
        print(f"| {n} | {o.get('Exchange', 0)} | {bj} | {aggs} | {wg} | {sc} | {pf} |")
    spark.stop()


if __name__ == "__main__":
    main()
