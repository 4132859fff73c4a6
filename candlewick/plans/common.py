"""Shared plumbing of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.sources.tables import load
from candlewick.sources.ticks import ticks_from_events

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query builder under ``name`` with its DuckDB oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def finish(df: DataFrame, computed: tuple = ()) -> DataFrame:
    """Result columns of a query. Doubles that an engine may add up in any order
    (``computed``: sums, means, rates) are rounded to 6 decimals; every other double
    - prices, changes, counts, gauges - is returned as it is. NaN becomes NULL."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = (round6(c) if f.name in computed else F.when(~F.isnan(c), c)).alias(f.name)
        cols.append(c)
    return df.select(*cols)


#: Rounding switches between two multiples at 0.58578644 of the way, not at half:
#: means and interpolated quantiles are often exact halves of the last decimal, and
#: there the order of summation would decide.
OFF_HALF = 0.08578644


def round6(c):
    """The multiple of 1e-6 next to a double, within 0.6e-6 of it (NaN -> NULL)."""
    return F.when(~F.isnan(c), F.rint(c * F.lit(1e6) - F.lit(OFF_HALF)) / F.lit(1e6))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(load(spark, sf_dir, "events"))
