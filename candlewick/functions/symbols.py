"""Symbol lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def symbol_list(text) -> Column:
    """Comma list -> array of stripped, lower-cased, non-blank symbols, order kept."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(t, ","), lambda s: F.lower(F.trim(s)))
    return F.filter(parts, lambda s: s != "")


def spot_symbols(meta: DataFrame) -> DataFrame:
    """Exchange metadata (``symbols`` array) -> one row with the comma-joined,
    lower-cased symbols that allow spot trading, in input order."""
    rows = meta.select(F.posexplode("symbols").alias("pos", "s"))
    kept = rows.where(F.coalesce(F.col("s.isSpotTradingAllowed"), F.lit(False)))
    return kept.agg(F.expr("listagg(lower(coalesce(s.symbol, '')), ',') "
                           "WITHIN GROUP (ORDER BY pos)").alias("symbols"))
