"""Catalogue and exchange-metadata files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.functions.present import metric_name
from candlewick.functions.symbols import spot_symbols
from candlewick.plans.catalog import CATALOG, Spec
from candlewick.schemas import CATALOG_FILE_SCHEMA, SYMBOLS_FILE_SCHEMA


KINDS = ("rate_sum", "rate", "rate_mean", "hist_q", "gauge_sum", "gauge")


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A nested catalogue file (component -> metric -> {query, description,
    unit}) -> one row per metric with its flattened ``component_metric`` name.

    The file is one JSON document, read whole (``wholetext`` passed as an
    argument, since ``.option`` is overridden by ``text()``)."""
    doc = spark.read.text(path, wholetext=True)
    m = doc.select(F.from_json("value", CATALOG_FILE_SCHEMA).alias("c"))
    comp = m.select(F.explode("c").alias("component", "metrics"))
    rows = comp.select("component", F.explode("metrics").alias("metric", "d"))
    return rows.select("component", "metric", metric_name("component", "metric").alias("name"),
                       F.col("d.query").alias("query"), F.col("d.description").alias("description"),
                       F.col("d.unit").alias("unit"))


SPEC_FILE_SCHEMA = ("array<struct<component:string,metric:string,kind:string,family:string,"
                    "matchers:array<struct<label:string,op:string,value:string>>,q:double,unit:string,by:string>>")


def load_specs(spark: SparkSession, path: str) -> list[Spec]:
    """User-defined metrics from a JSON file: a list of {component, metric, kind,
    family, matchers: [{label, op, value}], q, unit, by}, ready for ``evaluate``.
    The file is configuration: its entries come to the driver."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", SPEC_FILE_SCHEMA).alias("s"))
    out = []
    for r in doc.select(F.inline("s")).collect():
        if r["kind"] not in KINDS or r["family"] is None or (r["kind"] == "hist_q") != (r["q"] is not None):
            raise ValueError(f"bad metric definition {r['component']}_{r['metric']}")
        matchers = tuple((m["label"], m["op"], m["value"]) for m in r["matchers"] or ())
        if any(op not in ("=", "!=") for _, op, _ in matchers):
            raise ValueError(f"bad matcher in {r['component']}_{r['metric']}")
        out.append(Spec(r["component"], r["metric"], r["kind"], r["family"], matchers, r["q"], r["unit"] or "",
                        r["by"]))
    return out


def catalog_specs(spark: SparkSession) -> DataFrame:
    """The built-in typed specs as a table (name, component, metric, kind, family, unit)."""
    rows = [(s.name, s.component, s.metric, s.kind, s.family, s.unit) for s in CATALOG]
    return spark.createDataFrame(rows, "name string, component string, metric string, kind string, "
                                       "family string, unit string")


def read_symbol_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Exchange metadata JSON (``symbols`` array) with an explicit schema."""
    return spark.read.schema(SYMBOLS_FILE_SCHEMA).option("multiLine", True).json(path)


def spot_symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """One row: the comma-joined lower-case symbols that allow spot trading."""
    return spot_symbols(read_symbol_metadata(spark, path))
