"""foreachBatch sinks with idempotent, versioned table writes.

Each micro-batch writes a complete new version ``v=<batch_id>`` of a small
keyed table under a shared folder and marks it committed; readers use the
highest committed version. Re-running a batch after a failure rewrites the
same version with the same content, so delivery is effectively once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.config import MAX_ALERTS_STORED
from candlewick.operators.alerts import ALERT_COLUMNS

_MARK = "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions of a table folder (directory listing only)."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), _MARK)):
            out.append(int(name[2:]))
    return sorted(out)


def read_latest_version(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The newest committed version (older than ``before`` if given), or None."""
    vs = [v for v in committed_versions(spark, root) if before is None or v < before]
    if not vs:
        return None
    return spark.read.parquet(f"{root}/v={vs[-1]}")


KEEP_VERSIONS = 5


def _commit(spark: SparkSession, df: DataFrame, root: str, batch_id: int, keep: int = KEEP_VERSIONS) -> None:
    """Write version ``batch_id``, mark it committed, then drop versions older
    than the newest ``keep`` (readers always take the newest committed one, so
    a long-running stream does not accumulate one folder per batch)."""
    path = f"{root}/v={batch_id}"
    df.write.mode("overwrite").parquet(path)
    fs, _, jvm = _fs(spark, path)
    fs.create(jvm.org.apache.hadoop.fs.Path(path, _MARK), True).close()
    for v in committed_versions(spark, root)[:-keep]:
        if v < batch_id:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v}"), True)


def upsert_latest(root: str, key: str = "symbol", order: str = "offset",
                  fields=("price", "binance_timestamp", "received_timestamp")):
    """foreachBatch function: last write wins per key (latest-price table).

    Arrival order is (batch_id, ``order``); the table is one row per key, so
    each version stays as small as the key set."""
    def run(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        # scalar order: a hash aggregate with a map-side combine over the batch
        new = batch_df.groupBy(key).agg(*[F.max_by(f, order).alias(f) for f in fields])
        prev = read_latest_version(spark, root, before=batch_id)
        # a batch comes after all before it, so its keys replace theirs
        latest = new if prev is None else new.unionByName(
            prev.select(key, *fields).join(new, prev[key].eqNullSafe(new[key]), "left_anti"))
        _commit(spark, latest, root, batch_id)
    return run


def append_trim(root: str, n: int = MAX_ALERTS_STORED, columns=ALERT_COLUMNS):
    """foreachBatch function: append alerts and keep only the newest ``n``
    (arrival = batch, then window end, then symbol); a bounded top-n.

    Beside the log stands a table of marks (``<root>_marks``, one row per symbol):
    the latest window end of that symbol that was ever trimmed. An alert that is
    delivered again is known by its row in the log (same symbol and window; the
    first arrival stays) or by the mark: at or below it, it was trimmed already, or
    is older than one that was, so it cannot push out a newer alert."""
    marks_root = f"{root}_marks"
    same = ["symbol", "window_start"]

    def run(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        prev = read_latest_version(spark, root, before=batch_id)
        marks = read_latest_version(spark, marks_root, before=batch_id)
        new = batch_df.select(*columns, F.lit(batch_id).alias("_b")).dropDuplicates(same)
        if marks is not None:
            m = marks.select(F.col("symbol").alias("_s"), "trimmed_to")
            new = (new.join(m, new["symbol"].eqNullSafe(m["_s"]), "left")
                   .where(F.col("trimmed_to").isNull() | (F.col("window_end") > F.col("trimmed_to")))
                   .drop("_s", "trimmed_to"))
        if prev is not None:
            new = prev.unionByName(new.join(prev.select(*same), same, "left_anti"))
        new = new.persist()
        try:
            kept = new.orderBy(F.col("_b").desc(), F.col("window_end").desc(), F.col("symbol").asc()).limit(n)
            _commit(spark, kept, root, batch_id)
            stored = spark.read.parquet(f"{root}/v={batch_id}").select(*same)
            trimmed = new.join(stored, same, "left_anti").groupBy("symbol").agg(F.max("window_end").alias("trimmed_to"))
            if marks is not None:
                trimmed = trimmed.unionByName(marks).groupBy("symbol").agg(F.max("trimmed_to").alias("trimmed_to"))
            _commit(spark, trimmed, marks_root, batch_id)
        finally:
            new.unpersist()
    return run
