"""Streaming sources (A1-A3): Kafka topics, or Kafka-shaped files for replay.

The Kafka connector is used when it is on the classpath; replays and tests
read parquet files with the same columns (key, value, topic, partition,
offset, timestamp, timestampType), one file per micro-batch if asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.schemas import KAFKA_SCHEMA
from candlewick.session import bounded_broadcast, checkpoint_root


def read_topic(spark: SparkSession, topic: str, *, source: str = "kafka", path: str | None = None,
               bootstrap: str | None = None, starting: str = "latest", files_per_trigger: int | None = None,
               group: str | None = None, **options) -> DataFrame:
    """Subscribe to one topic (``source="kafka"``) or replay Kafka-shaped
    parquet files under ``path`` (``source="files"``)."""
    if source == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap or "localhost:9092")
             .option("subscribe", topic)
             .option("startingOffsets", starting)
             .option("failOnDataLoss", "false"))
        if group:
            r = r.option("kafka.group.id", group)
        for k, v in options.items():
            r = r.option(k, v)
        return r.load()
    if source == "files":
        r = spark.readStream.schema(KAFKA_SCHEMA)
        if files_per_trigger:
            r = r.option("maxFilesPerTrigger", files_per_trigger)
        for k, v in options.items():
            r = r.option(k, v)
        return r.parquet(path)
    raise ValueError(f"unknown source {source!r}")


def read_ticks_stream(spark: SparkSession, **kw) -> DataFrame:
    """The prices topic (price records keyed by symbol)."""
    return read_topic(spark, kw.pop("topic", "prices"), **kw)


def read_alerts_stream(spark: SparkSession, **kw) -> DataFrame:
    """The alerts topic (alert records keyed by symbol)."""
    return read_topic(spark, kw.pop("topic", "alerts"), **kw)


def since(df: DataFrame, minutes: int, time_col: str = "event_time") -> DataFrame:
    """Rows a retention-bounded replay still holds: time >= max(time) - minutes
    (the topic keeps 15 minutes). The maximum is a scalar subquery (one tiny
    aggregate reading one column), not a join."""
    # the whole bound stands inside the subquery, so the filter reaches the scan
    bound = df.select(F.max(time_col) - F.expr(f"INTERVAL {int(minutes)} MINUTES")).scalar()
    return df.where(F.col(time_col) >= bound)


#: Offset ranges that one round of the retention search tells apart in a partition.
RETENTION_BINS = 1024


def retain_bytes(records: DataFrame, max_bytes: int, size: Column, partition: str = "partition",
                 offset: str = "offset") -> DataFrame:
    """The newest records of each topic partition whose sizes add up to at most
    ``max_bytes`` (the topic keeps 2 GB per partition): those at or above the smallest
    offset from which all newer ones fit.

    No partition is sorted. A round adds up the bytes of RETENTION_BINS equal offset
    ranges per partition (a hash aggregate with map-side combine) and keeps the one
    range in which the bound is crossed; ranges shrink 1,024-fold, so an offset is found
    in at most seven rounds, and later ones read only that range. Between rounds there
    is one row per partition. A null size counts as 0; records of one offset go
    together; null partitions and offsets are dropped, as no topic has any."""
    spark = records.sparkSession
    checkpoint_root(spark)
    at = records.where(F.col(partition).isNotNull() & F.col(offset).isNotNull()).withColumn(
        "_bytes", F.coalesce(size, F.lit(0)).cast("long"))
    cut = at.groupBy(F.col(partition).alias("_p")).agg(
        F.min(offset).cast("long").alias("_lo"), F.max(offset).cast("long").alias("_hi"),
        F.sum("_bytes").alias("_all")).withColumn("_newer", F.lit(0).cast("long")).checkpoint()
    whole = F.col("_all") <= max_bytes
    done = cut.where(whole).select("_p", F.col("_lo").alias("_from"))
    cut = cut.where(~whole).drop("_all")
    while True:
        left = cut.agg(F.count("*").alias("n"), F.max(F.col("_hi") - F.col("_lo")).alias("wide"),
                       F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).first()
        if not left["n"]:
            break
        # the widest span of this round bounds the scan; a partition's own span the join
        near = at.where(F.col(offset).between(left["lo"], left["hi"]))
        width = F.greatest(F.lit(1).cast("long"), F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.lit(RETENTION_BINS)).cast("long"))
        bins = (near.join(bounded_broadcast(cut, left["n"]), F.col(partition) == F.col("_p"))
                .where(F.col(offset).between(F.col("_lo"), F.col("_hi")))
                .groupBy("_p", "_lo", "_hi", "_newer", width.alias("_w"),
                         F.floor((F.col(offset) - F.col("_lo")) / width).cast("long").alias("_bin"))
                .agg(F.sum("_bytes").alias("_b")))
        down = Window.partitionBy("_p").orderBy(F.col("_bin").desc())       # at most RETENTION_BINS rows
        bins = bins.withColumn("_upto", F.col("_newer") + F.sum("_b").over(down))
        crossed = bins.where(F.col("_upto") > max_bytes).groupBy("_p").agg(
            F.max(F.struct("_bin", "_lo", "_hi", "_w", "_upto", "_b")).alias("x")).select("_p", "x.*")
        start = F.col("_lo") + F.col("_bin") * F.col("_w")
        crossed = crossed.select("_p", start.alias("_lo"), F.least(start + F.col("_w") - 1, "_hi").alias("_hi"),
                                 (F.col("_upto") - F.col("_b")).alias("_newer"), "_w").checkpoint()
        # a range of one offset that does not fit: all above it is kept
        done = done.unionByName(crossed.where("_w = 1").select("_p", (F.col("_lo") + 1).alias("_from")))
        cut = crossed.where("_w > 1").drop("_w")
    kept = done.select("_p", "_from").checkpoint()
    return records.join(bounded_broadcast(kept, kept.count()), F.col(partition) == F.col("_p")) \
        .where(F.col(offset) >= F.col("_from")).drop("_p", "_from")


def write_in_time_order(records: DataFrame, path: str, files: int, order_col: str = "offset") -> None:
    """Write a replay tape as ``files`` files of consecutive ``order_col``
    ranges whose modification times follow that order.

    The file source replays files by modification time (one per micro-batch
    with ``maxFilesPerTrigger=1``); parallel writes finish in any order and
    would make earlier rows late. One range-partitioned write (partition ids,
    and so file names, follow the ranges), then the files' times are set in
    name order - a single pass over the data plus one metadata call per file."""
    spark = records.sparkSession
    records.repartitionByRange(files, order_col).write.mode("append").parquet(path)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    base = max(st.getModificationTime() for st in fs.listStatus(root)) + 1000
    for i, p in enumerate(parts):
        fs.setTimes(p, base + 1000 * i, -1)


def replay_in_slices(records: DataFrame, path: str, run, slices: int, order_col: str = "offset") -> None:
    """Replay a tape in the order of ``order_col``, whatever file times a store
    keeps: a slice of it is appended to ``path``, then ``run()`` processes what is
    new (a query with ``availableNow``, restarted from its checkpoint)."""
    cuts = records.approxQuantile(order_col, [k / slices for k in range(1, slices)], 0.001)
    at = F.col(order_col)
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        part = records if lo is None else records.where(at > lo)
        (part if hi is None else part.where(at <= hi)).write.mode("append").parquet(path)
        run()
