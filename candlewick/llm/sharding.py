"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a draw u in (0, 1) from the MD5 of both; the record
goes to the shard with the largest weight / -ln(u). A record's draws do not
depend on the other shards, so a shard that is added only takes records, each
with probability weight / total weight, and moves none between the old ones.

DataFrame functions only. Only (key, digest, size) rows are shuffled, never
texts. Slots number a shard's records in the order of their key's MD5. They are
found from counts: distinct keys are ranked within ranges of the MD5 space that
hold about ``rank_rows`` of them, and the rows of one key are numbered by input
partition, so neither a large shard nor a key that many rows share has to be
sorted by one task.

Defined results: a null key is a key like any other (the word ``null``); rows that
repeat a key go to the same shard, in no fixed order among themselves; a null
text has size 8 and checksum 0; an empty table gives an empty result. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.session import checkpoint_root

SHARDS = 24
RANK_ROWS = 100_000
_DIGITS = 13  # hex digits of a draw: 52 bits


def _draw(key: Column, shard: Column) -> Column:
    """-ln(u) of a (key, shard) pair."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", key, shard.cast("string")).cast("binary")), 1, _DIGITS),
               16, 10).cast("double")
    return -F.log((h + 0.5) / float(1 << 4 * _DIGITS))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """{score, shard} of the winning shard for a string key."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.array_max(F.transform(
        F.sequence(F.lit(0), F.lit(len(weights) - 1)),
        lambda s: F.struct((F.element_at(w, s + 1) / _draw(key, s)).alias("score"), s.alias("shard"))))


def assign(docs: DataFrame, weights: list[float] | None = None, new_weight: float = 1.0,
           rank_rows: int = RANK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard); grown_shard is the
    shard once one more shard of weight ``new_weight`` has been added."""
    checkpoint_root(docs.sparkSession)
    weights = [1.0] * SHARDS if weights is None else list(weights)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce("text", F.lit(""))
    n = len(weights)
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key")) \
        .withColumn("best", rendezvous(F.col("key"), weights)) \
        .withColumn("fresh", F.lit(float(new_weight)) / _draw(F.col("key"), F.lit(n))) \
        .select("doc_id", "size", "text_crc32", F.col("best.shard").alias("shard"),
                F.when(F.col("fresh") > F.col("best.score"), F.lit(n)).otherwise(F.col("best.shard"))
                .alias("grown_shard"),
                F.md5(F.col("key").cast("binary")).alias("rank_key"),
                F.spark_partition_id().alias("part")).checkpoint()
    ranges = max(1, min(1 << 16, -(-rows.count() // (n * rank_rows))))
    counts = rows.groupBy("shard", "rank_key", "part").agg(F.count("*").alias("n")) \
        .withColumn("range", F.floor(F.conv(F.substring("rank_key", 1, 4), 16, 10).cast("long")
                                     * F.lit(ranges) / F.lit(1 << 16)))
    per = counts.groupBy("shard", "range").agg(F.sum("n").alias("total"))
    before = per.select("shard", "range", (F.sum("total").over(
        W.partitionBy("shard").orderBy("range")) - F.col("total")).alias("before"))
    within = F.sum("n").over(W.partitionBy("shard", "range").orderBy("rank_key", "part")
                             .rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    start = counts.withColumn("within", within).join(before, ["shard", "range"]) \
                  .select("shard", "rank_key", "part", (F.col("before") + F.col("within")).alias("start"))
    place = F.row_number().over(W.partitionBy("shard", "rank_key", "part").orderBy("text_crc32", "size"))
    return rows.withColumn("place", place).join(start, ["shard", "rank_key", "part"]) \
               .select("doc_id", "size", "text_crc32", "shard",
                       (F.col("start") + F.col("place") - 1).alias("slot"), "grown_shard")
