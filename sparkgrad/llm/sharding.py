"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a score from a hash; the key goes to the shard with the highest
score. A new shard can only win keys for itself, so growing from n to n + 1 shards moves
about 1 / (n + 1) of the rows, and all of them into the new shard. Built-in expressions only.

Slots number the rows of a shard without gaps. The rows of a shard are dealt over
``buckets`` by a hash of the row; a slot is the bucket's start in its shard plus the rank in
the bucket, so no task ever holds a whole shard. The starts are one row per (shard, bucket):
their number depends on the two parameters alone, not on the data.

Defined results: a NULL key is a key like any other; equal keys go to one shard, and their
rows are still spread over buckets by size and checksum; a NULL or empty text has size 16 and checksum 0;
rows equal in all of key, size and checksum get consecutive slots; an empty table gives an
empty result; columns of the input other than key and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkgrad.llm.text import read, unit

OVERHEAD = 16
SHARDS = 40
BUCKETS = 256


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Struct (score, shard) of the winning shard. Score: -ln(u) / weight, the smallest wins."""
    if not weights or any(not (w > 0 and math.isfinite(w)) for w in weights):
        raise ValueError("every shard needs a positive finite weight")
    table = F.array(*[F.lit(float(w)) for w in weights])
    return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda s: F.struct(
        (-F.ln(unit(F.lit("shard"), key, s)) / F.get(table, s)).alias("score"), s.alias("shard"))))


def shard(docs: DataFrame, weights: list[float], added_weight: float = 1.0, key: str = "doc_id",
          text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard."""
    filled = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = len(weights)
    rows = docs.select(
        F.col(key), (F.octet_length(filled) + OVERHEAD).cast("long").alias("size"),
        F.crc32(filled.cast("binary")).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("won"),
        (-F.ln(unit(F.lit("shard"), F.col(key), F.lit(n))) / F.lit(float(added_weight))).alias("added"),
    ).select(
        key, "size", "text_crc32", F.col("won.shard").alias("shard"),
        F.when(F.col("added") < F.col("won.score"), F.lit(n)).otherwise(F.col("won.shard")).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(key), "size", "text_crc32"), F.lit(buckets)).cast("int").alias("bucket"))
    starts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(
            Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(key, "size", "text_crc32"))
    return (rows.withColumn("rank", rank)
            .join(F.broadcast(starts), ["shard", "bucket"])  # at most shards x buckets rows
            .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("rank") - 1).alias("slot"), "grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), [1.0] * SHARDS)
