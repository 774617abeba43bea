"""Dense row numbers from 1, without sorting or passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkgrad.session import MAX_BROADCAST_PARAMS, materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row below


def assign_row_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Number the rows of a file scan 1..n in scan order.

    One pass counts rows per input split (the scan reads no columns), the split
    offsets are a running sum over as many rows as there are splits, and the rows
    pick up their offset by a join on the split number. No data row is shuffled.
    ``df`` must be a plain scan, so that both passes see the same splits; a plan with anything but projections and
    filters over one scan is refused.
    """
    if not _plain_scan(df._jdf.queryExecution().optimizedPlan()):
        raise ValueError("row ids in scan order need a plain scan; write the frame first, or use assign_row_ids_by")
    mid = F.monotonically_increasing_id()
    split = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    counts = (
        df.select(mid.alias("_mid")).select(split.alias("_split"))
        .groupBy("_split").agg(F.count(F.lit(1)).alias("_n"))
    )
    offsets = _offsets(counts, "_split")
    if df.rdd.getNumPartitions() <= MAX_BROADCAST_PARAMS:  # one row per split
        offsets = F.broadcast(offsets)
    return (
        df.withColumn("_mid", mid)
        .withColumn("_split", split)
        .join(offsets, "_split")
        .withColumn(name, F.col("_before") + F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + F.lit(1))
        .drop("_mid", "_split", "_before")
    )


def _plain_scan(node) -> bool:
    """Projections and filters by fixed expressions over one relation."""
    below = node.children()
    if below.size() == 0:
        return node.nodeName().startswith(("Relation", "LogicalRelation", "DataSourceV2", "Range", "LogicalRDD", "LocalRelation"))
    return below.size() == 1 and node.nodeName() in ("Project", "Filter") and node.deterministic() and _plain_scan(below.apply(0))


def assign_row_ids_by(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """Number the rows 1..n in the order of ``key``, NULL first.

    Rows are range-partitioned and sorted by (key, row number of the input), so a hot key spans several
    partitions. Each row is written with its partition and its place there; one count per partition
    gives the offsets, and the ids need no further shuffle. Ranks are exact whatever borders Spark samples.
    """
    mid, place = F.monotonically_increasing_id(), F.monotonically_increasing_id()
    dealt = df.withColumn("_tie", mid).repartitionByRange(F.col(key).asc_nulls_first(), F.col("_tie")).sortWithinPartitions(
        F.col(key).asc_nulls_first(), "_tie")
    placed = materialize(dealt.withColumn("_split", F.spark_partition_id()).withColumn(
        "_at", place.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))), "row-ids")
    counts = placed.groupBy("_split").agg(F.count(F.lit(1)).alias("_n"))
    return (
        placed.join(F.broadcast(_offsets(counts, "_split")), "_split")  # one row per shuffle partition
        .withColumn(name, F.col("_before") + F.col("_at") + F.lit(1))
        .drop("_tie", "_split", "_at", "_before")
    )


def _offsets(counts: DataFrame, key: str) -> DataFrame:
    # One row per split or bucket, so the running sum is over a short list.
    running = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
