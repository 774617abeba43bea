"""Errors, output deltas and losses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C


def output_delta(scored: DataFrame) -> DataFrame:
    """(id, label, p[]) to rows (id, output, p, squared_error, delta = 2(p - y))."""
    rows = scored.select("id", "label", F.posexplode("p").alias("output", "p"))
    error = F.col("p") - F.when(F.col("output") == F.col("label"), F.lit(1.0)).otherwise(F.lit(0.0))
    return rows.withColumn("_e", error).select(
        "id", "output", "p", F.pow("_e", F.lit(2.0)).alias("squared_error"), (F.col("_e") * 2.0).alias("delta"))


def half_squared_gradient(acts: DataFrame) -> DataFrame:
    """Half squared error with the aligned ReLU gradient: hidden unit k meets output k.

    Rows (id, output, squared_error, error, relu_grad, gradient).
    """
    rows = acts.select("id", "label", "a", F.posexplode("p").alias("output", "p")).withColumn(
        "h", F.get("a", F.col("output")))
    error = F.col("p") - F.when(F.col("output") == F.col("label"), F.lit(1.0)).otherwise(F.lit(0.0))
    slope = F.when(F.col("h") == 0, F.lit(0)).otherwise(F.lit(1))
    return rows.withColumn("error", error).withColumn("relu_grad", slope).select(
        "id", "output", (F.lit(0.5) * F.pow("error", F.lit(2.0))).alias("squared_error"), "error", "relu_grad",
        (F.col("error") * F.col("relu_grad") * F.col("h")).alias("gradient"))


def cross_entropy(logits: DataFrame) -> DataFrame:
    """Mean of -ln p[label] from the inputs ``z`` of the softmax; one row.

    ln(sum(exp(z))) - z[label], shifted by the maximum: finite also where the share of the label underflows
    to 0. Rows without a label, or with an unknown image, are left out.
    """
    total = C.let("array_max(z)", "top", f"top + ln({C.total('transform(z, one -> exp(one - top))')})")
    return logits.selectExpr(f"{total} - get(z, label) AS loss").agg(F.avg("loss").alias("cross_entropy_loss"))
