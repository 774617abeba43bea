"""Data-quality, accuracy, histogram and trajectory queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constraint_violations(log: DataFrame, key: str, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows (reason, id, value, n): repeated keys, and values outside their range.

    NULL passes a range, as it passes a CHECK.
    """
    def mark(code: int, value: Column, ok: Column) -> Column:
        return F.struct(F.lit(code).alias("code"), value.alias("value"), ok.alias("ok"))

    names = ["duplicate", *ranges]
    checks = F.array(mark(0, F.lit(None).cast("double"), F.lit(False)), *[
        mark(i, F.col(c).cast("double"), F.col(c).between(*ranges[c])) for i, c in enumerate(ranges, 1)])
    # each row marks its key and its values out of range: one scan and one grouped count for both, by a number in place of
    # the reason, so that the groups have keys of fixed width
    counted = (
        log.select(F.col(key).alias("id"), F.explode(checks).alias("_c")).where(~F.col("_c.ok"))
        .groupBy(F.col("_c.code").alias("code"), "id", F.col("_c.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("code <> 0 OR n > 1"))
    return counted.select(F.get(F.lit(names), F.col("code")).alias("reason"), "id", "value", "n")


def width_violations(images: DataFrame, n_in: int) -> DataFrame:
    """Rows (id, n_features) of images with more features than the network has inputs; scoring would fail on them."""
    return images.where(F.size("x") > n_in).select("id", F.size("x").alias("n_features"))


def preview(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows; no order is promised."""
    return df.limit(n)


def accuracy(log: DataFrame, *by: str) -> DataFrame:
    """Share of rows with label = prediction, per ``by``; a NULL prediction is wrong."""
    right = F.when(F.col("label") == F.col("prediction"), F.lit(1.0)).otherwise(F.lit(0.0))
    return log.groupBy(*by).agg(F.avg(right).alias("pct_right"), F.count(F.lit(1)).alias("n_images"))


def histogram(values: DataFrame, column: str, bins: int) -> DataFrame:
    """Frequency of values in [0, 1) by equal bins."""
    bucket = F.floor(F.col(column) * bins).cast("int")
    return values.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("total"))


def distinct_activations(hidden: DataFrame, columns: list[str]) -> DataFrame:
    return hidden.select(*columns).distinct()


def weight_name(net, layer: Column, out: Column, at: Column) -> Column:
    """W1, W2, ... by layer, then input, then output, as in the worked example."""
    first = at * net.n_hidden + out + 1
    second = F.lit(net.n_in * net.n_hidden) + at * net.n_out + out + 1
    return F.concat(F.lit("W"), F.when(layer == 1, first).otherwise(second).cast("string"))


def weight_trajectory(weight_log: DataFrame, net) -> DataFrame:
    """(iter, weight_name, updated_weight) of every weight over the iterations."""
    named = weight_name(net, F.col("layer"), F.col("out"), F.col("in"))
    return weight_log.where(F.col("in") >= 0).select("iter", named.alias("weight_name"), F.col("w").alias("updated_weight"))


def top_history(history: DataFrame, name: str, names: list[str], order: list[str], n: int) -> DataFrame:
    """Newest ``n`` rows of the chosen series."""
    return history.where(F.col(name).isin(*names)).orderBy(*[F.col(c).desc() for c in order]).limit(n)


def activation_trajectory(output_log: DataFrame) -> DataFrame:
    """(iter, hidden, hidden_value): mean activation of every hidden unit by iteration."""
    return output_log.select("iter", F.col("unit").alias("hidden"), F.col("value").alias("hidden_value"))


def prediction_trajectory(output_log: DataFrame) -> DataFrame:
    """(iter, output, predicted_value, actual_value) by iteration."""
    return output_log.select("iter", "output", "predicted_value", "actual_value")
