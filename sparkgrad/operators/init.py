"""Grids and initial parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.functions.keyed_random import keyed_uniform
from sparkgrad.sources.schemas import BIAS_KEY


def grid(spark: SparkSession, n_out: int, n_in: int) -> DataFrame:
    """All (out, in) pairs of a layer from one range; no recursion, no join."""
    cell = F.col("id")
    return spark.range(n_out * n_in).select(
        F.floor(cell / F.lit(n_in)).cast("int").alias("out"), (cell % F.lit(n_in)).cast("int").alias("in")
    )


def uniform_init(cells: DataFrame, seed: int) -> DataFrame:
    """w = U[0, 1)."""
    return cells.withColumn("w", keyed_uniform(seed, "out", "in"))


def small_init(cells: DataFrame, seed: int) -> DataFrame:
    """w = U[0, 1) * 0.01."""
    return cells.withColumn("w", keyed_uniform(seed, "out", "in") * F.lit(0.01))


def he_init(cells: DataFrame, seed: int, fan_in: int | None = None) -> DataFrame:
    """w = (2U - 1) * sqrt(6 / fan_in), from a literal or the grid's ``fan_in``."""
    inputs = F.lit(float(fan_in)) if fan_in else F.col("fan_in").cast("double")
    return cells.withColumn("w", (keyed_uniform(seed, "out", "in") * 2.0 - 1.0) * F.sqrt(F.lit(6.0) / inputs))


def zero_bias(outs: DataFrame) -> DataFrame:
    return outs.select("out", F.lit(0.0).alias("b"))


def he_params(spark: SparkSession, net, seed: int = 7) -> DataFrame:
    """He weights and zero biases of a whole network as parameter rows."""
    parts = []
    for layer in (1, 2):
        n_in, n_out = net.width(layer)
        weights = he_init(grid(spark, n_out, n_in), seed + layer, n_in)
        parts.append(weights.select(F.lit(layer).alias("layer"), "out", "in", "w"))
        parts.append(_bias_rows(spark, layer, n_out, F.lit(0.0)))
    return _union(parts)


# Multipliers of the deterministic weights shared with the SQL checks.
_PATTERN = {1: (7919, 104729), 2: (6947, 15485)}


def pattern_params(spark: SparkSession, net) -> DataFrame:
    """Deterministic He-scaled parameters: same numbers in Spark and in plain SQL."""
    parts = []
    for layer in (1, 2):
        n_in, n_out = net.width(layer)
        by_out, by_in = _PATTERN[layer]
        whole = (F.col("out").cast("long") * by_out + F.col("in").cast("long") * by_in) % 1000
        w = (whole.cast("double") / 1000.0 * 2.0 - 1.0) * F.sqrt(F.lit(6.0) / F.lit(float(n_in)))
        parts.append(grid(spark, n_out, n_in).select(F.lit(layer).alias("layer"), "out", "in", w.alias("w")))
        parts.append(_bias_rows(spark, layer, n_out, F.col("id").cast("double") * 0.01))
    return _union(parts)


def literal_params(spark: SparkSession, w1, b1, w2, b2) -> DataFrame:
    """Parameter rows from literal seed values (lists indexed [out][in])."""
    rows = []
    for layer, weights, bias in ((1, w1, b1), (2, w2, b2)):
        for out, row in enumerate(weights):
            rows += [(layer, out, i, float(w)) for i, w in enumerate(row)]
        rows += [(layer, out, BIAS_KEY, float(b)) for out, b in enumerate(bias)]
    return spark.createDataFrame(rows, "layer int, out int, `in` int, w double")


def _bias_rows(spark, layer, n_out, value):
    return spark.range(n_out).select(
        F.lit(layer).alias("layer"), F.col("id").cast("int").alias("out"), F.lit(BIAS_KEY).alias("in"), value.alias("w")
    )


def _union(parts):
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return frame
