"""Layers over one row per (key, input): join with the weights, grouped sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C
from sparkgrad.operators.reshape import rows_to_array
from sparkgrad.session import MAX_BROADCAST_PARAMS

_WIDE = 64  # running sums per aggregate row


def dense_rows(
    x: DataFrame,
    weights: DataFrame,
    biases: DataFrame,
    *,
    keys: list[str],
    n_weights: int,
    join_key: str = "in",
    salts: int = 16,
    broadcast_limit: int = MAX_BROADCAST_PARAMS,
    n_out: int | None = None,
) -> DataFrame:
    """z[key, out] = sum_in w[out, in] * v[key, in] + b[out], one row per output.

    ``x`` has (keys, in, v), ``weights`` (out, in, w), ``biases`` (out, b).
    ``n_weights`` is the layer's size; within the limit the weights are broadcast,
    beyond it both sides are shuffled on (in, salt) and merged: an input number is shared by all
    images, so its rows are dealt over ``salts`` partitions row by row, also those of one
    hot key. The biases (``n_out`` rows) are broadcast if they are within the limit. Sums start before
    the shuffle in both cases. A left join keeps keys whose inputs match no weight.
    ``join_key="out"`` matches the activation of unit *o* with the weights of output *o*.
    """
    w = weights.withColumn("_match", F.col(join_key)).select("_match", "out", "w")
    left = x.withColumnRenamed("in", "_match")
    if n_weights <= broadcast_limit:
        joined = left.join(F.broadcast(w), "_match", "left")
    else:
        spread = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        copies = w.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = spread.join(copies.hint("merge"), ["_match", "_salt"], "left")
    sums = joined.groupBy(*keys, "out").agg(F.sum(F.col("w") * F.col("v")).alias("_s"))
    few = n_weights <= broadcast_limit or n_out is not None and n_out <= MAX_BROADCAST_PARAMS
    b = F.broadcast(biases) if few else biases
    return sums.join(b, "out", "left").select(*keys, "out", (F.col("_s") + F.col("b")).alias("z"))


def dense_packed(
    x: DataFrame,
    weights: DataFrame,
    biases: DataFrame,
    *,
    keys: list[str],
    n_in: int,
    n_out: int,
    name: str = "z",
    broadcast_limit: int = MAX_BROADCAST_PARAMS,
) -> DataFrame:
    """The same layer with all outputs of a key as one array column.

    The weights are packed per input, so an input row meets one weight row and feeds
    ``n_out`` running sums; (keys, in) rows are never multiplied by ``n_out``. A frame
    that is already partitioned by ``keys`` is aggregated without another shuffle.
    Wide or oversized layers go through ``dense_rows``.
    """
    if n_out > _WIDE or n_in * n_out > broadcast_limit:
        z = dense_rows(x, weights, biases, keys=keys, n_weights=n_in * n_out, broadcast_limit=broadcast_limit,
                       n_out=n_out)
        return rows_to_array(z, keys, "out", "z", n_out, name)
    per_input = rows_to_array(weights, ["in"], "out", "w", n_out, "_w")
    per_layer = rows_to_array(biases.withColumn("_one", F.lit(1)), ["_one"], "out", "b", n_out, "_b").select("_b")
    joined = x.join(F.broadcast(per_input), "in", "left")
    sums = joined.groupBy(*keys).agg(*[F.expr(f"sum(v * _w[{k}]) AS s{k}") for k in range(n_out)])
    with_bias = sums.withColumn("_b", per_layer.scalar())
    return with_bias.selectExpr(*keys, f"array({', '.join(f's{k} + _b[{k}]' for k in range(n_out))}) AS {name}")


def relu_rows(z: DataFrame, keys: list[str]) -> DataFrame:
    return z.selectExpr(*keys, "out", f"{C.relu('z')} AS a")


def sigmoid_rows(z: DataFrame, keys: list[str]) -> DataFrame:
    return z.selectExpr(*keys, "out", f"{C.sigmoid('z')} AS a")


def softmax_rows(z: DataFrame, keys: list[str], n_out: int) -> DataFrame:
    """Rows (keys, out, z) to (keys, out, e, total, p).

    MAX and SUM over the outputs of a key run on an array of ``n_out`` values that
    is built by running sums, in place of a window that would sort every key's rows.
    """
    packed = rows_to_array(z, keys, "out", "z", n_out, "zs")
    shifted = packed.selectExpr(*keys, f"{C.let('array_max(zs)', 'top', 'transform(zs, one -> exp(one - top))')} AS es")
    rows = shifted.selectExpr(*keys, f"{C.total('es')} AS total", "es").selectExpr(
        *keys, "total", "posexplode(es) AS (out, e)")
    return rows.selectExpr(*keys, "out", "e", "total", "e / total AS p")


_BAND = 64.0  # exp of a value within its band stays below 1e28


def softmax_rows_mergeable(z: DataFrame, keys: list[str]) -> DataFrame:
    """The softmax of ``softmax_rows`` for layers too wide for an array: no array, no window, rows (keys, out, z, p).

    The denominator is a sum that partial aggregates can merge without knowing the maximum: values are summed as
    ``exp(z - 64 b)`` per band ``b = floor(z / 64)``, and the bands of a key, a handful, are then scaled to its
    highest one. Bands far below it vanish, as their shares do in doubles, so no value overflows. A NULL ``z`` has
    no share, minus infinity has the share 0; other values have to be finite. NULL keys are a group of their own.
    """
    band = f"floor(z / {_BAND}D)"
    bands = z.where("z > double('-infinity')").selectExpr(*keys, f"{band} AS _b", "z").groupBy(*keys, "_b").agg(
        F.expr(f"sum(exp(z - {_BAND}D * _b))").alias("_s"))
    # one row per key and band from here to the totals
    top = bands.groupBy(*keys).agg(F.max("_b").alias("_top"))
    scaled = _same_keys(bands, top, keys).groupBy(*keys, "_top").agg(
        F.expr(f"sum(_s * exp({_BAND}D * (_b - _top)))").alias("_total"))
    return _same_keys(z, scaled, keys).withColumn(
        "p", F.expr(f"exp(z - {_BAND}D * _top) / _total")).drop("_top", "_total")


def _same_keys(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their key's row, if any; a NULL key equals a NULL key."""
    named = per_key.withColumnsRenamed({c: f"_key_{c}" for c in keys})
    same = [rows[c].eqNullSafe(named[f"_key_{c}"]) for c in keys]
    return rows.join(named, same, "left").drop(*[f"_key_{c}" for c in keys])


def argmax_rows(p: DataFrame, keys: list[str], n_out: int) -> DataFrame:
    """Output with the highest share per key; ties go to the lowest output, without any share it is NULL."""
    return rows_to_array(p, keys, "out", "p", n_out, "_p").selectExpr(*keys, f"{C.argmax('_p')} AS prediction")


def ratio_to_report(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Each row's share of the total and the maximum of its group.

    ``value / SUM(value) OVER (PARTITION BY by)`` without moving the rows of a group
    to one task: totals are aggregated first and joined back. Without ``by`` they are
    one row, read as a scalar subquery. With ``by`` Spark broadcasts the totals when
    it measures them as small, and splits skewed keys otherwise.
    """
    aggs = [F.max(value).alias("max_value"), F.sum(value).alias("total_value")]
    if by:
        sums = df.groupBy(*by).agg(*aggs).withColumnsRenamed({c: f"_{c}" for c in by})
        same = [df[c].eqNullSafe(sums[f"_{c}"]) for c in by]  # NULL is a group of its own
        with_totals = df.join(sums, same).drop(*[f"_{c}" for c in by])
    else:
        totals = df.agg(*aggs).select(F.struct("max_value", "total_value").alias("_t"))
        with_totals = df.withColumn("_t", totals.scalar()).select("*", "_t.*").drop("_t")
    return with_totals.withColumn("ratio", F.col(value) / F.col("total_value"))
