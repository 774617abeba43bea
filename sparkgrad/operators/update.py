"""Keyed updates on immutable tables, and latest-row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C


_SPAN = str(1 << 64)
_LOWEST = str(1 - 10**38)


def order_key(df: DataFrame, order: list[str]) -> Column:
    """One number (a decimal) that orders rows by one or two whole-number or time columns, NULL first.

    A running maximum by a number has a buffer of fixed size, so it is a hash aggregate; by a struct Spark sorts.
    The first of two columns has to lie within 5 * 10**18 of zero, which all times do.
    """
    kinds, parts = dict(df.dtypes), []
    for name in order:
        if kinds[name] not in ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz"):
            raise ValueError(f"order column {name} is {kinds[name]}, not a whole number, date or time")
        number = {"timestamp": F.unix_micros, "timestamp_ntz": _wall_micros, "date": F.unix_date}.get(kinds[name], F.col)(name)
        parts.append(number.cast("decimal(38,0)"))
    if len(parts) > 2:
        raise ValueError("at most two order columns")
    lowest = F.lit(_LOWEST).cast("decimal(38,0)")
    if len(parts) == 1:
        return F.coalesce(parts[0], lowest)
    # the second column, counted from 0 = NULL up
    second = F.coalesce(parts[1] + F.lit(str((1 << 63) + 1)).cast("decimal(20,0)"), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")
    return (F.coalesce((parts[0] * F.lit(_SPAN).cast("decimal(20,0)")).cast("decimal(38,0)"), lowest) + second).cast("decimal(38,0)")


def _wall_micros(name: str) -> Column:
    """Microseconds of a time without zone; a cast to a time with zone would fold the hours of a clock change."""
    time = F.hour(name) * 3600 + F.minute(name) * 60
    return F.unix_date(F.col(name).cast("date")).cast("long") * 86_400_000_000 + time.cast("long") * 1_000_000 + (
        F.extract(F.lit("SECOND"), F.col(name)) * 1_000_000).cast("long")


def one_per_key(source: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Reduce an update source to the last row per key by ``order``; a partial hash aggregate."""
    return latest_per_key(source, keys, order, [value])


def update_from(target: DataFrame, source: DataFrame, keys: list[str], column: str, value: str) -> DataFrame:
    """Next version of ``target`` with ``column`` taken from matching ``source`` rows.

    ``source`` must hold each key once (see ``one_per_key``); rows without a match
    keep their value. Whether the source is broadcast is left to the measured sizes.
    """
    new = source.select(*keys, F.col(value).alias("_new"), F.lit(True).alias("_hit"))
    joined = target.join(new, keys, "left")
    kept = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return joined.select(*[kept.alias(c) if c == column else F.col(c) for c in target.columns])


def checked_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """Reject an update source with a repeated key."""
    repeated = source.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if repeated:
        raise ValueError(f"update source repeats a key of {keys}")
    return source


def sgd_update(params: DataFrame, gradients: DataFrame, lr: str | float, *, by: list[str] | None = None,
               clip: str | float | None = None, clip_layers: tuple[int, ...] = (1, 2),
               update_bias: bool = True, small: bool = False) -> DataFrame:
    """w - lr * g per parameter row; parameters without a gradient stay as they are.

    ``small`` says that the caller has checked the parameter count against the
    broadcast limit.
    """
    keys = [*(by or []), "layer", "out", "in"]
    rate = lr if isinstance(lr, str) else f"{float(lr)!r}D"
    limited = "g" if clip is None else (
        f"CASE WHEN layer IN ({', '.join(map(str, clip_layers))}) THEN {C.clip('g', clip)} ELSE g END")
    moved = f"w - {rate} * coalesce({limited}, 0D)"
    if not update_bias:
        moved = f"CASE WHEN `in` >= 0 THEN {moved} ELSE w END"
    g = gradients.select(*keys, "g")
    return params.join(F.broadcast(g) if small else g, keys, "left").withColumn("w", F.expr(moved)).select(*params.columns)


def array_update(packed: DataFrame, gradients: DataFrame, key: str, lr: float) -> DataFrame:
    """weights - lr * gradient elementwise on packed rows (key, weights), (key, gradient)."""
    joined = packed.join(gradients, key, "left")
    moved = F.zip_with("weights", "gradient", lambda w, g: w - F.lit(lr) * g)
    return joined.select(key, F.coalesce(moved, F.col("weights")).alias("weights"))


def latest_n(log: DataFrame, order: list[str], n: int) -> DataFrame:
    """The ``n`` newest rows; each task keeps only its own top ``n``."""
    return log.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def latest_per_key(log: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Newest values per key: a running maximum per value, no sort for values of fixed size.

    ``order`` has to tell the rows of a key apart, so that all values come from one row.
    """
    by = log.withColumn("_order", order_key(log, order))
    return by.groupBy(*keys).agg(*[F.max_by(v, "_order").alias(v) for v in values])
