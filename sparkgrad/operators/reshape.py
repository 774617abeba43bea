"""Wide, long, array and grid forms of an image table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C

_WIDE = 64  # running sums per aggregate row


def to_long(images: DataFrame, *keys: str) -> DataFrame:
    """Array images to one row per pixel: keys, in, v."""
    return images.select(*keys, F.posexplode("x").alias("in", "v"))


def feature_rows(images: DataFrame, n_in: int, *keys: str) -> DataFrame:
    """One row per feature (keys, in, v) for a layer of ``n_in`` inputs.

    An image without features keeps one row with NULL in and v, so that it stays in the result; a surplus
    feature is an error.
    """
    checked = f"CASE WHEN size(x) > {n_in} THEN {C.too_wide(n_in)} ELSE x END"
    return images.selectExpr(*keys, f"posexplode_outer({checked}) AS (`in`, v)")


def unpivot_pixels(wide: DataFrame, keep: list[str], skip: tuple[str, ...] = ("id", "label")) -> DataFrame:
    """Wide pixel columns to rows (keep.., pixel, pixel_id, pixel_value), NULLs dropped.

    One generator over an array of the pixel columns: each wide row is read once and
    nothing is shuffled, whatever the number of columns. The pixel numbers are known
    from the column names, so no text is parsed per row. Columns with other names are left out.
    """
    pixels = [c for c in wide.columns if c not in keep and c not in skip and re.fullmatch(r"pixel\d+", c)]
    names = F.array(*[F.lit(c) for c in pixels])
    numbers = F.array(*[F.lit(int(c.lstrip("pixel"))) for c in pixels])
    values = F.array(*[F.col(c).cast("double") for c in pixels])
    return (
        wide.select(*keep, F.posexplode(values).alias("_at", "pixel_value"))
        .where(F.col("pixel_value").isNotNull())
        .select(*keep, names[F.col("_at")].alias("pixel"), "pixel_value", numbers[F.col("_at")].alias("pixel_id"))
    )


def pixel_number(name: Column) -> Column:
    """``pixel17`` to 17 for names that come as data: strips leading letters p, i, x, e, l."""
    return F.ltrim(name, F.lit("pixel")).cast("int")


def named_values(wide: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The chosen columns as rows (keep.., pixel, value), the column names as data."""
    pairs = F.array(*[F.struct(F.lit(c).alias("pixel"), F.col(c).cast("double").alias("value")) for c in columns])
    return wide.select(*keep, F.inline(pairs))


def pixels_only(named: DataFrame, others: tuple[str, ...]) -> DataFrame:
    """Rows whose name is none of ``others``, with the number in the name as ``pixel_id``."""
    # pixel_number fails on other names, and a filter alone is no promise about the order of evaluation
    number = F.when(~F.col("pixel").isin(*others), pixel_number(F.col("pixel")))
    return named.where(~F.col("pixel").isin(*others)).withColumn("pixel_id", number)


def widen(images: DataFrame, n_pixels: int) -> DataFrame:
    """Array images to the wide form id, label, pixel0 .. pixel{n-1}."""
    return images.select("id", "label", *[F.get("x", F.lit(i)).alias(f"pixel{i}") for i in range(n_pixels)])


def pack_features(wide: DataFrame, n_pixels: int) -> DataFrame:
    """Wide images to the array form: the pixel columns without id and label."""
    return wide.select("id", "label", F.array(*[F.col(f"pixel{i}").cast("double") for i in range(n_pixels)]).alias("x"))


def to_grid(images: DataFrame, side: int) -> DataFrame:
    """One row per picture cell: id, row, col, value."""
    at = F.col("in")
    return to_long(images.drop("label"), "id").select(
        "id",
        F.floor(at / F.lit(side)).cast("int").alias("row"),
        (at % F.lit(side)).cast("int").alias("col"),
        F.col("v").alias("value"),
    )


def rows_to_array(rows: DataFrame, keys: list[str], position: str, value: str, n: int, name: str) -> DataFrame:
    """Rows (keys, position, value) to one array of length ``n`` per key.

    Each position is its own running sum, so a key holds ``n`` numbers at any time,
    however many rows it has, and the sums start before the shuffle. Beyond ``_WIDE`` positions a key is summed in
    blocks of that many, so a row feeds one block's sums only.
    """
    if n > _WIDE:
        blocks = -(-n // _WIDE)
        part = rows.withColumn("_blk", F.floor(F.col(position) / _WIDE).cast("int")).withColumn("_at", F.col(position) % _WIDE)
        each = rows_to_array(part, [*keys, "_blk"], "_at", value, _WIDE, "_part").groupBy(*keys).agg(
            F.expr("map_from_entries(filter(collect_list(struct(_blk, _part)), one -> one._blk IS NOT NULL)) AS _parts"))
        none = f"array_repeat(CAST(NULL AS DOUBLE), {_WIDE})"
        whole = f"flatten(transform(sequence(0, {blocks - 1}), k -> coalesce(try_element_at(_parts, k), {none})))"
        return each.selectExpr(*[f"`{k}`" for k in keys], f"slice({whole}, 1, {n}) AS `{name}`")
    cells = [F.expr(f"sum(CASE WHEN `{position}` = {k} THEN `{value}` END) AS c{k}") for k in range(n)]
    return rows.groupBy(*keys).agg(*cells).selectExpr(*[f"`{k}`" for k in keys], f"array({', '.join(f'c{k}' for k in range(n))}) AS `{name}`")


def array_to_rows(df: DataFrame, keys: list[str], column: str, position: str, value: str) -> DataFrame:
    return df.select(*keys, F.posexplode(column).alias(position, value))


def pack_weights(weights: DataFrame, key: str = "out", position: str = "in", value: str = "w") -> DataFrame:
    """Weight rows to one ordered array per output (key, weights).

    The group is one neuron's inputs; the caller's layer shape bounds its length.
    """
    ordered = F.array_sort(F.collect_list(F.struct(position, value)))
    return weights.groupBy(key).agg(F.transform(ordered, lambda s: s[value]).alias("weights"))
