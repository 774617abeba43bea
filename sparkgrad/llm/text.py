"""Column helpers shared by the text operators. Everything here is a built-in expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` names it often."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words between ASCII white space, in order; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unit(*parts: Column) -> Column:
    """A hash of the parts as a number in (0, 1): the same in every run and on every retry."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / F.lit(float(1 << 52))
