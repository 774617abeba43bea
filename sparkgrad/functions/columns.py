"""Activations, losses and array algebra as Spark SQL expressions.

Helpers take and return expression text: one ``F.expr`` call hands a whole layer to
the JVM parser, where building the same tree lambda by lambda from Python costs
seconds of driver time per plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def let(value: str, name: str, body: str) -> str:
    """Bind ``value`` to ``name`` once and use it many times in ``body``.

    A lambda variable is evaluated once per row; the same expression repeated inside
    another lambda would be evaluated again for each array element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def relu(z: str) -> str:
    return f"CASE WHEN {z} < 0D THEN 0D ELSE {z} END"


def sigmoid(z: str) -> str:
    return f"1D / (1D + exp(-({z})))"


def clip(g: str, bound: str | float) -> str:
    """Limit to [-bound, bound]; NULL gradients and NULL bounds pass unchanged."""
    b = bound if isinstance(bound, str) else f"{float(bound)!r}D"
    return f"CASE WHEN {g} > {b} THEN {b} WHEN {g} < -{b} THEN -{b} ELSE {g} END"


def total(values: str) -> str:
    return f"aggregate({values}, 0D, (acc, item) -> acc + item)"


def dot(left: str, right: str) -> str:
    return total(f"zip_with({left}, {right}, (lv, rv) -> lv * rv)")


def softmax(z: str) -> str:
    """Shifted by the maximum, so large inputs stay finite."""
    shares = let(total("es"), "whole", "transform(es, one -> one / whole)")
    return let(z, "zs", let("array_max(zs)", "top", let("transform(zs, one -> exp(one - top))", "es", shares)))


def dense(weights: str, bias: str, x: str) -> str:
    """Pre-activations of one layer; ``weights`` is an array of rows, one per output."""
    return f"zip_with({weights}, {bias}, (row, b) -> {dot('row', x)} + b)"


def activation(kind: str, z: str) -> str:
    """``linear`` leaves the values as they are: the logits of a softmax net."""
    if kind == "softmax":
        return softmax(z)
    if kind == "linear":
        return z
    return f"transform({z}, one -> {relu('one') if kind == 'relu' else sigmoid('one')})"


def too_wide(n: int) -> str:
    return f"raise_error('an image has more than the {n} features of the network')"


def fit_length(x: str, n: int) -> str:
    """NULL and missing features count as 0 (a SUM skips them); a surplus one is an error in every form."""
    exact = (f"CASE WHEN size({x}) = {n} THEN {x} WHEN size({x}) > {n} THEN {too_wide(n)} "
             f"ELSE concat({x}, array_repeat(0D, {n} - size({x}))) END")
    return f"transform({exact}, one -> coalesce(one, 0D))"


def has_value(x: str) -> str:
    return f"exists({x}, one -> one IS NOT NULL)"


def argmax(p: str) -> str:
    """Position of the largest entry from 0; ties go to the lowest position."""
    return f"CAST(array_position({p}, array_max({p})) - 1 AS INT)"


def one_hot_error(p: str, label: str) -> str:
    """p - y with y the one-hot form of ``label``."""
    return f"transform({p}, (one, k) -> CASE WHEN k = {label} THEN one - 1D ELSE one END)"


def register_sql_functions(spark: SparkSession) -> None:
    """``sg_relu(x)`` and ``sg_softmax(xs)`` for use in Spark SQL text."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION sg_relu(x DOUBLE) RETURNS DOUBLE RETURN {relu('x')}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sg_softmax(xs ARRAY<DOUBLE>) "
        f"RETURNS ARRAY<DOUBLE> RETURN {softmax('xs')}")
