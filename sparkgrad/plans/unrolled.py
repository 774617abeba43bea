"""Small networks as plain column arithmetic.

With few parameters every unit is its own column and every weight a literal, so the
whole network compiles into the scan's generated code: no lambdas, no Python worker,
no join. Several models (the variants of a sweep) can share one scan.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C
from sparkgrad.sources.schemas import BIAS_KEY

# Over all models of a scan. Beyond this the generated method outgrows the 8,000
# bytecodes the JVM still compiles, and a step gets slower than the block form
# (138 parameters: over 30 s per step on 600,000 rows, block 3 s).
MAX_UNROLLED_PARAMS = 64

_SLOTS = 64

def literal(value: float) -> str:
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"


def unit_columns(images: DataFrame, net, models: dict[str, dict[str, np.ndarray]]) -> DataFrame:
    """Columns x0.., and per model prefix m: {m}a0.. and {m}p0... Missing features count as 0, surplus ones are an error."""
    keys = [c for c in images.columns if c != "x"]
    known = f"CASE WHEN size(x) > {net.n_in} THEN {C.too_wide(net.n_in)} ELSE {C.has_value('x')} END"
    df = images.selectExpr(*keys, f"coalesce({known}, false) AS known",
                           *[f"coalesce(get(x, {i}), 0D) AS x{i}" for i in range(net.n_in)])
    df = _add(df, [_unit(net.hidden, w["w1"][j], w["b1"][j], "x", f"{m}a{j}")
                   for m, w in models.items() for j in range(net.n_hidden)])
    kind, out = ("linear", "z") if net.output == "softmax" else (net.output, "p")
    df = _add(df, [_unit(kind, w["w2"][k], w["b2"][k], f"{m}a", f"{m}{out}{k}")
                   for m, w in models.items() for k in range(net.n_out)])
    if net.output == "softmax":
        ks = range(net.n_out)
        top = "greatest" if net.n_out > 1 else ""
        df = _add(df, [f"{top}({', '.join(f'{m}z{k}' for k in ks)}) AS {m}top" for m in models])
        df = _add(df, [f"exp({m}z{k} - {m}top) AS {m}e{k}" for m in models for k in ks])
        df = _add(df, [f"{' + '.join(f'{m}e{k}' for k in ks)} AS {m}total" for m in models])
        df = _add(df, [f"{m}e{k} / {m}total AS {m}p{k}" for m in models for k in ks])
    return df


def score_unrolled(images: DataFrame, state) -> DataFrame:
    """(id, label, a, p) in generated code; map-only."""
    net = state.net
    df = unit_columns(images.select("id", "label", "x"), net, {"m": state.arrays()})

    def packed(prefix: str, n: int) -> str:
        units = ", ".join(f"{prefix}{i}" for i in range(n))
        return f"CASE WHEN known THEN array({units}) ELSE array_repeat(CAST(NULL AS DOUBLE), {n}) END"

    return df.selectExpr("id", "label", f"{packed('ma', net.n_hidden)} AS a", f"{packed('mp', net.n_out)} AS p")


def unrolled_sums(images: DataFrame, net, models: dict[str, dict[str, np.ndarray]],
                  targets: dict[str, tuple[float, ...]] | None = None, delta: str = "sq2",
                  mask_hidden_bias: bool = True) -> DataFrame:
    """Gradient sums of all models in one scan: rows (model, layer, out, in, g_sum, n).

    Each parameter is one running sum, so a task sends one row through the shuffle. The
    rows meet in a fixed number of groups before the last addition.
    """
    js, ks = range(net.n_hidden), range(net.n_out)
    df = unit_columns(images.select("label", "x"), net, models).where("known")
    if net.output == "softmax":
        twice = "2D * " if delta == "sq2" else ""
        d2 = [f"{twice}({m}p{k} - CASE WHEN label <=> {k} THEN 1D ELSE 0D END) AS {m}d{k}" for m in models for k in ks]
    else:
        d2 = [f"({m}p{k} - {literal(targets[m][k])}) * {m}p{k} * (1D - {m}p{k}) AS {m}d{k}" for m in models for k in ks]
    df = _add(df, d2)
    df = _add(df, [f"{_weighted(w['w2'][:, j], f'{m}d')} AS {m}err{j}" for m, w in models.items() for j in js])
    slope = "CASE WHEN {m}a{j} > 0D THEN {m}err{j} ELSE 0D END" if net.hidden == "relu" else "{m}a{j} * (1D - {m}a{j}) * {m}err{j}"
    df = _add(df, [f"{slope.format(m=m, j=j)} AS {m}h{j}" for m in models for j in js])

    sums, cells = [], []
    for m in models:
        for layer, outs, n_in, d, v in ((1, js, net.n_in, f"{m}h", "x"), (2, ks, net.n_hidden, f"{m}d", f"{m}a")):
            for out in outs:
                for at in range(BIAS_KEY, n_in):
                    term = f"{d}{out} * {v}{at}"
                    if at == BIAS_KEY:
                        term = f"{m}err{out}" if layer == 1 and not mask_hidden_bias else f"{d}{out}"
                    cells.append(f"struct('{m}' AS model, {layer} AS layer, {out} AS out, {at} AS `in`, s{len(sums)} AS g_sum)")
                    sums.append(f"sum({term}) AS s{len(sums)}")
    grouped = df.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(_SLOTS))).groupBy("slot").agg(
        *[F.expr(s) for s in sums], F.count(F.lit(1)).alias("n"))
    whole = grouped.agg(*[F.expr(f"sum(s{i}) AS s{i}") for i in range(len(sums))], F.sum("n").alias("n"))
    return whole.where("n > 0").selectExpr("n", f"inline(array({', '.join(cells)}))").select(
        "model", "layer", "out", "in", "g_sum", "n")


def _add(df: DataFrame, expressions: list[str]) -> DataFrame:
    return df.selectExpr("*", *expressions)


def _weighted(weights: np.ndarray, prefix: str) -> str:
    return reduce(lambda a, b: f"{a} + {b}", [f"{literal(w)} * {prefix}{i}" for i, w in enumerate(weights)])


def _unit(kind: str, weights: np.ndarray, bias: float, prefix: str, name: str) -> str:
    z = f"({_weighted(weights, prefix)} + {literal(bias)})"
    body = {"relu": f"greatest({z}, 0D)", "sigmoid": C.sigmoid(z), "linear": z}[kind]
    return f"{body} AS {name}"
