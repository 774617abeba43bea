"""Gradients of all parameters from one scan of the images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C

_WIDE = 64  # running sums per aggregate row


def delta_body(net, delta: str = "sq2", label: str = "label", target: str = "target", back: str = "m.w2t") -> str:
    """Struct (x, a, p, d2, e, d1) over xs, hs, ps: output delta, hidden error, hidden delta.

    Softmax output: ``sq2`` is 2(p - y), ``half`` is p - y, y one-hot of ``label``.
    Sigmoid output: (p - t) p (1 - p) with ``target`` t. Hidden ReLU passes the error
    where the unit is active, hidden sigmoid scales it by a (1 - a). ``back`` holds the
    output weights by hidden unit that carry the error back.
    """
    if net.output == "softmax":
        d2 = C.one_hot_error("ps", label)
        if delta == "sq2":
            d2 = f"transform({d2}, one -> one * 2D)"
    else:
        d2 = f"zip_with(ps, {target}, (o, t) -> (o - t) * o * (1D - o))"
    slope = "CASE WHEN h > 0D THEN err ELSE 0D END" if net.hidden == "relu" else "h * (1D - h) * err"
    struct = ("named_struct('x', xs, 'a', hs, 'p', ps, 'd2', d2s, 'e', errs, "
              f"'d1', zip_with(hs, errs, (h, err) -> {slope}))")
    return C.let(d2, "d2s", C.let(f"transform({back}, unit -> {C.dot('unit', 'd2s')})", "errs", struct))


def gradient_sums(deltas: DataFrame, net, by: list[str] | None = None, mask_hidden_bias: bool = True) -> DataFrame:
    """Sums over images of delta * input: rows (by, layer, out, in, g_sum, n).

    Both layers' inputs form one array per image, each led by the constant 1 of the
    bias; one generator walks it and every input position feeds the running sums of
    its layer's deltas. A task shuffles one partial row per position, however many
    images it has read.
    """
    by = by or []
    width = max(net.n_hidden, net.n_out)
    blocks, cols = -(-width // _WIDE), min(width, _WIDE)
    rows = deltas.selectExpr(*by, "d1", "d2", "e", "posexplode(concat(array(1D), x, array(1D), a)) AS (pos, v)")
    first = "d1" if mask_hidden_bias else "CASE WHEN pos = 0 THEN e ELSE d1 END"
    # One short expression per sum: long generated methods are not compiled by the JIT.
    rows = rows.selectExpr(*by, "pos", "v", f"CASE WHEN pos <= {net.n_in} THEN {first} ELSE d2 END AS d")
    if blocks > 1:
        rows = rows.selectExpr("*", f"explode(sequence(0, {blocks - 1})) AS blk")
    at = [f"blk * {_WIDE} + {k}" if blocks > 1 else str(k) for k in range(cols)]
    sums = [F.expr(f"sum(v * get(d, {i})) AS s{k}") for k, i in enumerate(at)]
    grouped = rows.groupBy(*by, "pos", *(["blk"] if blocks > 1 else [])).agg(*sums, F.count(F.lit(1)).alias("n"))
    flat = grouped.selectExpr(
        *by, "n", "pos", *(["blk"] if blocks > 1 else []),
        f"posexplode(array({', '.join(f's{k}' for k in range(cols))})) AS (k, g_sum)")
    out = f"blk * {_WIDE} + k" if blocks > 1 else "k"
    return flat.selectExpr(
        *by, f"CASE WHEN pos <= {net.n_in} THEN 1 ELSE 2 END AS layer", f"{out} AS out",
        f"CASE WHEN pos <= {net.n_in} THEN pos - 1 ELSE pos - {net.n_in + 2} END AS `in`", "g_sum", "n",
    ).where(f"out < CASE WHEN layer = 1 THEN {net.n_hidden} ELSE {net.n_out} END")


def mean_gradients(sums: DataFrame, by: list[str] | None = None) -> DataFrame:
    return sums.selectExpr(*(by or []), "layer", "out", "`in`", "g_sum / n AS g")


def output_weight_gradient(deltas: DataFrame, net) -> DataFrame:
    """g[output, hidden] = mean over images of delta[output] * a[hidden]."""
    return _mean_products(deltas.selectExpr("d2", "posexplode(a) AS (hidden, v)"), "d2", "hidden", "output", net.n_out)


def hidden_error(deltas: DataFrame) -> DataFrame:
    """(id, hidden, error) with error = sum_k delta[k] w2[k, hidden]."""
    return deltas.selectExpr("id", "posexplode(e) AS (hidden, error)")


def hidden_weight_gradient(deltas: DataFrame, net) -> DataFrame:
    """g[hidden, input] = mean over images of the masked hidden error times the input."""
    return _mean_products(deltas.selectExpr("d1", "posexplode(x) AS (input, v)"), "d1", "input", "hidden", net.n_hidden)


def _mean_products(rows: DataFrame, delta: str, key: str, out: str, n_out: int) -> DataFrame:
    blocks, cols = -(-n_out // _WIDE), min(n_out, _WIDE)
    rows = rows.selectExpr("*", f"explode(sequence(0, {blocks - 1})) AS blk")
    sums = rows.groupBy(key, "blk").agg(*[
        F.expr(f"avg(v * get({delta}, blk * {_WIDE} + {k})) AS s{k}") for k in range(cols)])
    flat = sums.selectExpr(key, "blk", f"posexplode(array({', '.join(f's{k}' for k in range(cols))})) AS (k, gradient)")
    return flat.selectExpr(f"blk * {_WIDE} + k AS {out}", key, "gradient").where(f"{out} < {n_out}")
