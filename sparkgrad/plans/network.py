"""Network shape, parameter state and the forward pass.

Four physical forms of the same layers:

* ``columns`` - every unit a column, every weight a literal, all generated code;
  for networks of a few dozen parameters;
* ``block``   - one NumPy matrix product per Arrow batch, map-only; the default;
* ``array``   - array expressions, map-only, no Python worker, but interpreted;
* ``long``    - one row per pixel, join with the weights and grouped sums; one shuffle
  by image id. The form for inputs that already are long rows, and for parameter sets
  too large to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C
from sparkgrad.operators import init
from sparkgrad.plans.unrolled import MAX_UNROLLED_PARAMS
from sparkgrad.session import MAX_BROADCAST_PARAMS
from sparkgrad.sources.schemas import BIAS_KEY

@dataclass(frozen=True)
class Network:
    n_in: int
    n_hidden: int
    n_out: int
    hidden: str = "relu"
    output: str = "softmax"

    @property
    def n_params(self) -> int:
        return self.n_hidden * (self.n_in + 1) + self.n_out * (self.n_hidden + 1)

    def width(self, layer: int) -> tuple[int, int]:
        """(inputs, outputs) of a layer."""
        return (self.n_in, self.n_hidden) if layer == 1 else (self.n_hidden, self.n_out)

    @property
    def engine(self) -> str:
        if self.n_params <= MAX_UNROLLED_PARAMS:
            return "columns"
        return "block" if self.n_params <= MAX_BROADCAST_PARAMS else "long"


@dataclass(frozen=True)
class State:
    """Parameters of one network as rows (layer, out, in, w); ``in = -1`` is the bias.

    ``params`` must hold each key of the shape once. ``State.checked`` enforces that
    for frames from outside; frames built here have it by construction.
    """

    net: Network
    params: DataFrame
    iteration: int = 0
    stored: bool = False
    _cache: dict = field(default_factory=dict, compare=False, repr=False)

    @staticmethod
    def pattern(spark: SparkSession, net: Network) -> State:
        return State(net, init.pattern_params(spark, net))

    @staticmethod
    def he(spark: SparkSession, net: Network, seed: int = 7) -> State:
        return State(net, init.he_params(spark, net, seed))

    @staticmethod
    def checked(net: Network, params: DataFrame, iteration: int = 0) -> State:
        rows, keys = params.agg(F.count(F.lit(1)), F.countDistinct("layer", "out", "in")).first()
        if rows != net.n_params or keys != net.n_params:
            raise ValueError(f"{rows} parameter rows with {keys} keys, the shape needs {net.n_params}")
        return State(net, params, iteration)

    @property
    def fits_broadcast(self) -> bool:
        return self.net.n_params <= MAX_BROADCAST_PARAMS

    def weights(self, layer: int) -> DataFrame:
        return self.params.where((F.col("layer") == layer) & (F.col("in") != BIAS_KEY)).select("out", "in", "w")

    def biases(self, layer: int) -> DataFrame:
        return self.params.where((F.col("layer") == layer) & (F.col("in") == BIAS_KEY)).select(
            "out", F.col("w").alias("b"))

    def packed(self) -> DataFrame:
        """One row with struct ``m`` (w1, b1, w2, b2, w2t); size bounded by the shape."""
        return pack_models(self.params, self.net).select("m")

    def arrays(self) -> dict[str, np.ndarray]:
        """The bounded parameter set as NumPy arrays, for the block form."""
        if not self.fits_broadcast:
            raise ValueError("parameter set too large for the block form")
        if "arrays" not in self._cache:
            rows = self.params.select("layer", "out", "in", "w").limit(self.net.n_params + 1)  # one more shows a surplus
            self._cache["arrays"] = matrices(self.net, rows.toPandas())
        return self._cache["arrays"]


def matrices(net: Network, rows) -> dict[str, np.ndarray]:
    """Parameter rows of one network (a pandas frame) as weight matrices and bias vectors. Each key has to be there once."""
    if len(rows) != net.n_params or rows.duplicated(["layer", "out", "in"]).any():
        raise ValueError(f"{len(rows)} parameter rows, or repeated keys; the shape needs {net.n_params} different ones")
    filled = {}
    for layer in (1, 2):
        n_in, n_out = net.width(layer)
        part = rows[rows["layer"] == layer]
        bias = part["in"] == BIAS_KEY
        b, w = np.zeros(n_out), np.zeros((n_out, n_in))
        b[part.loc[bias, "out"]] = part.loc[bias, "w"]
        w[part.loc[~bias, "out"], part.loc[~bias, "in"]] = part.loc[~bias, "w"]
        filled |= {f"w{layer}": w, f"b{layer}": b}
    return filled


def pack_models(params: DataFrame, net: Network, *by: str) -> DataFrame:
    """One row per model key with struct ``m`` of weight matrices and bias vectors."""
    if net.n_params > MAX_BROADCAST_PARAMS:
        raise ValueError("parameter set too large to pack into one row; use the long form")
    # In key order the values form runs of (bias, weights), one run per output: -1 sorts first.
    # sorted, so a repeated key stands next to itself
    repeated = ("exists(sequence(1, size(rows) - 1), i -> rows[i].layer = rows[i - 1].layer AND rows[i].out = rows[i - 1].out "
                "AND rows[i].`in` = rows[i - 1].`in`)")
    wrong = f"raise_error('a parameter set needs {net.n_params} rows with different keys')"
    sorted_rows = params.groupBy(*by).agg(F.expr("array_sort(collect_list(struct(layer, out, `in`, w))) AS rows"))
    whole = sorted_rows.selectExpr(*by, f"CASE WHEN size(rows) = {net.n_params} AND NOT {repeated} THEN transform(rows, s -> s.w) ELSE {wrong} END AS ws")

    def part(layer: int, at: str) -> str:
        n_in, n_out = net.width(layer)
        start = 1 if layer == 1 else 1 + net.n_hidden * (net.n_in + 1)
        run = f"{start} + j * {n_in + 1}"
        pick = f"ws[{run} - 1]" if at == "bias" else f"slice(ws, {run} + 1, {n_in})"
        return f"transform(sequence(0, {n_out - 1}), j -> {pick})"

    matrices = whole.selectExpr(*by, f"{part(1, 'weights')} AS w1", f"{part(1, 'bias')} AS b1",
                                f"{part(2, 'weights')} AS w2", f"{part(2, 'bias')} AS b2")
    transposed = f"transform(sequence(0, {net.n_hidden - 1}), j -> transform(w2, row -> row[j]))"
    return matrices.selectExpr(
        *by, f"named_struct('w1', w1, 'b1', b1, 'w2', w2, 'b2', b2, 'w2t', {transposed}) AS m")


def image_outputs(net: Network, body: str, m: str = "m") -> str:
    """Expression over column ``x`` and the model ``m``: binds xs, hs, ps and returns ``body``."""
    hidden = C.activation(net.hidden, C.dense(f"{m}.w1", f"{m}.b1", "xs"))
    output = C.activation(net.output, C.dense(f"{m}.w2", f"{m}.b2", "hs"))
    return C.let(C.fit_length("x", net.n_in), "xs", C.let(hidden, "hs", C.let(output, "ps", body)))


def activations(images: DataFrame, state: State) -> DataFrame:
    """Array form: images plus ``x`` cleaned, ``a`` and ``p``; map-only, one scan.

    The packed parameters enter as a scalar subquery, evaluated once and shipped with
    the tasks; there is no join with the images. An image without any known feature
    has NULL outputs, as a SUM over NULLs.
    """
    keys = [c for c in images.columns if c != "x"]
    score = image_outputs(state.net, "named_struct('x', xs, 'a', hs, 'p', ps)")
    unknown = (f"named_struct('x', {C.fit_length('x', state.net.n_in)}, "
               f"'a', array_repeat(CAST(NULL AS DOUBLE), {state.net.n_hidden}), "
               f"'p', array_repeat(CAST(NULL AS DOUBLE), {state.net.n_out}))")
    scored = images.withColumn("m", state.packed().scalar()).selectExpr(
        *keys, f"CASE WHEN {C.has_value('x')} THEN {score} ELSE {unknown} END AS s")
    return scored.select(*keys, "s.x", "s.a", "s.p")
