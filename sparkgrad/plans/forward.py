"""Complete forward passes and predictions in every form."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C
from sparkgrad.functions.blocks import activate, list_array, to_matrix
from sparkgrad.operators.layers import dense_packed
from sparkgrad.operators.reshape import array_to_rows, feature_rows
from sparkgrad.plans.network import Network, State, activations
from sparkgrad.plans.unrolled import score_unrolled
from sparkgrad.session import materialize


def logits(images: DataFrame, state: State, engine: str | None = None) -> DataFrame:
    """(id, label, z): inputs of the softmax for every image."""
    net = replace(state.net, output="linear")
    return score(images, State(net, state.params), engine).withColumnRenamed("p", "z")


def score(images: DataFrame, state: State, engine: str | None = None, held: list | None = None) -> DataFrame:
    """(id, label, p ARRAY<DOUBLE>) for every image, in the form that suits the shape."""
    engine = engine or state.net.engine
    if engine == "long":
        return score_long(images, state)
    return unit_values(images, state, engine, held).select("id", "label", "p")


def unit_values(images: DataFrame, state: State, engine: str | None = None, held: list | None = None) -> DataFrame:
    """(id, label, a, p): hidden activations and outputs of every image; map-only but for the long form.

    Broadcasts that the result needs are added to ``held``, to be destroyed after use.
    """
    engine = engine or state.net.engine
    if engine == "long":
        return values_long(images, state)
    if engine == "columns":
        return score_unrolled(images, state)
    if engine == "block":
        return score_blocks(images, state, held)
    return activations(images, state).select("id", "label", "a", "p")


_KEYS = ["_row", "id", "label"]
# In the long form, sums of this many images are in a task's memory at once, if images of so few features are dealt out before them.
_IMAGES, _NARROW = 250_000, 32


def score_long(images: DataFrame, state: State) -> DataFrame:
    """Pixels as rows; both layers are joins with grouped sums.

    There is one shuffle by image: the second layer's rows are generated from, and summed in, the same partitions. A
    wide image is shuffled as the first layer's partial sums; a narrow one, of which a split of the input holds millions,
    as its features, into as many tasks as the number of images asks for. Rows are told apart by a number of their own, so
    ids may repeat.
    """
    return _output_long(_hidden_long(images, state), state).select("id", "label", "p")


def values_long(images: DataFrame, state: State) -> DataFrame:
    """(id, label, a, p) in the long form; the hidden layer is written once and joined with its outputs."""
    a = materialize(_hidden_long(images, state), "hidden")
    return a.join(_output_long(a, state).select("_row", "p"), "_row").select("id", "label", "a", "p")


def _hidden_long(images: DataFrame, state: State) -> DataFrame:
    net = state.net
    numbered = images.withColumn("_row", F.monotonically_increasing_id())
    if net.n_in <= _NARROW and not images.isStreaming:
        tasks = max(images.sparkSession.sparkContext.defaultParallelism, -(-images.count() // _IMAGES))
        numbered = numbered.repartition(tasks, "_row")
    x = feature_rows(numbered, net.n_in, *_KEYS)
    z = dense_packed(x, state.weights(1), state.biases(1), keys=_KEYS, n_in=net.n_in, n_out=net.n_hidden)
    return z.selectExpr(*_KEYS, f"{C.activation(net.hidden, 'z')} AS a")


def _output_long(a: DataFrame, state: State) -> DataFrame:
    net = state.net
    h = array_to_rows(a, _KEYS, "a", "in", "v")
    z = dense_packed(h, state.weights(2), state.biases(2), keys=_KEYS, n_in=net.n_hidden, n_out=net.n_out)
    return z.selectExpr(*_KEYS, f"{C.activation(net.output, 'z')} AS p")


def score_blocks(images: DataFrame, state: State, held: list | None = None) -> DataFrame:
    """(id, label, a, p) by one pair of matrix products per Arrow batch; map-only."""
    sc = images.sparkSession.sparkContext
    net, shipped = state.net, sc.broadcast(state.arrays())  # size checked by arrays()
    if held is not None:
        held.append(shipped)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            x, known = to_matrix(batch.column(2), net.n_in)
            a, p = forward_block(net, m, x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), list_array(a, known), list_array(p, known)],
                names=["id", "label", "a", "p"])

    return images.select("id", "label", "x").mapInArrow(run, "id long, label int, a array<double>, p array<double>")


def forward_block(net: Network, m: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = activate(net.hidden, x @ m["w1"].T + m["b1"])
    return a, activate(net.output, a @ m["w2"].T + m["b2"])


def output_rows(scored: DataFrame) -> DataFrame:
    """(id, output, p): one row per image and output."""
    return array_to_rows(scored, ["id"], "p", "output", "p")


def predict(images: DataFrame, state: State, engine: str | None = None, held: list | None = None) -> DataFrame:
    """(id, label, prediction); map-only in the array and block forms."""
    scored = score(images, state, engine, held)
    return scored.selectExpr("id", "label", f"{C.argmax('p')} AS prediction")
