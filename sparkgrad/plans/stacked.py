"""Many models of one shape as one network: a wide first layer and a block-diagonal second.

An image is read once for all models. Their first layers are one matrix product, their second layers a batch of small
ones; no row is copied per model. A task keeps one set of running gradient sums for all models and emits it once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions.blocks import activate, to_matrix
from sparkgrad.sources.schemas import BIAS_KEY

_HELD = 1 << 20  # activations of one layer, over all models, that a task works on at once (8 MB)


def stack(models: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """First layers side by side, second layers one above the other."""
    side = {k: np.concatenate([m[k] for m in models]) for k in ("w1", "b1")}
    return side | {k: np.stack([m[k] for m in models]) for k in ("w2", "b2")}


class StackedSums:
    """Running gradient sums of all models in one task."""

    def __init__(self, net, count: int):
        self.net, self.count, self.n = net, count, 0
        self.w1, self.b1 = np.zeros((count * net.n_hidden, net.n_in)), np.zeros(count * net.n_hidden)
        self.w2, self.b2 = np.zeros((count, net.n_out, net.n_hidden)), np.zeros((count, net.n_out))

    def add(self, m: dict[str, np.ndarray], x: np.ndarray, label: np.ndarray) -> None:
        net, rows = self.net, len(x)
        wide = activate(net.hidden, x @ m["w1"].T + m["b1"])
        a = wide.reshape(rows, self.count, net.n_hidden).transpose(1, 0, 2)  # model, row, unit
        z = a @ m["w2"].transpose(0, 2, 1) + m["b2"][:, None]
        p = activate(net.output, z.reshape(-1, net.n_out)).reshape(z.shape)
        if net.output == "sigmoid":
            d2 = (p - m["targets"][:, None]) * p * (1.0 - p)
        else:
            d2 = 2.0 * (p - (label[:, None] == np.arange(net.n_out)))
        e = (d2 @ m["w2"]).transpose(1, 0, 2).reshape(wide.shape)
        d1 = e * (wide > 0) if net.hidden == "relu" else e * wide * (1.0 - wide)
        self.w1 += d1.T @ x
        self.b1 += d1.sum(axis=0)
        self.w2 += d2.transpose(0, 2, 1) @ a
        self.b2 += d2.sum(axis=1)
        self.n += rows

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One batch of rows (model, layer, out, in, g_sum, n) per model."""
        h = self.net.n_hidden
        for k in range(self.count):
            mine = slice(k * h, (k + 1) * h)
            sums = [np.hstack([self.b1[mine, None], self.w1[mine]]), np.hstack([self.b2[k][:, None], self.w2[k]])]
            at = [np.indices(s.shape, dtype=np.int32) for s in sums]
            size = sum(s.size for s in sums)
            yield pa.RecordBatch.from_pydict({
                "model": np.full(size, k, dtype=np.int32),
                "layer": np.repeat(np.array([1, 2], dtype=np.int32), [s.size for s in sums]),
                "out": np.concatenate([out.ravel() for out, _ in at]),
                "in": np.concatenate([place.ravel() for _, place in at]) + np.int32(BIAS_KEY),
                "g_sum": np.concatenate([s.ravel() for s in sums]),
                "n": np.full(size, self.n, dtype=np.int64)})


def stacked_sums(images: DataFrame, net, models: list[dict[str, np.ndarray]], targets: list | None, held: list) -> DataFrame:
    """Rows (model, layer, out, in, g_sum, n), ``model`` the place in ``models``.

    ``targets``: one list of ``n_out`` values per model for a sigmoid output, else None. The caller bounds the parameters
    of all models together; the broadcast is added to ``held``, to be destroyed after use.
    """
    arrays = stack(models) | ({"targets": np.array(targets, dtype=float)} if targets else {})
    shipped = images.sparkSession.sparkContext.broadcast(arrays)
    held.append(shipped)
    count = len(models)
    step = max(1, _HELD // (count * max(net.n_hidden, net.n_out)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = shipped.value, StackedSums(net, count)
        for batch in batches:
            x, known = to_matrix(batch.column(1), net.n_in)
            x = x[known]
            label = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)[known]
            for at in range(0, len(x), step):
                sums.add(m, x[at:at + step], label[at:at + step])
        if sums.n:
            yield from sums.batches()

    partial = images.select("label", "x").mapInArrow(
        run, "model int, layer int, out int, `in` int, g_sum double, n long")
    return partial.groupBy("model", "layer", "out", "in").agg(F.sum("g_sum").alias("g_sum"), F.sum("n").alias("n"))
