"""Several training steps in one job: the tasks of a barrier stage exchange their gradients.

Every task keeps its share of the images in memory, adds up its gradients, and gathers those of all others; all then make the same update and
go on. A version is written every ``every`` steps, so a lost executor repeats those at most: Spark starts the whole barrier stage again from
the version before. For networks and batches of bounded size; ``train`` covers the others. Images without any known feature teach
nothing; without any image the parameters stay as they are.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C
from sparkgrad.functions.blocks import to_matrix
from sparkgrad.plans.forward import forward_block
from sparkgrad.plans.network import Network, State
from sparkgrad.plans.training import Options, ParamStore, output_deltas
from sparkgrad.sources.schemas import BIAS_KEY

MAX_EXCHANGED = 200_000  # parameters; each task receives as many sums from every other one
MAX_TASK_BYTES = 512 << 20


def local_sums(net: Network, m: dict[str, np.ndarray], opts: Options, x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Gradient sums of both layers, bias first, and the number of images, as one vector."""
    a, p = forward_block(net, m, x)
    d2 = output_deltas(net, opts, p, label)
    e = d2 @ m["w2"]
    d1 = e * (a > 0) if net.hidden == "relu" else e * a * (1.0 - a)
    hidden_bias = (d1 if opts.mask_hidden_bias else e).sum(axis=0)
    return np.concatenate([np.hstack([hidden_bias[:, None], d1.T @ x]).ravel(), np.hstack([d2.sum(axis=0)[:, None], d2.T @ a]).ravel(), [len(x)]])


def moved(net: Network, m: dict[str, np.ndarray], opts: Options, sums: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters after one step from the sums over all images."""
    first = net.n_hidden * (net.n_in + 1)
    g = {1: sums[:first].reshape(net.n_hidden, -1) / sums[-1], 2: sums[first:-1].reshape(net.n_out, -1) / sums[-1]}
    out = {}
    for layer, grad in g.items():
        if opts.clip is not None and layer in opts.clip_layers:
            grad = np.clip(grad, -opts.clip, opts.clip)
        out |= {f"w{layer}": m[f"w{layer}"] - opts.lr * grad[:, 1:],
                f"b{layer}": m[f"b{layer}"] - opts.lr * grad[:, 0] if opts.update_bias else m[f"b{layer}"]}
    return out


def parameter_batch(net: Network, m: dict[str, np.ndarray]) -> pa.RecordBatch:
    columns = []
    for layer in (1, 2):
        whole = np.hstack([m[f"b{layer}"][:, None], m[f"w{layer}"]])
        out, at = np.indices(whole.shape)
        columns.append((np.full(whole.size, layer), out.ravel(), at.ravel() + BIAS_KEY, whole.ravel()))
    layer, out, at, w = (np.concatenate(c) for c in zip(*columns))
    return pa.RecordBatch.from_arrays([pa.array(layer, pa.int32()), pa.array(out, pa.int32()), pa.array(at, pa.int32()), pa.array(w)],
                                      ["layer", "out", "in", "w"])


def steps_in_one_job(images: DataFrame, state: State, opts: Options, steps: int, tasks: int, held: list) -> DataFrame:
    """(layer, out, in, w) after ``steps`` steps over all images."""
    net, shipped = state.net, images.sparkSession.sparkContext.broadcast(state.arrays())  # size checked by the caller
    held.append(shipped)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        xs, labels, size = [np.zeros((0, net.n_in))], [np.zeros(0, np.int64)], 0
        for batch in batches:
            x, known = to_matrix(batch.column(1), net.n_in)
            xs.append(x[known])
            labels.append(batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)[known])
            size += xs[-1].nbytes
            if size > MAX_TASK_BYTES:
                raise ValueError("the images of a task are too many to be kept; use train()")
        x, label = np.concatenate(xs), np.concatenate(labels)
        m = shipped.value
        for _ in range(steps):
            mine = base64.b64encode(local_sums(net, m, opts, x, label).astype("<f8").tobytes()).decode()
            total = np.sum([np.frombuffer(base64.b64decode(s), "<f8") for s in context.allGather(mine)], axis=0)  # in task order, so alike in all
            if total[-1]:
                m = moved(net, m, opts, total)
        if context.partitionId() == 0:
            yield parameter_batch(net, m)

    dealt = images.where(C.has_value("x")).select("label", "x").withColumn("_n", F.monotonically_increasing_id()).repartition(
        tasks, "_n").select("label", "x")
    return dealt.mapInArrow(run, "layer int, out int, `in` int, w double", barrier=True)


def train_barrier(images: DataFrame, state: State, store: ParamStore, opts: Options, steps: int, every: int = 10,
                  tasks: int | None = None) -> State:
    """``steps`` steps over all images, ``every`` of them in a job. ``tasks``: at most as many as can run at once."""
    if state.net.n_params > MAX_EXCHANGED:
        raise ValueError("parameter set too large to be exchanged between tasks; use train()")
    if opts.hidden_error_weights != "old":
        raise ValueError("the barrier form updates both layers from the same state")
    tasks = tasks or max(1, images.sparkSession.sparkContext.defaultParallelism // 2)
    if not state.stored:
        state = store.save(state.net, state.params, state.iteration)
    last = state.iteration + steps
    if images.where(C.has_value("x")).isEmpty():  # Spark drops a stage without input, and with it the parameters that task 0 returns
        return store.save(state.net, state.params, last)
    while state.iteration < last:
        some = min(every, last - state.iteration)
        held: list = []
        try:
            state = store.save(state.net, steps_in_one_job(images, state, opts, some, tasks, held), state.iteration + some)
        finally:
            for shipped in held:  # each leaves a file on the driver
                shipped.destroy()
    return state
