"""Training: one distributed job per step, parameters as written versions.

A step scans its batch once, sums the gradients of all parameters and writes the
next parameter version to the shared folder. Reading that version back cuts the
lineage, so the plan of step k does not contain steps 1..k-1 and a lost executor
recomputes one step at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sparkgrad.functions import columns as C
from sparkgrad.functions.blocks import list_array, to_matrix
from sparkgrad.operators.gradients import delta_body, gradient_sums, mean_gradients
from sparkgrad.operators.update import sgd_update
from sparkgrad.operators.layers import dense_rows, softmax_rows
from sparkgrad.operators.reshape import feature_rows
from sparkgrad.plans.forward import forward_block, unit_values
from sparkgrad.plans.network import Network, State, image_outputs, matrices
from sparkgrad.plans.stacked import stacked_sums
from sparkgrad.plans.unrolled import MAX_UNROLLED_PARAMS, unrolled_sums
from sparkgrad.session import MAX_BROADCAST_PARAMS, materialize, scratch_path
from sparkgrad.sources.schemas import BIAS_KEY, INT, LONG, PARAMS


@dataclass(frozen=True)
class Options:
    """Training choices; the defaults are the textbook form.

    ``hidden_error_weights="updated"`` lets the hidden error read the already updated
    output weights; ``mask_hidden_bias=False`` leaves the ReLU mask out of the hidden
    bias update.
    """

    lr: float = 0.0001
    delta: str = "sq2"
    clip: float | None = None
    clip_layers: tuple[int, ...] = (2,)
    update_bias: bool = True
    target: tuple[float, ...] | None = None
    hidden_error_weights: str = "old"
    mask_hidden_bias: bool = True


class TrainLog:
    """Predictions of a training run, ``<path>/iter=k/part=rows`` for the images of the step that starts from version k.

    Rows (iter, insert_time, id, label, prediction, a, p). ``iter`` orders the log: all rows of a step share
    the time of its insert. A step that runs again replaces its own rows. In the block form a step's gradient sums
    come from the same scan and lie beside its rows, in ``part=sums``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "train-log")

    def _write(self, tagged: DataFrame, state: State) -> str:
        at = f"{self.path}/iter={state.iteration}"
        timed = tagged.selectExpr("*", "current_timestamp() AS insert_time", f"{C.argmax('p')} AS prediction")
        timed.write.mode("overwrite").partitionBy("part").parquet(at)
        return at

    def write(self, images: DataFrame, state: State, engine: str | None = None) -> None:
        held: list = []
        try:
            self._write(unit_values(images, state, engine, held).withColumn("part", F.lit("rows")), state)
        finally:
            for shipped in held:  # each leaves a file on the driver
                shipped.destroy()

    def write_with_sums(self, images: DataFrame, state: State, opts: Options, held: list) -> DataFrame:
        """The log of a step and its gradient sums (layer, out, in, g_sum, n), from one scan of the batch."""
        at = self._write(logged_sums(images, state, opts, held), state)
        sums = self.spark.read.schema("layer int, out int, `in` int, g_sum double, n long, part string").parquet(at)
        return total_sums(sums.where("part = 'sums'").drop("part"))

    def read(self) -> DataFrame:
        """The whole log; filters on ``iter`` prune folders."""
        rows = "insert_time timestamp, id long, label int, prediction int, a array<double>, p array<double>, iter int, part string"
        return self.spark.read.schema(rows).parquet(self.path).where("part = 'rows'").select(
            "iter", "insert_time", "id", "label", "prediction", "a", "p")

    def means(self, units: str) -> DataFrame:
        """(iter, unit, value): mean of an array column (a or p) per step and unit, from one scan of the log."""
        rows = self.read().selectExpr("iter", f"posexplode({units}) AS (unit, value)")
        return rows.groupBy("iter", "unit").agg(F.avg("value").alias("value"))


class ParamStore:
    """Parameter versions ``<path>/iter=k``; writing a version again replaces it."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "params")

    def save(self, net: Network, params: DataFrame, iteration: int) -> State:
        params.select("layer", "out", "in", "w").write.mode("overwrite").parquet(f"{self.path}/iter={iteration}")
        return self.load(net, iteration)

    def _at(self, iteration: int):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/iter={iteration}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def has(self, iteration: int) -> bool:
        """A complete version is there."""
        files, path = self._at(iteration)
        return files.exists(path)

    def versions(self) -> list[int]:
        """Numbers of the complete versions, from the names of their folders."""
        files, path = self._at(0)
        root = path.getParent().getParent()
        found = [f.getPath().getName() for f in files.listStatus(root)] if files.exists(root) else []
        numbers = sorted(int(name[5:]) for name in found if name.startswith("iter=") and name[5:].isdigit())
        return [k for k in numbers if self.has(k)]

    def newest(self, net: Network) -> State:
        return self.load(net, max(self.versions()))

    def load(self, net: Network, iteration: int) -> State:
        return State(net, self.spark.read.schema(PARAMS).parquet(f"{self.path}/iter={iteration}"), iteration,
                     stored=True)

    def history(self) -> DataFrame:
        """All complete versions as (iter, layer, out, in, w)."""
        versioned = StructType([*PARAMS.fields, StructField("iter", INT)])
        folders = [f"{self.path}/iter={k}" for k in self.versions()]
        df = self.spark.read.option("basePath", self.path).schema(versioned).parquet(*folders)
        return df.select("iter", "layer", "out", "in", "w")


def deltas(images: DataFrame, state: State, opts: Options, back: State | None = None) -> DataFrame:
    """Activations and deltas per image in the array form; map-only.

    Images without any known feature teach nothing and are left out. ``back`` is the
    state whose output weights carry the error to the hidden layer, if not ``state``.
    """
    keys = [c for c in images.columns if c != "x"]
    target = f"array({', '.join(f'{float(t)!r}D' for t in opts.target)})" if opts.target else "NULL"
    known = images.where(C.has_value("x")).withColumn("m", state.packed().scalar())
    if back is not None:
        known = known.withColumn("late", back.packed().scalar())
    body = delta_body(state.net, opts.delta, target=target, back="late.w2t" if back is not None else "m.w2t")
    return known.selectExpr(*keys, f"{image_outputs(state.net, body)} AS s").select(*keys, "s.*")


def gradients(images: DataFrame, state: State, opts: Options, engine: str | None = None, back: State | None = None,
              shipped: list | None = None) -> DataFrame:
    """Mean gradient of every parameter: rows (layer, out, in, g).

    ``back``: the state whose output weights carry the error to the hidden layer, if not ``state``. Broadcasts
    that the result needs are added to ``shipped``, to be destroyed after use.
    """
    engine = engine or state.net.engine
    if engine == "columns" and back is not None:
        engine = "block"
    if engine == "block":
        return mean_gradients(block_sums(images, state, opts, back, shipped))
    if engine == "long":
        return long_gradients(images, state, opts, back)
    if engine == "columns":
        targets = {"m": opts.target} if opts.target else None
        return mean_gradients(unrolled_sums(images, state.net, {"m": state.arrays()}, targets, opts.delta,
                                            opts.mask_hidden_bias))
    return mean_gradients(gradient_sums(deltas(images, state, opts, back), state.net, None, opts.mask_hidden_bias))


def long_gradients(images: DataFrame, state: State, opts: Options, back: State | None = None,
                   broadcast_limit: int = MAX_BROADCAST_PARAMS) -> DataFrame:
    """The same with rows and joins only: for parameter sets beyond a broadcast.

    Activations, deltas and errors are rows (_row, unit, value); each layer is ``dense_rows``, backwards with the
    transposed weights. Features are written once, so that row numbers are the same in every join.
    """
    net = state.net
    sizes = {k: {"n_weights": net.width(k)[0] * net.width(k)[1], "broadcast_limit": broadcast_limit} for k in (1, 2)}
    known = images.where(C.has_value("x")).withColumn("_row", F.monotonically_increasing_id())
    x = materialize(feature_rows(known, net.n_in, "_row", "label").where("v IS NOT NULL"), "features")
    keys = ["_row", "label"]

    def layer(k: int, rows: DataFrame) -> DataFrame:
        return dense_rows(rows, state.weights(k), state.biases(k), keys=keys, n_out=net.width(k)[1], **sizes[k]).where("out IS NOT NULL")

    a = materialize(layer(1, x).selectExpr(*keys, "out AS `in`", f"{C.relu('z') if net.hidden == 'relu' else C.sigmoid('z')} AS v"), "hidden")
    z = layer(2, a)
    if net.output == "softmax":
        error = "p - CASE WHEN out = label THEN 1D ELSE 0D END"
        d2 = softmax_rows(z, keys, net.n_out).selectExpr(*keys, "out", f"{'2D * ' if opts.delta == 'sq2' else ''}({error}) AS d")
    else:
        target = f"element_at(array({', '.join(f'{float(t)!r}D' for t in opts.target)}), out + 1)"
        p = z.selectExpr(*keys, "out", f"{C.sigmoid('z')} AS p")
        d2 = p.selectExpr(*keys, "out", f"(p - {target}) * p * (1D - p) AS d")
    d2 = materialize(d2, "deltas")
    turned = (back or state).weights(2).selectExpr("`in` AS out", "out AS `in`", "w")
    none = state.biases(1).selectExpr("out", "0D AS b")
    e = dense_rows(d2.selectExpr(*keys, "out AS `in`", "d AS v"), turned, none, keys=keys, n_out=net.n_hidden, **sizes[2])
    slope = "CASE WHEN v > 0D THEN e ELSE 0D END" if net.hidden == "relu" else "v * (1D - v) * e"
    d1 = materialize(e.selectExpr("_row", "out AS `in`", "z AS e").join(a.drop("label"), ["_row", "in"]).selectExpr(
        "_row", "`in` AS out", "e", f"{slope} AS d"), "hidden-deltas")
    n = x.select(F.countDistinct("_row").alias("n"))

    def products(k: int, d: DataFrame, inputs: DataFrame) -> DataFrame:
        # a row that a feature is missing from adds nothing to its sum
        return d.select("_row", "out", "d").join(inputs.select("_row", "in", "v"), "_row").groupBy("out", "in").agg(
            F.sum(F.col("d") * F.col("v")).alias("g")).selectExpr(f"{k} AS layer", "out", "`in`", "g")

    def bias(k: int, d: DataFrame, column: str) -> DataFrame:
        return d.groupBy("out").agg(F.sum(column).alias("g")).selectExpr(f"{k} AS layer", "out", f"{BIAS_KEY} AS `in`", "g")

    sums = products(1, d1, x).unionByName(bias(1, d1, "d" if opts.mask_hidden_bias else "e")).unionByName(
        products(2, d2, a)).unionByName(bias(2, d2, "d"))
    return sums.withColumn("n", n.scalar()).selectExpr("layer", "out", "`in`", "g / n AS g")


def block_sums(images: DataFrame, state: State, opts: Options, back: State | None = None, held: list | None = None) -> DataFrame:
    """Gradient sums from matrix products per Arrow batch.

    A task keeps one set of running sums, whatever the number of its images, and emits
    it once; the sets of all tasks are added by a grouped sum over the parameter keys.
    """
    net = state.net
    arrays = state.arrays() | {"back": (back or state).arrays()["w2"]}
    shipped = images.sparkSession.sparkContext.broadcast(arrays)  # size checked by arrays()
    if held is not None:
        held.append(shipped)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = shipped.value, GradientSums(net, opts)
        for batch in batches:
            x, known = to_matrix(batch.column(1), net.n_in)
            x = x[known]
            label = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)[known]
            sums.add(x, label, *forward_block(net, m, x), m["back"])
        if sums.n:
            yield pa.RecordBatch.from_pydict(sums.columns())

    return total_sums(images.select("label", "x").mapInArrow(run, "layer int, out int, `in` int, g_sum double, n long"))


def total_sums(partial: DataFrame) -> DataFrame:
    return partial.groupBy("layer", "out", "in").agg(F.sum("g_sum").alias("g_sum"), F.sum("n").alias("n"))


class GradientSums:
    """Running gradient sums of one task, (out, 1 + in) per layer with the bias in column 0."""

    def __init__(self, net: Network, opts: Options):
        self.net, self.opts, self.n = net, opts, 0
        self.total = {1: np.zeros((net.n_hidden, net.n_in + 1)), 2: np.zeros((net.n_out, net.n_hidden + 1))}

    def add(self, x: np.ndarray, label: np.ndarray, a: np.ndarray, p: np.ndarray, back: np.ndarray) -> None:
        d2 = output_deltas(self.net, self.opts, p, label)
        e = d2 @ back
        d1 = e * (a > 0) if self.net.hidden == "relu" else e * a * (1.0 - a)
        self.total[1] += np.hstack([(d1 if self.opts.mask_hidden_bias else e).sum(axis=0)[:, None], d1.T @ x])
        self.total[2] += np.hstack([d2.sum(axis=0)[:, None], d2.T @ a])
        self.n += len(x)

    def columns(self) -> dict[str, pa.Array]:
        """One row per parameter: layer, out, in, g_sum, n."""
        at = {layer: np.indices(sums.shape, dtype=np.int32) for layer, sums in self.total.items()}
        joined = {
            "layer": [np.full(sums.size, layer, dtype=np.int32) for layer, sums in self.total.items()],
            "out": [out.ravel() for out, _ in at.values()],
            "in": [place.ravel() + np.int32(BIAS_KEY) for _, place in at.values()],
            "g_sum": [sums.ravel() for sums in self.total.values()],
            "n": [np.full(sums.size, self.n, dtype=np.int64) for sums in self.total.values()],
        }
        return {name: pa.array(np.concatenate(parts)) for name, parts in joined.items()}


_LOGGED = pa.schema([("part", pa.string()), ("id", pa.int64()), ("label", pa.int32()), ("a", pa.list_(pa.float64())),
                     ("p", pa.list_(pa.float64())), ("layer", pa.int32()), ("out", pa.int32()), ("in", pa.int32()),
                     ("g_sum", pa.float64()), ("n", pa.int64())])


def logged_sums(images: DataFrame, state: State, opts: Options, held: list) -> DataFrame:
    """One pass over the batch: rows tagged ``rows`` (id, label, a, p of every image), and after them one set of
    gradient sums per task tagged ``sums``. Columns of the other tag are NULL."""
    net = state.net
    shipped = images.sparkSession.sparkContext.broadcast(state.arrays())  # size checked by arrays()
    held.append(shipped)

    def tagged(part: str, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        columns["part"] = pa.array([part] * size)
        return pa.RecordBatch.from_arrays(
            [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type) for f in _LOGGED], schema=_LOGGED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = shipped.value, GradientSums(net, opts)
        for batch in batches:
            x, known = to_matrix(batch.column(2), net.n_in)
            a, p = forward_block(net, m, x)
            label = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            sums.add(x[known], label[known], a[known], p[known], m["w2"])
            yield tagged("rows", {"id": batch.column(0), "label": batch.column(1),
                                  "a": list_array(a, known), "p": list_array(p, known)})
        if sums.n:
            yield tagged("sums", sums.columns())

    return images.select("id", "label", "x").mapInArrow(
        run, "part string, id long, label int, a array<double>, p array<double>, layer int, out int, `in` int, g_sum double, n long")


def output_deltas(net: Network, opts: Options, p: np.ndarray, label: np.ndarray) -> np.ndarray:
    if net.output == "sigmoid":
        return (p - np.asarray(opts.target)) * p * (1.0 - p)
    error = p - (label[:, None] == np.arange(net.n_out))
    return 2.0 * error if opts.delta == "sq2" else error


def step(images: DataFrame, state: State, store: ParamStore, opts: Options, engine: str | None = None,
         log: TrainLog | None = None) -> State:
    """One gradient step on a batch that writes the next version.

    With a log the block form writes both from one scan; the other forms, and the hidden error by updated weights,
    write the log in a job before it.
    """
    held: list = []
    try:
        if log is not None and (engine or state.net.engine) == "block" and opts.hidden_error_weights == "old":
            return _moved(mean_gradients(log.write_with_sums(images, state, opts, held)), state, store, opts)
        if log is not None:
            log.write(images, state, engine)
        return _step(images, state, store, opts, engine, held)
    finally:
        for shipped in held:  # each leaves a file on the driver
            shipped.destroy()


def _bounds(state: State, opts: Options) -> dict:
    return {"clip": opts.clip, "clip_layers": opts.clip_layers, "update_bias": opts.update_bias,
            "small": state.fits_broadcast}


def _moved(g: DataFrame, state: State, store: ParamStore, opts: Options) -> State:
    return store.save(state.net, sgd_update(state.params, g, opts.lr, **_bounds(state, opts)), state.iteration + 1)


def _step(images: DataFrame, state: State, store: ParamStore, opts: Options, engine: str | None, held: list) -> State:
    if opts.hidden_error_weights == "old":
        return _moved(gradients(images, state, opts, engine, shipped=held), state, store, opts)
    bound = _bounds(state, opts)
    # Output layer first; the hidden error then reads its updated weights.
    g2 = gradients(images, state, opts, engine, shipped=held).where(F.col("layer") == 2)
    moved = ParamStore(store.spark).save(state.net, sgd_update(state.params, g2, opts.lr, **bound), state.iteration + 1)
    g1 = gradients(images, state, opts, engine, back=moved, shipped=held).where(F.col("layer") == 1)
    return store.save(state.net, sgd_update(moved.params, g1, opts.lr, **bound), state.iteration + 1)


def train(batches: Iterable[DataFrame], state: State, store: ParamStore, opts: Options,
          engine: str | None = None, log: TrainLog | None = None) -> State:
    """One step per batch, in order. The loop only submits jobs."""
    if not state.stored:
        state = store.save(state.net, state.params, state.iteration)
    for batch in batches:
        state = step(batch, state, store, opts, engine, log)
    return state


def split_batches(images: DataFrame, n_batches: int, path: str | None = None, files: int | None = None) -> list[DataFrame]:
    """Write the images once as ``batch=k`` folders, so that a step reads its batch only.

    Rows of a scan are dealt by row number to ``files`` writers per batch (by default
    the session's shuffle partitions shared out), so a batch or an id that holds a
    third of all rows is still written by many tasks. Rows without an id are dealt over all batches.
    """
    spark = images.sparkSession
    path = path or scratch_path(spark, "batches")
    files = files or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // n_batches)
    number = F.coalesce(F.col("id"), F.monotonically_increasing_id())
    dealt = images.withColumn("batch", F.pmod(number, F.lit(n_batches)).cast("int")).withColumn(
        "_file", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
    dealt.repartition("batch", "_file").drop("_file").write.partitionBy("batch").parquet(path)
    whole = spark.read.schema(StructType([*images.schema.fields, StructField("batch", INT)])).parquet(path)
    return [whole.where(F.col("batch") == k).drop("batch") for k in range(n_batches)]


class ImageStore:
    """Images laid out for steps of one image each: folders ``range=k`` of neighbouring ids, rows sorted by id.

    A step opens the folder of its id alone, and of its files only the row groups whose least and greatest id enclose it.
    Rows are range-partitioned by (id, row number), so an id that holds a third of all rows is written by many tasks.
    Rows without an id are never asked for and are left out. A folder spans ``least`` ids or more, and there are at most ``folders`` of them.
    """

    def __init__(self, images: DataFrame, path: str | None = None, folders: int = 1000, least: int = 4096, group_bytes: int = 8 << 20):
        spark = images.sparkSession
        path = path or scratch_path(spark, "images")
        low, high = images.agg(F.min("id"), F.max("id")).first()
        self.low, self.width = low or 0, max(least, -(-((high or 0) - (low or 0) + 1) // folders))
        known = images.where("id IS NOT NULL").withColumn("_tie", F.monotonically_increasing_id())
        sorted_rows = known.repartitionByRange("id", "_tie").sortWithinPartitions("id").drop("_tie")
        ranged = sorted_rows.withColumn("range", F.floor((F.col("id") - self.low) / self.width).cast("long"))
        ranged.write.option("parquet.block.size", group_bytes).partitionBy("range").parquet(path)
        self.images = spark.read.schema(StructType([*images.schema.fields, StructField("range", LONG)])).parquet(path)

    def one(self, i: int) -> DataFrame:
        """The rows of one id."""
        return self.images.where((F.col("range") == (i - self.low) // self.width) & (F.col("id") == i)).drop("range")


def one_by_one(images: DataFrame | ImageStore, ids: Iterable[int]) -> Iterator[DataFrame]:
    """Batches of one image each, in the order of ``ids``; the filter reaches the Parquet scan.

    Of a plain table a step opens every file; an ``ImageStore`` opens the files of one folder.
    """
    for i in ids:
        yield images.one(i) if isinstance(images, ImageStore) else images.where(F.col("id") == i)


def sweep_step(images: DataFrame, params: DataFrame, variants: DataFrame, chosen: list, net: Network, held: list) -> DataFrame:
    """One step of all variants in one scan: next parameters (variant, layer, out, in, w).

    ``params`` is keyed by variant; ``variants`` has (variant, lr, clip, target), ``chosen`` its rows in order. Few small
    models run as columns side by side, others as one network with a wide first layer and a block-diagonal second.
    Broadcasts are added to ``held``, to be destroyed when the result is written.
    """
    if len(chosen) * net.n_params > MAX_BROADCAST_PARAMS:
        raise ValueError("sweep too large for one scan; split the variants")
    targets = [r["target"] for r in chosen]
    if net.output == "sigmoid" and any(t is None or len(t) != net.n_out for t in targets):
        raise ValueError(f"a sigmoid output needs a target of {net.n_out} values for every variant")
    rows = dict(list(params.limit(len(chosen) * net.n_params + 1).toPandas().groupby("variant")))  # one more shows a surplus
    if len(rows) != len(chosen):
        raise ValueError(f"parameters of {len(rows)} models for {len(chosen)} variants")
    models = [matrices(net, rows[r["variant"]]) for r in chosen]
    if len(chosen) * net.n_params <= MAX_UNROLLED_PARAMS:
        goals = {f"v{i}": tuple(t) for i, t in enumerate(targets) if t is not None}
        sums = unrolled_sums(images, net, {f"v{i}": m for i, m in enumerate(models)}, goals)
        sums = sums.withColumn("model", F.substring("model", 2, 10).cast("int"))
    else:
        sums = stacked_sums(images, net, models, targets if net.output == "sigmoid" else None, held)
    named = images.sparkSession.createDataFrame([(i, r["variant"]) for i, r in enumerate(chosen)], "model int, variant string")
    g = mean_gradients(sums.join(F.broadcast(named), "model"), ["variant"])  # one row per model, bounded above
    rated = params.join(F.broadcast(variants.select("variant", "lr", "clip")), "variant")
    moved = sgd_update(rated, g, "lr", by=["variant"], clip="clip", clip_layers=(2,), update_bias=False,
                       small=True)
    return moved.select("variant", "layer", "out", "in", "w")


def sweep(images: DataFrame, state: State, variants: DataFrame, steps: int, path: str | None = None,
          at_once: int | None = None) -> DataFrame:
    """Train all variants from one start; the last parameters, keyed by variant.

    Each scan carries as many models as fit the broadcast limit (or ``at_once``); more of them take several runs.
    """
    spark = images.sparkSession
    path = path or scratch_path(spark, "sweep")
    rows = variants.select("variant", "lr", "clip", "target").orderBy("variant").collect()  # one per model
    at_once = at_once or max(1, MAX_BROADCAST_PARAMS // state.net.n_params)
    parts = [_sweep(images, state, rows[k:k + at_once], steps, f"{path}/part={k}") for k in range(0, len(rows), at_once)]
    if not parts:
        return state.params.selectExpr("CAST(NULL AS STRING) AS variant", "layer", "out", "`in`", "w").limit(0)
    return reduce(DataFrame.unionByName, parts)


def _sweep(images: DataFrame, state: State, chosen: list, steps: int, path: str) -> DataFrame:
    spark = images.sparkSession
    variants = spark.createDataFrame(chosen, "variant string, lr double, clip double, target array<double>")
    names = [r["variant"] for r in chosen]
    params = state.params.withColumn("variant", F.explode(F.lit(names))).select("variant", "layer", "out", "in", "w")
    for k in range(steps):
        out, held = f"{path}/iter={k + 1}", []
        try:
            sweep_step(images, params, variants, chosen, state.net, held).write.mode("overwrite").parquet(out)
        finally:
            for shipped in held:  # each leaves a file on the driver
                shipped.destroy()
        params = spark.read.schema("variant string, layer int, out int, `in` int, w double").parquet(out)
    return params
