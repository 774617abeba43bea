"""Layers and gradients as products of tiled matrices, for parameter sets beyond a broadcast.

Images, weights, activations and deltas are dense tiles of ``TILE`` x ``TILE`` numbers, one row (a, k, rows, cols, data) each. A product
deals the tiles of both sides over groups of at most ``SIDE`` x ``DEPTH`` tiles, multiplies them in Arrow, and adds the partial
results in a tree of at most ``DEPTH`` tiles a group. No join or shuffle has a row per weight and image; a task
holds a bounded number of tiles, whatever the network and the number of images.

The last input of each layer is the constant 1 that carries the bias. For the second layer it is a hidden unit without weights whose
activation is 1 and which is never updated, so both layers are plain products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.functions import columns as C
from sparkgrad.functions.blocks import activate, to_matrix
from sparkgrad.plans.network import Network, State
from sparkgrad.plans.training import Options, ParamStore, output_deltas
from sparkgrad.session import materialize
from sparkgrad.sources.row_ids import assign_row_ids
from sparkgrad.sources.schemas import BIAS_KEY

TILE = 256
SIDE = 8
DEPTH = 8
TILES = "a int, k int, rows int, cols int, data binary"
ALWAYS_ON = {"relu": 1.0, "sigmoid": 40.0}  # bias of the constant hidden unit: its activation is 1 in doubles
_KIND = pa.schema([("a", pa.int32()), ("k", pa.int32()), ("rows", pa.int32()), ("cols", pa.int32()), ("data", pa.binary())])


def tile_rows(found: list[tuple[int, int, np.ndarray]]) -> pa.Table:
    return pa.table([[a for a, _, _ in found], [k for _, k, _ in found], [m.shape[0] for _, _, m in found], [m.shape[1] for _, _, m in found],
                     [np.ascontiguousarray(m, "<f8").tobytes() for _, _, m in found]], schema=_KIND)


def matrices_of(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    for a, k, rows, cols, data in zip(*[table.column(c).to_pylist() for c in _KIND.names]):
        yield a, k, np.frombuffer(data, "<f8").reshape(rows, cols)


def blocks(n: int) -> int:
    return -(-n // TILE)


@dataclass(frozen=True)
class Matrix:
    """Tiles of an (n_rows x n_cols) matrix; ``flipped`` reads it transposed."""

    tiles: DataFrame
    n_rows: int
    n_cols: int
    flipped: bool = False

    @property
    def t(self) -> Matrix:
        return Matrix(self.tiles, self.n_cols, self.n_rows, not self.flipped)

    def stored(self, name: str) -> Matrix:
        return Matrix(materialize(self.tiles, name), self.n_rows, self.n_cols, self.flipped)

    def _dealt(self, outer: str, others: int) -> DataFrame:
        """Tiles with their group (outer, inner, depth), a copy for each of ``others`` groups of the other side."""
        row, col = ("k", "a") if self.flipped else ("a", "k")
        inner = "right_group" if outer == "left_group" else "left_group"
        return self.tiles.select(
            "*", F.floor(F.col(row) / SIDE).cast("int").alias(outer), F.floor(F.col(col) / DEPTH).cast("int").alias("depth"),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(inner))


def product(left: Matrix, right: Matrix, finish: Callable[[int, int, np.ndarray], np.ndarray] | None = None) -> Matrix:
    """left x right transposed; both have the same number of columns. ``finish`` (row tile, column tile, values) is applied to whole sums."""
    if left.n_cols != right.n_cols:
        raise ValueError(f"the inner sizes {left.n_cols} and {right.n_cols} differ")
    group = ["left_group", "right_group", "depth"]
    lefts = left._dealt("left_group", -(-blocks(right.n_rows) // SIDE)).groupBy(*group)
    rights = right._dealt("right_group", -(-blocks(left.n_rows) // SIDE)).groupBy(*group)
    turn_left, turn_right = left.flipped, right.flipped

    def multiply(one: pa.Table, two: pa.Table) -> pa.Table:
        def by_depth(table: pa.Table, turned: bool) -> dict[int, list[tuple[int, np.ndarray]]]:
            out: dict[int, list[tuple[int, np.ndarray]]] = {}
            for a, k, m in matrices_of(table):
                out.setdefault(a if turned else k, []).append((k, m.T) if turned else (a, m))
            return out

        sums: dict[tuple[int, int], np.ndarray] = {}
        others = by_depth(two, turn_right)
        for depth, mine in by_depth(one, turn_left).items():
            for a, x in mine:
                for b, y in others.get(depth, ()):
                    sums[a, b] = sums[a, b] + x @ y.T if (a, b) in sums else x @ y.T
        return tile_rows([(a, b, m) for (a, b), m in sorted(sums.items())])

    def with_depth(one: pa.Table, two: pa.Table) -> pa.Table:
        done = multiply(one, two)
        depth = (one if len(one) else two).column("depth")[0].as_py()
        return done.append_column("depth", pa.array([depth] * len(done), pa.int32()))

    parts = lefts.cogroup(rights).applyInArrow(with_depth, f"{TILES}, depth int")
    left_over = -(-blocks(left.n_cols) // DEPTH)
    while left_over > DEPTH:
        parts = _summed(parts.withColumn("depth", F.floor(F.col("depth") / DEPTH).cast("int")))
        left_over = -(-left_over // DEPTH)
    return Matrix(_summed(parts.withColumn("depth", F.lit(0)), finish).drop("depth"), left.n_rows, right.n_rows)


def _summed(parts: DataFrame, finish: Callable[[int, int, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    def add(table: pa.Table) -> pa.Table:
        found = list(matrices_of(table))
        a, k, _ = found[0]
        total = np.sum([m for _, _, m in found], axis=0)
        done = tile_rows([(a, k, finish(a, k, total) if finish else total)])
        return done.append_column("depth", table.column("depth").slice(0, 1).combine_chunks())

    return parts.groupBy("a", "k", "depth").applyInArrow(add, f"{TILES}, depth int")


def pairwise(one: Matrix, two: Matrix, body: Callable[[int, int, np.ndarray, np.ndarray], np.ndarray]) -> Matrix:
    """Tile by tile from two matrices of one shape; a tile that ``two`` lacks counts as zeros."""
    def join(x: pa.Table, y: pa.Table) -> pa.Table:
        second = next((m for _, _, m in matrices_of(y)), None)
        return tile_rows([(a, k, body(a, k, m, np.zeros(m.shape) if second is None else second)) for a, k, m in matrices_of(x)])

    return Matrix(one.tiles.groupBy("a", "k").cogroup(two.tiles.groupBy("a", "k")).applyInArrow(join, TILES), one.n_rows, one.n_cols)


def image_matrix(images: DataFrame, n_in: int) -> tuple[Matrix, DataFrame]:
    """Features of the images with a known one, and the constant 1, as tiles; and (a, ids, labels) per row of tiles.

    Images are numbered in scan order, so a hot id is spread like any other.
    """
    known = materialize(images.where(C.has_value("x")).select("id", "label", "x"), "tiled-images")
    n = known.count()
    numbered = assign_row_ids(known, "_row").withColumn("a", F.floor((F.col("_row") - 1) / TILE).cast("int"))

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by("_row")
        a = table.column("a")[0].as_py()
        x, _ = to_matrix(table.column("x").combine_chunks(), n_in)
        x = np.hstack([x, np.ones((len(x), 1))])
        found = tile_rows([(a, k, x[:, k * TILE:(k + 1) * TILE]) for k in range(blocks(n_in + 1))])
        ids, labels = (pa.array([table.column(c).to_pylist()] + [None] * (len(found) - 1), pa.list_(kind))
                       for c, kind in (("id", pa.int64()), ("label", pa.int32())))
        return found.append_column("ids", ids).append_column("labels", labels)

    tiles = materialize(numbered.groupBy("a").applyInArrow(cut, f"{TILES}, ids array<long>, labels array<int>"), "tiles")
    return Matrix(tiles.select("a", "k", "rows", "cols", "data"), n, n_in + 1), tiles.where("ids IS NOT NULL").select("a", "ids", "labels")


def weight_matrix(params: DataFrame, net: Network, layer: int) -> Matrix:
    """Parameter rows of a layer as tiles with the bias as last input; the first layer gets the constant unit as last output."""
    n_in, n_out = net.width(layer)
    extra = layer == 1
    rows = params.where(F.col("layer") == layer).select("out", F.when(F.col("in") == BIAS_KEY, n_in).otherwise(F.col("in")).alias("at"), "w")
    if extra:
        constant = params.sparkSession.range(n_in + 1).selectExpr(
            f"{n_out} AS out", "CAST(id AS INT) AS at", f"CASE WHEN id = {n_in} THEN {ALWAYS_ON[net.hidden]}D ELSE 0D END AS w")
        rows = rows.unionByName(constant)
    shape = (n_out + extra, n_in + 1)

    def fill(table: pa.Table) -> pa.Table:
        out, at, w = (table.column(c).to_numpy() for c in ("out", "at", "w"))
        a, k = int(out[0]) // TILE, int(at[0]) // TILE
        m = np.full((min(TILE, shape[0] - a * TILE), min(TILE, shape[1] - k * TILE)), np.nan)
        m[out - a * TILE, at - k * TILE] = w
        if len(out) != m.size or np.isnan(m).any():
            raise ValueError(f"layer {layer}: tile {a}, {k} lacks a parameter or repeats one")
        return tile_rows([(a, k, m)])

    tiles = rows.groupBy(F.floor(F.col("out") / TILE).alias("a"), F.floor(F.col("at") / TILE).alias("k")).applyInArrow(fill, TILES)
    return Matrix(tiles, *shape)


def parameter_rows(weights: dict[int, Matrix], net: Network) -> DataFrame:
    """(layer, out, in, w) of both layers."""
    def rows(layer: int) -> DataFrame:
        n_in, n_out = net.width(layer)

        def spread(table: pa.Table) -> pa.Table:
            parts = []
            for a, k, m in matrices_of(table):
                out, at = np.indices(m.shape)
                parts.append(np.stack([(out + a * TILE).ravel(), (at + k * TILE).ravel(), m.ravel()]))
            out, at, w = np.hstack(parts)
            real = out < n_out
            at = np.where(at == n_in, BIAS_KEY, at)
            return pa.table([pa.array(np.full(real.sum(), layer), pa.int32()), pa.array(out[real], pa.int32()), pa.array(at[real], pa.int32()),
                             pa.array(w[real])], ["layer", "out", "in", "w"])

        return weights[layer].tiles.groupBy("a", "k").applyInArrow(spread, "layer int, out int, `in` int, w double")

    return rows(1).unionByName(rows(2))


def hidden(x: Matrix, w1: Matrix, net: Network) -> Matrix:
    return product(x, w1, lambda a, k, z: activate(net.hidden, z))


def softmax_totals(z: Matrix) -> DataFrame:
    """(a, top, total): per image the largest logit and the sum of exp(z - top), merged from one pair per tile."""
    def pair(table: pa.Table) -> pa.Table:
        (a, _, m), = matrices_of(table)
        top = m.max(axis=1)
        return pa.table([pa.array([a], pa.int32()), pa.array([top]), pa.array([np.exp(m - top[:, None]).sum(axis=1)])], ["a", "top", "total"])

    def merge(table: pa.Table) -> pa.Table:
        tops, totals = (np.array(table.column(c).to_pylist()) for c in ("top", "total"))
        top = tops.max(axis=0)
        return pa.table([table.column("a").slice(0, 1).combine_chunks(), pa.array([top]), pa.array([(totals * np.exp(tops - top)).sum(axis=0)])],
                        ["a", "top", "total"])

    kind = "a int, top array<double>, total array<double>"
    return z.tiles.groupBy("a", "k").applyInArrow(pair, kind).groupBy("a").applyInArrow(merge, kind)


def output_delta_matrix(z: Matrix, meta: DataFrame, net: Network, opts: Options) -> Matrix:
    """Deltas of the output layer from its logits."""
    rows = z.tiles.join(meta.withColumnRenamed("a", "i"), F.col("a") == F.col("i")).drop("i", "ids")
    if net.output == "softmax":
        rows = rows.join(softmax_totals(z).withColumnRenamed("a", "i"), F.col("a") == F.col("i")).drop("i")

    def delta(table: pa.Table) -> pa.Table:
        (a, k, m), = matrices_of(table)
        if net.output == "sigmoid":
            part = Options(target=opts.target[k * TILE:(k + 1) * TILE])
            return tile_rows([(a, k, output_deltas(net, part, activate("sigmoid", m), np.zeros(0)))])
        top, total = (np.array(table.column(c)[0].as_py())[:, None] for c in ("top", "total"))
        label = np.array([-1 if v is None else v for v in table.column("labels")[0].as_py()])
        error = np.exp(m - top) / total - (label[:, None] == np.arange(k * TILE, k * TILE + m.shape[1]))
        return tile_rows([(a, k, 2.0 * error if opts.delta == "sq2" else error)])

    return Matrix(rows.groupBy("a", "k").applyInArrow(delta, TILES), z.n_rows, z.n_cols)


def gradient_matrices(x: Matrix, meta: DataFrame, weights: dict[int, Matrix], net: Network, opts: Options) -> dict[int, Matrix]:
    """Sums of the gradients over all images, in the weights' tiles."""
    a = hidden(x, weights[1], net).stored("tiled-hidden")
    z = product(a, weights[2]).stored("tiled-logits")
    d2 = output_delta_matrix(z, meta, net, opts).stored("tiled-deltas")
    error = product(d2, weights[2].t)
    constant = net.n_hidden

    def slope(i: int, k: int, e: np.ndarray, h: np.ndarray) -> np.ndarray:
        d = e * (h > 0) if net.hidden == "relu" else e * h * (1.0 - h)
        if k == constant // TILE:
            d[:, constant % TILE] = 0.0
        return d

    d1 = pairwise(error, a, slope).stored("tiled-hidden-deltas")
    return {1: product(d1.t, x.t), 2: product(d2.t, a.t)}


def train_tiled(images: DataFrame, state: State, store: ParamStore, opts: Options, steps: int) -> State:
    """``steps`` gradient steps over all images. Images become tiles once, parameters stay tiles between the steps; the last version is
    saved as rows."""
    if opts.hidden_error_weights != "old" or not opts.mask_hidden_bias:
        raise ValueError("the tiled form has the textbook order of updates only")
    net = state.net
    x, meta = image_matrix(images, net.n_in)
    weights = {layer: weight_matrix(state.params, net, layer).stored("tiled-weights") for layer in (1, 2)}
    n = x.n_rows

    def update(layer: int) -> Callable[[int, int, np.ndarray, np.ndarray], np.ndarray]:
        bias = net.width(layer)[0]

        def move(a: int, k: int, w: np.ndarray, g: np.ndarray) -> np.ndarray:
            g = g / n
            if opts.clip is not None and layer in opts.clip_layers:
                g = np.clip(g, -opts.clip, opts.clip)
            if not opts.update_bias and k == bias // TILE:
                g[:, bias % TILE] = 0.0
            return w - opts.lr * g

        return move

    for _ in range(steps if n else 0):
        g = gradient_matrices(x, meta, weights, net, opts)
        weights = {layer: pairwise(weights[layer], g[layer], update(layer)).stored("tiled-weights") for layer in (1, 2)}
    return store.save(net, parameter_rows(weights, net), state.iteration + steps)


def dense_tiled(images: DataFrame, state: State) -> DataFrame:
    """(id, out, z) of the first layer for all images with a known feature."""
    net = state.net
    x, meta = image_matrix(images, net.n_in)
    z = product(x, weight_matrix(state.params, net, 1))
    rows = z.tiles.join(meta.withColumnRenamed("a", "i"), F.col("a") == F.col("i"))

    def spread(table: pa.Table) -> pa.Table:
        (_, k, m), = matrices_of(table)
        out = np.arange(k * TILE, k * TILE + m.shape[1])
        m, out = m[:, out < net.n_hidden], out[out < net.n_hidden]
        ids = pa.array(table.column("ids")[0].as_py(), pa.int64()).take(pa.array(np.repeat(np.arange(len(m)), len(out))))
        return pa.table([ids, pa.array(np.tile(out, len(m)), pa.int32()), pa.array(m.ravel())], ["id", "out", "z"])

    return rows.groupBy("a", "k").applyInArrow(spread, "id long, out int, z double")
