"""Tiled products and barrier training against the other forms, with tiles small enough to need every level."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkgrad.plans import barrier, tiles
from sparkgrad.plans.network import Network, State
from sparkgrad.plans.training import Options, ParamStore, train

ROWS = [(1, 0, [0.5, -1.0, 2.0, 0.1, 0.0]), (1, 2, [1.0, None, 0.3]), (None, 1, [0.2] * 5), (4, None, [0.9, 0.8, 0.7, 0.6, 0.5]), (5, 1, None),
        (6, 0, []), (7, 2, [None] * 5)] + [(10 + k, k % 3, [(k * 7 % 11) / 10.0, k % 5 / 3.0, -k / 40.0, 1.0, 0.3]) for k in range(40)]


def images(spark):
    return spark.createDataFrame(ROWS, "id long, label int, x array<double>").repartition(3)


def numbers(state):
    return {(r["layer"], r["out"], r["in"]): r["w"] for r in state.params.collect()}


def close(one, two):
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(tiles, "TILE", 2)
    monkeypatch.setattr(tiles, "SIDE", 2)
    monkeypatch.setattr(tiles, "DEPTH", 2)


def matrix(spark, m):
    found = [(a, k, m[a * 2:a * 2 + 2, k * 2:k * 2 + 2]) for a in range(-(-m.shape[0] // 2)) for k in range(-(-m.shape[1] // 2))]
    return tiles.Matrix(spark.createDataFrame(tiles.tile_rows(found)), *m.shape)


def dense(m):
    out = np.full((m.n_rows, m.n_cols), np.nan)
    for r in m.tiles.collect():
        part = np.frombuffer(r["data"], "<f8").reshape(r["rows"], r["cols"])
        out[r["a"] * 2:r["a"] * 2 + r["rows"], r["k"] * 2:r["k"] * 2 + r["cols"]] = part
    return out


def test_products_of_all_turns(spark, small):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(7, 19)), rng.normal(size=(5, 19))
    assert np.allclose(dense(tiles.product(matrix(spark, a), matrix(spark, b))), a @ b.T)
    assert np.allclose(dense(tiles.product(matrix(spark, a.copy().T).t, matrix(spark, b.copy().T).t)), a @ b.T)
    with pytest.raises(ValueError):
        tiles.product(matrix(spark, a), matrix(spark, a).t)


@pytest.mark.parametrize("net, opts", [
    (Network(5, 4, 3), Options(lr=0.5)), (Network(5, 3, 3), Options(lr=0.5, delta="half", clip=0.01, update_bias=False)),
    (Network(5, 4, 3, "sigmoid", "sigmoid"), Options(lr=0.5, target=(0.1, 0.5, 0.9)))])
def test_both_forms_train_like_the_block_form(spark, small, net, opts):
    state = State.pattern(spark, net)
    want = numbers(train([images(spark)] * 2, state, ParamStore(spark), opts, "block"))
    close(numbers(tiles.train_tiled(images(spark), state, ParamStore(spark), opts, 2)), want)
    store = ParamStore(spark)
    last = barrier.train_barrier(images(spark), state, store, opts, 2, every=1)
    close(numbers(last), want)
    assert last.iteration == 2 and store.has(1)
    close(numbers(barrier.train_barrier(images(spark), store.load(net, 1), store, opts, 1)), want)  # again from the last version


def test_softmax_over_tiles_of_large_logits(spark, small):
    z = np.array([[700.0, 710.0, -5.0, 0.0, 709.0], [1e4, 0.0, 0.0, 1.0, 1e4]])
    totals = {r["a"]: (r["top"], r["total"]) for r in tiles.softmax_totals(matrix(spark, z)).collect()}
    assert np.allclose(totals[0][0], z.max(axis=1)) and np.allclose(totals[0][1], np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1))


def test_nothing_to_learn_from_leaves_the_parameters(spark):
    net = Network(5, 4, 3)
    state, none = State.pattern(spark, net), images(spark).where("id = 5")
    close(numbers(tiles.train_tiled(none, state, ParamStore(spark), Options(lr=0.5), 2)), numbers(state))
    close(numbers(barrier.train_barrier(none, state, ParamStore(spark), Options(lr=0.5), 2)), numbers(state))


def test_limits_are_errors(spark, monkeypatch):
    state = State.pattern(spark, Network(5, 4, 3))
    with pytest.raises(Exception, match="more than the 5 features"):
        tiles.train_tiled(images(spark).withColumn("x", F.concat("x", "x")), state, ParamStore(spark), Options(), 1)
    with pytest.raises(ValueError):
        tiles.train_tiled(images(spark), state, ParamStore(spark), Options(mask_hidden_bias=False), 1)
    monkeypatch.setattr(barrier, "MAX_EXCHANGED", 10)
    with pytest.raises(ValueError):
        barrier.train_barrier(images(spark), state, ParamStore(spark), Options(), 1)


def test_no_row_per_weight_in_the_products(spark, capsys):
    net = Network(5, 4, 3)
    tiles.product(tiles.image_matrix(images(spark), 5)[0], tiles.weight_matrix(State.pattern(spark, net).params, net, 1)).tiles.explain()
    plan = capsys.readouterr().out
    assert "CoGroupsInArrow" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
