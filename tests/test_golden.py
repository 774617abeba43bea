"""Numbers of the worked example: one input pair (.05, .10)."""

import pytest
from pyspark.sql import functions as F

from sparkgrad.catalog.sigmoid import PAIR, VARIANT_SCHEMA, VARIANTS, seed_state
from sparkgrad.operators import layers, reshape
from sparkgrad.plans.network import activations
from sparkgrad.plans.training import Options, ParamStore, sweep, train

STEP_1 = {
    "lr_050": ([.359232954, .461761626, .458984588, .561833281], [.149776012, .249717831, .199552024, .299435662]),
    "lr_025": ([.395718100, .440274113, .495692014, .540214860], [.149876163, .249848110, .199752325, .299696219]),
    "lr_010": ([.394466516, .449812930, .494432804, .549811790], [.149953275, .249941808, .199906551, .299883616]),
}
STEP_10 = {
    "lr_050": ([-.023969852, .558507178, .073458940, .659165368], [.149296760, .248669601, .198593521, .297339202]),
    "lr_025": ([.357857240, .352653984, .457601008, .452062117], [.148869219, .248590170, .197738439, .297180340]),
    "lr_010": ([.344440934, .448147463, .444102732, .548136186], [.149559363, .249444362, .199118726, .298888724]),
}


@pytest.fixture(scope="module")
def example(spark):
    return spark.createDataFrame([(1, None, [0.05, 0.10])], "id long, label int, x array<double>")


def test_forward(spark, example):
    row = activations(example, seed_state(spark)).first()
    assert row["a"] == pytest.approx([0.5932699921071872, 0.596884378259767], abs=1e-14)
    assert row["p"] == pytest.approx([0.7568985138058796, 0.7676801170808158], abs=1e-14)
    loss = sum((t - p) ** 2 / 2 for t, p in zip((0.01, 0.99), row["p"]))
    assert loss == pytest.approx(0.3036417601333157, abs=1e-14)


def test_forward_with_keys_as_written(spark, example):
    """Output weights summed by hidden node and matched to the output of the same number."""
    state = seed_state(spark)
    a = reshape.array_to_rows(activations(example, state), ["id"], "a", "in", "v")
    turned = state.weights(2).select(F.col("in").alias("out"), F.col("out").alias("in"), "w")
    z = layers.dense_rows(a, turned, state.biases(2), keys=["id"], n_weights=4, join_key="out")
    p = [r["a"] for r in layers.sigmoid_rows(z, ["id"]).orderBy("out").collect()]
    assert p == pytest.approx([0.7510610946667139, 0.7732454894202496], abs=1e-14)


def weights(rows):
    """W2 and W1 in the order (1,1), (1,2), (2,1), (2,2) of (from, to)."""
    by_key = {(r["layer"], r["in"], r["out"]): r["w"] for r in rows}
    return [[by_key[layer, i, o] for i in (0, 1) for o in (0, 1)] for layer in (2, 1)]


@pytest.mark.parametrize("steps, golden", [(1, STEP_1), (10, STEP_10)])
def test_variants(spark, example, steps, golden):
    trained = sweep(example, seed_state(spark), spark.createDataFrame(VARIANTS, VARIANT_SCHEMA), steps).collect()
    for name, expected in golden.items():
        w2, w1 = weights([r for r in trained if r["variant"] == name])
        assert w2 == pytest.approx(expected[0], abs=1e-8)
        assert w1 == pytest.approx(expected[1], abs=1e-8)


def test_variants_by_generator(spark, example, monkeypatch):
    """The form for many or large models gives the same numbers."""
    monkeypatch.setattr("sparkgrad.plans.training.MAX_UNROLLED_PARAMS", 0)
    trained = sweep(example, seed_state(spark), spark.createDataFrame(VARIANTS, VARIANT_SCHEMA), 1).collect()
    for name, expected in STEP_1.items():
        w2, w1 = weights([r for r in trained if r["variant"] == name])
        assert w2 == pytest.approx(expected[0], abs=1e-8)
        assert w1 == pytest.approx(expected[1], abs=1e-8)


@pytest.mark.parametrize("engine", ["array", "block", "columns"])
def test_one_step_by_engine(spark, example, engine):
    opts = Options(lr=0.5, update_bias=False, target=(0.01, 0.99))
    state = train([example], seed_state(spark), ParamStore(spark), opts, engine)
    w2, w1 = weights(state.params.collect())
    assert w2 == pytest.approx(STEP_1["lr_050"][0], abs=1e-8)
    assert w1 == pytest.approx(STEP_1["lr_050"][1], abs=1e-8)
    assert PAIR.n_params == state.params.count()
