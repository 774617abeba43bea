"""All forms of a layer agree, on ordinary and on awkward inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkgrad.operators import init, layers, reports, reshape
from sparkgrad.plans.forward import predict, score
from sparkgrad.plans.network import Network, State
from sparkgrad.plans.training import Options, gradients

NET = Network(5, 4, 3)
ENGINES = ["array", "block", "long", "columns"]
SCHEMA = "id long, label int, x array<double>"


@pytest.fixture(scope="module")
def state(spark):
    return State.pattern(spark, NET)


@pytest.fixture(scope="module")
def images(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), [float(v) for v in rng.normal(size=5)]) for i in range(40)]
    rows += [
        (100, 1, [1.0, None, 2.0, None, 0.5]),       # NULL features are skipped
        (101, 2, [1000.0, -1000.0, 900.0, 1.0, 2.0]),  # large inputs stay finite
        (102, 0, [0.0, 0.0, 0.0, 0.0, 0.0]),
        (103, None, [0.1, 0.2, 0.3, 0.4, 0.5]),       # no label
        (104, 1, [None, None, None, None, None]),      # nothing known
        (105, 1, [0.3, 0.2]),                          # short
        (106, 2, []),                                  # empty
        (107, 2, None),                                # no features at all
    ]
    return spark.createDataFrame(rows, SCHEMA)


def shares(df):
    return {r["id"]: [float("nan") if v is None else v for v in r["p"]] for r in df.collect()}


@pytest.mark.parametrize("engine", ENGINES)
def test_forward_matches_numpy(images, state, engine):
    m = state.arrays()
    got = shares(score(images, state, engine))
    for row in images.collect():
        given = row["x"] or []
        x = np.array([v or 0.0 for v in given] + [0.0] * (5 - len(given)))
        h = np.maximum(m["w1"] @ x + m["b1"], 0)
        z = m["w2"] @ h + m["b2"]
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        if all(v is None for v in given):
            assert np.isnan(got[row["id"]]).all()
        else:
            assert got[row["id"]] == pytest.approx(list(p), abs=1e-12)
            assert sum(got[row["id"]]) == pytest.approx(1.0)


def loss(m, x, label):
    h = np.maximum(m["w1"] @ x + m["b1"], 0)
    z = m["w2"] @ h + m["b2"]
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return -np.log(p[label])


@pytest.mark.parametrize("engine", ENGINES)
def test_a_surplus_feature_is_an_error(spark, state, engine):
    images = spark.createDataFrame([(1, 1, [1.0] * 5), (2, 1, [1.0] * 6)], SCHEMA)
    assert [tuple(r) for r in reports.width_violations(images, 5).collect()] == [(2, 6)]
    with pytest.raises(Exception, match="more than the 5 features"):
        score(images, state, engine).collect()


@pytest.mark.parametrize("engine", ENGINES)
def test_repeated_ids_stay_apart(spark, state, engine):
    images = spark.createDataFrame([(1, 1, [1.0] * 5), (1, 1, [2.0] * 5), (1, 1, [1.0] * 5), (None, None, [0.5] * 5)], SCHEMA)
    got = sorted([round(v, 9) for v in r["p"]] for r in score(images, state, engine).collect())
    want = sorted([round(v, 9) for v in r["p"]] for r in score(images, state, "array").collect())
    assert len(got) == 4 and got == want


@pytest.mark.parametrize("engine", ["array", "block", "columns"])
def test_wrong_parameter_sets_are_errors(spark, images, state, engine):
    for params in (state.params.union(state.params), state.params.where("NOT (layer = 1 AND out = 0 AND `in` = 2)")):
        with pytest.raises(Exception, match="parameter"):
            score(images, State(NET, params), engine).collect()


@pytest.mark.parametrize("engine", ["array", "block", "columns", "long"])
def test_gradients_match_finite_differences(images, state, engine):
    """``half`` is the exact cross-entropy gradient, ``sq2`` twice that."""
    labelled = images.where("id < 40")
    rows = labelled.collect()
    m = state.arrays()
    half = {(r["layer"], r["out"], r["in"]): r["g"] for r in gradients(labelled, state, Options(delta="half"), engine).collect()}
    twice = {(r["layer"], r["out"], r["in"]): r["g"] for r in gradients(labelled, state, Options(), engine).collect()}
    assert len(half) == NET.n_params
    for (layer, out, at), g in half.items():
        sides = []
        for eps in (1e-6, -1e-6):
            moved = {k: v.copy() for k, v in m.items()}
            if at == -1:
                moved[f"b{layer}"][out] += eps
            else:
                moved[f"w{layer}"][out, at] += eps
            sides.append(np.mean([loss(moved, np.array(r["x"]), r["label"]) for r in rows]))
        assert g == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-6)
        assert twice[layer, out, at] == pytest.approx(2 * g, abs=1e-12)


@pytest.mark.parametrize("engine", ["array", "block", "columns", "long"])
def test_awkward_rows_train_alike(images, state, engine):
    want = gradients(images, state, Options(), "array").orderBy("layer", "out", "in").toPandas()["g"]
    got = gradients(images.repartition(5), state, Options(), engine).orderBy("layer", "out", "in").toPandas()["g"]
    assert np.abs(want - got).max() < 1e-9


def test_wide_layers_use_blocks_of_sums(spark):
    net = Network(6, 70, 3)
    state = State.pattern(spark, net)
    rng = np.random.default_rng(5)
    images = spark.createDataFrame(
        [(i, i % 3, [float(v) for v in rng.normal(size=6)]) for i in range(20)], SCHEMA)
    a, b = (gradients(images, state, Options(), e).orderBy("layer", "out", "in").toPandas() for e in ("array", "block"))
    assert len(a) == len(b) == net.n_params
    assert np.abs(a["g"] - b["g"]).max() < 1e-9
    left, right = shares(score(images, state, "long")), shares(score(images, state, "block"))
    assert all(left[i] == pytest.approx(right[i], abs=1e-12) for i in left)


def test_shuffled_layer_equals_broadcast(images, state):
    x = reshape.to_long(images, "id")
    beyond = layers.dense_rows(x, state.weights(1), state.biases(1), keys=["id"], n_weights=20, broadcast_limit=0, n_out=4)
    plan = beyond._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # the biases
    frames = [layers.dense_rows(x, state.weights(1), state.biases(1), keys=["id"], n_weights=20, broadcast_limit=limit)
              .orderBy("id", "out").toPandas() for limit in (1000, 0)]
    assert np.allclose(frames[0]["z"], frames[1]["z"], atol=1e-12, equal_nan=True)


def test_image_without_matching_weights_stays(spark, state):
    stray = spark.createDataFrame([(1, 99, 5.0), (2, 0, 1.0)], "id long, `in` int, v double")
    rows = layers.dense_packed(stray, state.weights(1), state.biases(1), keys=["id"], n_in=5, n_out=4).collect()
    z = {r["id"]: r["z"] for r in rows}
    assert z[1] == [None] * 4 and None not in z[2]


@pytest.mark.parametrize("limit", [1000, 0])
def test_hot_id_is_summed_exactly(spark, state, limit):
    """One key with most of the rows: the sums are those of all its rows."""
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE -1 END AS id", "CAST(id % 5 AS INT) AS `in`", "1D AS v")
    z = layers.dense_rows(rows, state.weights(1), state.biases(1), keys=["id"], n_weights=20, broadcast_limit=limit).where("id = -1").collect()
    counts = [sum(1 for i in range(9000) if i % 3 and i % 5 == k) for k in range(5)]
    m = state.arrays()
    want = m["w1"] @ np.array(counts, dtype=float) + m["b1"]
    assert {r["out"]: r["z"] for r in z} == pytest.approx(dict(enumerate(want)), abs=1e-6)


@pytest.mark.parametrize("engine", ENGINES)
def test_ties_go_to_the_lowest_label(spark, engine):
    flat = init.literal_params(spark, [[0.0] * 5] * 4, [0.0] * 4, [[0.0] * 4] * 3, [1.0, 1.0, 1.0])
    images = spark.createDataFrame([(1, 2, [1.0, 2.0, 3.0, 4.0, 5.0])], SCHEMA)
    assert predict(images, State(NET, flat), engine).first()["prediction"] == 0


def test_default_engine_by_size():
    assert Network(2, 2, 2).engine == "columns"
    assert Network(784, 10, 10).engine == "block"
    assert Network(100_000, 1000, 10).engine == "long"


def test_he_weights_stay_in_bounds(spark):
    net = Network(50, 20, 5)
    w = init.he_params(spark, net).where("`in` >= 0")
    assert w.where("layer = 1 AND abs(w) > sqrt(6 / 50D)").count() == 0
    assert w.where("layer = 2 AND abs(w) > sqrt(6 / 20D)").count() == 0
    assert w.select("w").distinct().count() > 1000
    again = init.he_params(spark, net).where("`in` >= 0").repartition(3)
    assert w.exceptAll(again).count() == 0  # the same draws under another partitioning


def test_state_rejects_wrong_parameters(spark, state):
    with pytest.raises(ValueError):
        State.checked(NET, state.params.limit(10))
    with pytest.raises(ValueError):
        State.checked(NET, state.params.union(state.params))
    assert State.checked(NET, state.params).net == NET


def test_long_form_of_narrow_images_takes_more_tasks_with_more_images(spark, monkeypatch):
    rows = [(i % 7, i % 3, None if i % 11 == 0 else [float(i % k) for k in (2, 3, 5, 7)][:i % 5]) for i in range(600)]
    many = spark.createDataFrame(rows, "id long, label int, x array<double>").coalesce(1)
    start = State.pattern(spark, Network(4, 3, 3))
    monkeypatch.setattr("sparkgrad.plans.forward._IMAGES", 10)
    scored = score(many, start, "long")
    held = [r["count"] for r in scored.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 600 and max(held) <= 60
    rounded = lambda df: sorted(str((r["id"], r["label"], r["p"] and [None if v is None else round(v, 9) for v in r["p"]])) for r in df.collect())
    assert rounded(scored) == rounded(score(many, start, "array"))
