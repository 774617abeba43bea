"""Training loops, state versions and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkgrad.operators.reports import accuracy
from sparkgrad.plans import training
from sparkgrad.plans.forward import predict
from sparkgrad.plans.network import Network, State
from sparkgrad.plans.stacked import stacked_sums
from sparkgrad.plans.training import Options, ParamStore, train
from sparkgrad.session import scratch_path
from sparkgrad.sources import readers
from sparkgrad.sources.sinks import read_log
from sparkgrad.streaming import online

NET = Network(4, 3, 3)


@pytest.fixture(scope="module")
def images(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, [float(v) for v in rng.normal(size=4)]) for i in range(30)]
    return spark.createDataFrame(rows, "id long, label int, x array<double>")


def params(state):
    return state.params.orderBy("layer", "out", "in").toPandas()["w"].to_numpy()


def numpy_step(m, xs, labels, lr):
    h = np.maximum(xs @ m["w1"].T + m["b1"], 0)
    z = h @ m["w2"].T + m["b2"]
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    d2 = 2 * (p - np.eye(3)[labels])
    d1 = (d2 @ m["w2"]) * (h > 0)
    n = len(xs)
    return {"w1": m["w1"] - lr * d1.T @ xs / n, "b1": m["b1"] - lr * d1.mean(0),
            "w2": m["w2"] - lr * d2.T @ h / n, "b2": m["b2"] - lr * d2.mean(0)}


def flat(m):
    return np.concatenate([np.hstack([m[f"b{k}"][:, None], m[f"w{k}"]]).ravel() for k in (1, 2)])


def test_one_image_per_step_follows_the_sequence(spark, images):
    start = State.pattern(spark, NET)
    m = start.arrays()
    for i in (3, 4, 5):
        row = images.where(f"id = {i}").first()
        m = numpy_step(m, np.array([row["x"]]), [row["label"]], 0.1)
    end = train(training.one_by_one(images, (3, 4, 5)), start, ParamStore(spark), Options(lr=0.1))
    assert end.iteration == 3
    assert params(end) == pytest.approx(flat(m), abs=1e-12)


def test_batches_cover_every_image_once(spark, images):
    batches = training.split_batches(images, 4)
    ids = sorted(r["id"] for b in batches for r in b.collect())
    assert ids == list(range(30))
    assert all("PartitionFilters: [isnotnull(batch" in b._jdf.queryExecution().toString() for b in batches)


def test_zero_rate_and_empty_batch_change_nothing(spark, images):
    start = State.pattern(spark, NET)
    for engine in ("array", "block", "columns"):
        assert params(train([images], start, ParamStore(spark), Options(lr=0.0), engine)) == pytest.approx(params(start))
        assert params(train([images.where("id < 0")], start, ParamStore(spark), Options(lr=1.0), engine)) == pytest.approx(params(start))


def test_image_order_does_not_matter(spark, images):
    start = State.pattern(spark, NET)
    a = params(train([images], start, ParamStore(spark), Options(lr=0.5)))
    b = params(train([images.orderBy("label").repartition(7)], start, ParamStore(spark), Options(lr=0.5)))
    assert a == pytest.approx(b, abs=1e-9)


def test_versions_are_kept_and_replaced(spark, images):
    store = ParamStore(spark)
    end = params(train([images] * 2, State.pattern(spark, NET), store, Options(lr=0.5)))
    again = training.step(images, store.load(NET, 1), store, Options(lr=0.5))  # step 2 runs again
    assert params(again) == pytest.approx(end, abs=1e-12)
    history = store.history().groupBy("iter").count().orderBy("iter").collect()
    assert [(r["iter"], r["count"]) for r in history] == [(k, NET.n_params) for k in range(3)]


def test_training_lowers_the_loss(spark, images):
    from sparkgrad.operators.losses import cross_entropy
    from sparkgrad.plans.forward import logits

    start = State.pattern(spark, NET)
    end = train([images] * 5, start, ParamStore(spark), Options(lr=0.2))
    before, after = (cross_entropy(logits(images, s)).first()[0] for s in (start, end))
    assert after < before


def test_loss_counts_shares_that_underflow(spark):
    from sparkgrad.operators.losses import cross_entropy

    rows = spark.createDataFrame([(0, [0.0, 1000.0]), (1, [0.0, 0.0]), (None, [1.0, 2.0]), (1, [None, None])], "label int, z array<double>")
    assert cross_entropy(rows).first()[0] == pytest.approx((1000 + np.log(2)) / 2)


@pytest.mark.parametrize("engine", ["array", "block", "columns", "long"])
def test_log_of_a_run(spark, images, engine):
    log, start = training.TrainLog(spark), State.pattern(spark, NET)
    train([images, images.where("id < 7")], start, ParamStore(spark), Options(lr=0.1), engine, log)
    rows = log.read().collect()
    assert sorted((r["iter"], r["id"]) for r in rows) == [(0, i) for i in range(30)] + [(1, i) for i in range(7)]
    assert all(r["insert_time"] is not None and r["prediction"] == int(np.argmax(r["p"])) for r in rows)
    means = {(r["iter"], r["unit"]): r["value"] for r in log.means("a").collect()}
    assert means[0, 1] == pytest.approx(np.mean([r["a"][1] for r in rows if r["iter"] == 0]))


@pytest.mark.parametrize("engine", ["array", "block", "long"])
@pytest.mark.parametrize("mask", [True, False])
def test_updated_weights_in_every_form(spark, images, engine, mask):
    opts = Options(lr=0.3, hidden_error_weights="updated", mask_hidden_bias=mask)
    start = State.pattern(spark, NET)
    m = start.arrays()
    xs, y = np.array([r["x"] for r in images.orderBy("id").collect()]), np.arange(30) % 3
    h = np.maximum(xs @ m["w1"].T + m["b1"], 0)
    z = h @ m["w2"].T + m["b2"]
    p = np.exp(z - z.max(1, keepdims=True))
    d2 = 2 * (p / p.sum(1, keepdims=True) - np.eye(3)[y])
    w2 = m["w2"] - 0.3 * d2.T @ h / 30
    e = d2 @ w2
    d1 = e * (h > 0)
    want = {"w1": m["w1"] - 0.3 * d1.T @ xs / 30, "b1": m["b1"] - 0.3 * (d1 if mask else e).mean(0), "w2": w2, "b2": m["b2"] - 0.3 * d2.mean(0)}
    assert params(training.step(images, start, ParamStore(spark), opts, engine)) == pytest.approx(flat(want), abs=1e-12)


def test_long_gradients_beyond_a_broadcast(spark, images):
    start = State.pattern(spark, NET)
    want = training.gradients(images, start, Options(), "array").orderBy("layer", "out", "in").toPandas()["g"]
    got = training.long_gradients(images, start, Options(), broadcast_limit=0).orderBy("layer", "out", "in").toPandas()["g"]
    assert np.abs(want - got).max() < 1e-9


def test_rows_without_an_id_are_in_one_batch(spark):
    rows = spark.createDataFrame([(None, 1, [1.0]), (None, 1, [2.0]), (3, 1, [3.0])], "id long, label int, x array<double>")
    found = [r["x"][0] for b in training.split_batches(rows, 2) for r in b.collect()]
    assert sorted(found) == [1.0, 2.0, 3.0]


def test_step_leaves_no_broadcast(spark, images, monkeypatch):
    gone = []
    kind = type(spark.sparkContext.broadcast(0))
    monkeypatch.setattr(kind, "destroy", lambda self, blocking=False: gone.append(self))
    train([images] * 3, State.pattern(spark, NET), ParamStore(spark), Options(lr=0.1), "block")
    assert len(gone) == 3


def test_sweep_of_softmax_and_odd_names(spark, images):
    variants = spark.createDataFrame([("a'b", 0.1, None, None), ("c", 0.01, None, None)], "variant string, lr double, clip double, target array<double>")
    small, wide = State.pattern(spark, NET), State.pattern(spark, Network(4, 9, 3))
    for start in (small, wide):
        got = training.sweep(images, start, variants, 2)
        for name, lr in (("a'b", 0.1), ("c", 0.01)):
            want = train([images] * 2, start, ParamStore(spark), Options(lr=lr, update_bias=False))
            mine = got.where(got["variant"] == name).orderBy("layer", "out", "in").toPandas()["w"].to_numpy()
            assert mine == pytest.approx(params(want), abs=1e-9)
    apart = training.sweep(images, small, variants, 2, at_once=1)
    assert apart.exceptAll(training.sweep(images, small, variants, 2)).count() == 0
    assert training.sweep(images, small, variants.limit(0), 2).count() == 0


@pytest.fixture(scope="module")
def stream_files(spark, images):
    path = scratch_path(spark, "stream-in")
    for part in range(3):
        images.where(f"id % 3 = {part}").coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema("id long, label int, x array<double>").option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_scores_every_image_once(spark, images, stream_files):
    log, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "cp")
    for _ in range(2):  # the second start finds nothing new
        online.score_stream(stream(spark, stream_files), State.pattern(spark, NET), log, checkpoint).awaitTermination()
    rows = read_log(spark, log).collect()
    assert sorted(r["id"] for r in rows) == list(range(30))
    assert {r["iter"] for r in rows} == {0, 1, 2}


@pytest.mark.parametrize("layout", ["file", "folder", "partitioned"])
def test_stream_of_a_table_in_one_file_or_many(spark, images, tmp_path, layout):
    rows = images.selectExpr("id AS vec_id", "CAST(x AS ARRAY<FLOAT>) AS embedding", "label")
    table = tmp_path / "embeddings.parquet"
    if layout == "file":
        rows.coalesce(1).write.parquet(str(tmp_path / "written"))
        table.write_bytes(next((tmp_path / "written").glob("part-*")).read_bytes())
    else:
        writer = rows.repartition(3).write
        (writer.partitionBy("label") if layout == "partitioned" else writer).parquet(str(table))
    rows.write.parquet(str(tmp_path / "other.parquet"))  # no part of the table
    stream_rows, log = online.embedding_stream(spark, str(tmp_path)), scratch_path(spark, "log")
    assert stream_rows.isStreaming and stream_rows.schema == readers.embedding_images(spark, str(tmp_path)).schema
    state = State.pattern(spark, NET)
    online.score_stream(stream_rows, state, log, scratch_path(spark, "cp")).awaitTermination()
    got = sorted((r["id"], r["label"], r["prediction"], r["iter"]) for r in read_log(spark, log).collect())
    assert got == sorted((r["id"], r["label"], r["prediction"], 0) for r in predict(readers.embedding_images(spark, str(tmp_path)), state).collect())
    assert len(got) == 30


def test_stream_trains_one_step_per_batch(spark, images, stream_files):
    store, checkpoint = ParamStore(spark), scratch_path(spark, "cp")
    start = State.pattern(spark, NET)
    online.train_stream(stream(spark, stream_files), start, store, Options(lr=0.1), checkpoint).awaitTermination()
    files = sorted(r["f"] for r in spark.read.parquet(stream_files).selectExpr("_metadata.file_path AS f").distinct().collect())
    assert store.history().select("iter").distinct().count() == len(files) + 1 == 4
    # A replayed micro-batch gives the same version again.
    before = params(store.load(NET, 3))
    last_ids = None
    for part in range(3):
        batch = images.where(f"id % 3 = {part}")
        state = training.step(batch, store.load(NET, 2), ParamStore(spark), Options(lr=0.1))
        if np.allclose(params(state), before, atol=1e-12):
            last_ids = part
    assert last_ids is not None


def test_stream_stopped_and_resumed_goes_on(spark, images):
    path, checkpoint, store = scratch_path(spark, "stream-in"), scratch_path(spark, "cp"), ParamStore(spark)
    first = train([images], State.pattern(spark, NET), store, Options(lr=0.1))  # version 1 is the start
    for part in range(3):  # each start finds one more file
        images.where(f"id % 3 = {part}").coalesce(1).write.mode("append").parquet(path)
        online.train_stream(stream(spark, path), first, store, Options(lr=0.1), checkpoint).awaitTermination()
    online.train_stream(stream(spark, path), first, store, Options(lr=0.1), checkpoint).awaitTermination()  # nothing new
    want = train([images.where(f"id % 3 = {part}") for part in range(3)], first, ParamStore(spark), Options(lr=0.1))
    assert store.newest(NET).iteration == 4
    assert params(store.newest(NET)) == pytest.approx(params(want), abs=1e-12)
    assert params(store.load(NET, 1)) == pytest.approx(params(first))
    with pytest.raises(ValueError):
        online.train_stream(stream(spark, path), State(NET, want.params, 1), store, Options(lr=0.1), checkpoint)


def test_stream_leaves_out_repeated_and_too_late_rows(spark):
    path, checkpoint, log = (scratch_path(spark, name) for name in ("late-in", "cp", "log"))
    schema = "id long, label int, x array<double>, time timestamp"
    at = "timestamp_seconds({} * 60)".format
    loads = [
        [(1, 0), (2, 5), (2, 5), (None, 5), (None, 5), (None, 6)],  # repeats within a load
        [(1, 3), (3, 60), (2, 6)],                                  # 1 and 2 come again, within ten minutes
        [(4, 20), (5, 55), (3, 61)],                                # 4 is behind the watermark of 50 minutes
        [(1, 61), (6, None)],                                       # the state of 1 is gone; 6 has no time and is never late
    ]
    for rows in loads:
        batch = spark.createDataFrame(rows, "id long, minute int").selectExpr(
            "id", "0 AS label", "array(1D) AS x", f"{at('minute')} AS time")
        batch.coalesce(1).write.mode("append").parquet(path)
        images = online.distinct_stream(spark.readStream.schema(schema).parquet(path), "time", "10 minutes")
        query = online._start(images, lambda rows, k: rows.write.mode("overwrite").parquet(f"{log}/iter={k}"), checkpoint)
        query.awaitTermination()
    found = [r["id"] for r in read_log(spark, log).collect()]
    assert sorted(i for i in found if i) == [1, 1, 2, 3, 5, 6] and found.count(None) == 2


def test_running_accuracy_goes_on_after_a_restart(spark, images):
    path, checkpoint, log = (scratch_path(spark, name) for name in ("acc-in", "cp", "log"))
    start = State.pattern(spark, NET)
    for part in range(3):
        images.where(f"id % 3 = {part}").coalesce(1).write.mode("append").parquet(path)
        online.accuracy_stream(stream(spark, path), start, log, checkpoint, "label").awaitTermination()
        seen = online.newest_accuracy(read_log(spark, log), "label")
        want = accuracy(predict(images.where(f"id % 3 <= {part}"), start), "label")
        assert sorted(seen.collect()) == sorted(want.collect())


def counted(spark, images):
    """The images, and an accumulator that counts the rows read of them."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return images.mapInArrow(touch, images.schema), seen


def test_log_and_gradients_come_from_one_scan(spark, images):
    start, opts = State.pattern(spark, NET), Options(lr=0.1)
    rows, seen = counted(spark, images)
    log = training.TrainLog(spark)
    state = train([rows] * 2, start, ParamStore(spark), opts, "block", log=log)
    assert seen.value == 2 * images.count()
    assert params(state) == pytest.approx(params(train([images] * 2, start, ParamStore(spark), opts, "array")), abs=1e-12)
    apart = training.TrainLog(spark)
    train([images] * 2, start, ParamStore(spark), opts, "array", log=apart)
    mine, other = (sorted(x.read().select("iter", "id", "label", "prediction").collect()) for x in (log, apart))
    assert mine == other and len(mine) == 2 * images.count()
    assert log.means("p").count() == 6


def test_log_of_empty_and_unknown_images(spark, images):
    start, log = State.pattern(spark, NET), training.TrainLog(spark)
    odd = spark.createDataFrame([(1, 1, None), (2, None, [1.0, 2.0]), (None, 0, [])], images.schema)
    for batch in (odd, images.limit(0)):
        state = training.step(batch, start, ParamStore(spark), Options(lr=0.1), "block", log)
        want = training.step(batch, start, ParamStore(spark), Options(lr=0.1), "block")
        assert params(state) == pytest.approx(params(want), abs=1e-12)
        rows = log.read().collect()  # the second run of version 0 replaces the first
        assert sorted((r["id"] is None, r["id"] or 0, r["prediction"] is None) for r in rows) == (
            [(False, 1, True), (False, 2, False), (True, 0, True)] if batch is odd else [])


def test_many_models_in_one_scan(spark, images):
    """Every model of a stacked sweep moves as if it were alone, also on unlabelled, short and unknown images."""
    odd = [(30, None, [0.5, -1.0, 2.0, 0.1]), (31, 1, [1.0]), (32, 2, None), (33, 0, [None, 2.0, None, 1.0])]
    rows = images.unionByName(spark.createDataFrame(odd, images.schema)).repartition(3)
    rates = [(f"m{k:02d}", 0.01 * (k + 1), 0.05 if k % 2 else None, None) for k in range(64)]
    start = State.pattern(spark, Network(4, 3, 3))
    got = training.sweep(rows, start, spark.createDataFrame(
        rates, "variant string, lr double, clip double, target array<double>"), 2).toPandas()
    for name, lr, clip, _ in rates[::9]:
        want = train([rows] * 2, start, ParamStore(spark), Options(lr=lr, clip=clip, update_bias=False), "block")
        mine = got[got["variant"] == name].sort_values(["layer", "out", "in"])["w"].to_numpy()
        assert mine == pytest.approx(params(want), abs=1e-12)


def test_stacked_sums_copy_no_row_and_leave_no_broadcast(spark, images, monkeypatch):
    start, held = State.pattern(spark, Network(4, 3, 3)), []
    sums = stacked_sums(images, start.net, [start.arrays()] * 40, None, held)
    text = sums._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and text.count("Exchange") == 1 and len(held) == 1
    gone = []
    monkeypatch.setattr(type(held[0]), "destroy", lambda self, blocking=False: gone.append(self))
    variants = spark.createDataFrame([(str(k), 0.1, None, None) for k in range(3)], "variant string, lr double, clip double, target array<double>")
    training.sweep(images, start, variants, 2)
    assert len(gone) == 2


def test_stacked_sigmoid_needs_its_targets(spark, images):
    start = State.pattern(spark, Network(4, 3, 3, "sigmoid", "sigmoid"))
    kind = "variant string, lr double, clip double, target array<double>"
    rates = [("a", 0.1, None, [0.1, 0.2, 0.9]), ("b", 0.5, 0.01, [0.9, 0.1, 0.3]), ("c", 0.2, None, [0.5, 0.5, 0.5])]
    got = training.sweep(images, start, spark.createDataFrame(rates, kind), 2).toPandas()
    for name, lr, clip, target in rates:
        opts = Options(lr=lr, clip=clip, target=tuple(target), update_bias=False)
        mine = got[got["variant"] == name].sort_values(["layer", "out", "in"])["w"].to_numpy()
        assert mine == pytest.approx(params(train([images] * 2, start, ParamStore(spark), opts, "block")), abs=1e-12)
    with pytest.raises(ValueError):
        training.sweep(images, start, spark.createDataFrame([("a", 0.1, None, None)], kind), 1)


def test_sweep_of_images_without_values_changes_nothing(spark, images):
    start = State.pattern(spark, Network(4, 3, 3))
    variants = spark.createDataFrame([(str(k), 0.1, None, None) for k in range(3)], "variant string, lr double, clip double, target array<double>")
    for rows in (images.limit(0), images.withColumn("x", F.lit(None).cast("array<double>"))):
        got = training.sweep(rows, start, variants, 1)
        assert got.drop("variant").distinct().exceptAll(start.params).count() == 0 and got.count() == 3 * start.net.n_params


def scanned(df):
    """(files, rows) that the scan of a collected frame has read."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return tuple(int(node.metrics().apply(name).value()) for name in ("numFiles", "numOutputRows"))


def test_one_image_is_looked_up_in_its_folder(spark):
    many = spark.range(200000).repartition(8).selectExpr(
        "id", "CAST(id % 3 AS INT) AS label", "transform(sequence(0, 3), i -> rand(1)) AS x")
    hot = spark.range(50000).selectExpr("77777L AS id", "1 AS label", "array(0D, 1D, 2D, 3D) AS x")
    none = spark.range(10).selectExpr("CAST(NULL AS BIGINT) AS id", "1 AS label", "array(0D, 1D, 2D, 3D) AS x")
    store = training.ImageStore(many.unionByName(hot).unionByName(none), folders=20, group_bytes=1 << 17)
    assert store.images.count() == 250000
    files, rows = scanned(store.one(150123))
    assert files <= 2 and rows <= 10000 and store.one(150123).count() == 1
    assert store.one(77777).count() == 50001 and store.one(0).count() == 1
    assert store.one(-5).count() == 0 and store.one(10**12).count() == 0
    empty = training.ImageStore(many.limit(0))
    assert empty.one(3).count() == 0 and empty.images.count() == 0


def test_incomplete_versions_are_left_out(spark, images):
    store = ParamStore(spark)
    end = train([images] * 2, State.pattern(spark, NET), store, Options(lr=0.5))
    end.params.where("layer = 1").write.parquet(f"{store.path}/iter=10")
    files, path = store._at(10)
    files.delete(path, False)
    assert store.versions() == [0, 1, 2] and store.newest(NET).iteration == 2
    assert store.history().where("iter = 10").count() == 0
