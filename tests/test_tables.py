"""Readers, row ids, updates, constraints, plans."""

import math

import pytest
from pyspark.sql import functions as F

from sparkgrad import catalog
from sparkgrad.catalog.forward import DIGITS
from sparkgrad.functions import columns as C
from sparkgrad.functions.keyed_random import keyed_uniform
from sparkgrad.operators import layers, reports, reshape, update
from sparkgrad.plans.forward import score
from sparkgrad.plans.network import State
from sparkgrad.plans.training import Options, gradients
from sparkgrad.session import scratch_path, shared_dir
from sparkgrad.sources import readers, row_ids, schemas, sinks
from sparkgrad.sources.dialect import Dialect, detect_dialect, load_csv
from sparkgrad.sources.latest import LatestTable
from sparkgrad.sources.sequence import Sequence, append_numbered, read_numbered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_declared_and_inferred(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(1, 0.5, None), (2, 1.0, 3.25)], "label int, pixel0 double, pixel1 double").write.option(
        "header", True).csv(path)
    declared = readers.read_csv(spark, path, schemas.image_schema(2, with_id=False))
    inferred = readers.read_csv(spark, path)
    assert sorted(declared.collect(), key=str) == sorted(inferred.collect(), key=str)
    long = reshape.unpivot_pixels(declared, ["label"])
    assert sorted((r["label"], r["pixel"], r["pixel_id"], r["pixel_value"]) for r in long.collect()) == [
        (1, "pixel0", 0, 0.5), (2, "pixel0", 0, 1.0), (2, "pixel1", 1, 3.25)]


def test_pixel_number(spark):
    names = spark.createDataFrame([("pixel0",), ("pixel783",), ("42",)], "pixel string")
    assert [r[0] for r in names.select(reshape.pixel_number(F.col("pixel"))).collect()] == [0, 783, 42]


def test_scan_ids_are_dense_over_many_files(spark):
    path = scratch_path(spark, "files")
    spark.range(5000).repartition(13).write.parquet(path)
    rows = row_ids.assign_row_ids(spark.read.parquet(path), "n")
    assert "Exchange hashpartitioning(_split" not in plan(rows).split("BroadcastExchange")[0]
    assert sorted(r["n"] for r in rows.collect()) == list(range(1, 5001))


@pytest.fixture
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scan_ids_refuse_a_shuffled_frame(spark):
    with pytest.raises(ValueError):
        row_ids.assign_row_ids(spark.range(10).repartition(3))


def test_scan_ids_take_projections_and_filters_only(spark):
    path = scratch_path(spark, "files")
    spark.range(1000).repartition(4).write.parquet(path)
    files = spark.read.parquet(path)
    kept = row_ids.assign_row_ids(files.where("id % 3 = 0").selectExpr("id + 1 AS k"), "n")
    assert sorted(r["n"] for r in kept.collect()) == list(range(1, 335))
    for odd in (files.limit(5), files.sample(0.5), files.where("rand() < 0.5"), files.union(files), files.coalesce(1),
                files.selectExpr("explode(array(id, id)) AS id"), files.distinct()):
        with pytest.raises(ValueError):
            row_ids.assign_row_ids(odd)


@pytest.mark.parametrize("partitions", [1, 2, 7, 40], indirect=True)
def test_ordered_ids_with_a_hot_key(spark, partitions):
    path = scratch_path(spark, "hot")
    spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 50 ELSE id % 101 END AS k", "id AS v").repartition(9).write.parquet(path)
    df = spark.read.parquet(path)
    rows = row_ids.assign_row_ids_by(df, "k", "n").collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 6001))
    keys = [r["k"] for r in sorted(rows, key=lambda r: r["n"])]
    assert keys == sorted(keys)
    assert len({r["v"] for r in rows}) == 6000


def test_ordered_ids_with_many_null_keys(spark):
    path = scratch_path(spark, "nulls")
    spark.range(900).selectExpr("CASE WHEN id % 3 > 0 THEN id % 7 END AS k").repartition(4).write.parquet(path)
    rows = row_ids.assign_row_ids_by(spark.read.parquet(path), "k", "n").collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 901))
    assert {r["n"] for r in rows if r["k"] is None} == set(range(1, 301))
    keys = [r["k"] for r in sorted(rows, key=lambda r: r["n"])][300:]
    assert keys == sorted(keys)


@pytest.mark.parametrize("name", ["latest_weights", "update_from", "update_two_keys"])
def test_latest_rows_are_hash_aggregates(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_latest_row_by_two_columns_with_nulls(spark):
    log = spark.createDataFrame([("a", 5, None, 1.0), ("a", 5, -3, 2.0), ("a", None, 9, 3.0), ("b", None, None, 4.0), ("c", -7, 1, 5.0), ("c", -8, 9, 6.0)],
                                "k string, t long, i int, v double")
    assert {tuple(r) for r in update.latest_per_key(log, ["k"], ["t", "i"], ["v"]).collect()} == {("a", 2.0), ("b", 4.0), ("c", 5.0)}
    with pytest.raises(ValueError):
        update.order_key(log, ["v"])


def test_wall_times_order_to_the_microsecond(spark):
    log = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-03-31 02:30:00.000001', 1D), (1, TIMESTAMP_NTZ'2024-03-31 02:30:00', 2D), "
                    "(2, TIMESTAMP_NTZ'1960-01-01 00:00:00', 3D), (2, TIMESTAMP_NTZ'1959-12-31 23:59:59.5', 4D) AS t(k, ts, v)")
    assert {tuple(r) for r in update.latest_per_key(log, ["k"], ["ts"], ["v"]).collect()} == {(1, 1.0), (2, 3.0)}


def test_argmax_of_rows(spark):
    rows = [(1, 0, 0.2), (1, 1, 0.5), (1, 2, 0.5), (2, 0, None), (2, 1, None), (3, 70, 0.1)]
    for width in (71, 200):
        got = layers.argmax_rows(spark.createDataFrame(rows, "id int, out int, p double"), ["id"], width).collect()
        assert {(r["id"], r["prediction"]) for r in got} == {(1, 1), (2, None), (3, 70)}


def test_violations_need_one_shuffle(spark, sf_dir):
    text = plan(catalog.QUERIES["constraint_violations"](spark, sf_dir))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_unpivot_leaves_other_columns_out(spark):
    rows = reshape.unpivot_pixels(spark.sql("SELECT 1 AS id, 2D AS pixel0, 3D AS pixel11, 'x' AS note, 4D AS pixels"), ["id"])
    assert {tuple(r) for r in rows.collect()} == {(1, "pixel0", 2.0, 0), (1, "pixel11", 3.0, 11)}


def test_shares_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 15.0)], "g string, v double")
    rows = layers.ratio_to_report(df, "v", ["g"])
    assert rows.columns == ["g", "v", "max_value", "total_value", "ratio"]
    assert {(r["g"], r["v"], r["ratio"]) for r in rows.collect()} == {
        ("a", 1.0, 0.25), ("a", 3.0, 0.75), (None, 5.0, 0.25), (None, 15.0, 0.75)}


def test_update_from(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, w double")
    source = spark.createDataFrame([(1, 11.0, 1), (1, 12.0, 2), (3, None, 1), (9, 1.0, 1)], "k int, v double, at int")
    with pytest.raises(ValueError):
        update.checked_source(source, ["k"])
    last = update.checked_source(update.one_per_key(source, ["k"], "v", ["at"]), ["k"])
    rows = update.update_from(target, last, ["k"], "w", "v").collect()
    assert {r["k"]: r["w"] for r in rows} == {1: 12.0, 2: 20.0, 3: None}


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(5.0,), (-5.0,), (0.5,), (None,)], "g double")
    assert [r[0] for r in df.selectExpr(C.clip("g", 1.0)).collect()] == [1.0, -1.0, 0.5, None]


def test_softmax_of_equal_and_large_values(spark):
    df = spark.createDataFrame([([1e9, 1e9],), ([1000.0, -1000.0],)], "z array<double>")
    assert [r[0] for r in df.selectExpr(C.softmax("z")).collect()] == [[0.5, 0.5], [1.0, 0.0]]


def test_constraints(spark):
    log = spark.createDataFrame([(1, 0, 22), (2, 9, None), (2, 3, 3), (3, -1, 4)], "id int, label int, prediction int")
    found = {(r["reason"], r["id"], r["value"], r["n"]) for r in reports.constraint_violations(
        log, "id", {"label": (0, 9), "prediction": (0, 9)}).collect()}
    assert found == {("duplicate", 2, None, 2), ("prediction", 1, 22.0, 1), ("label", 3, -1.0, 1)}


def test_accuracy_counts_null_as_wrong(spark):
    log = spark.createDataFrame([(1, 1), (2, None), (3, 4), (5, 5)], "label int, prediction int")
    assert reports.accuracy(log).first()["pct_right"] == 0.5


def test_append_log_twice_is_once(spark):
    path = scratch_path(spark, "log")
    rows = spark.createDataFrame([(1, 2, 3)], schemas.PREDICTION_LOG)
    sinks.append_log(rows, path, 0)
    sinks.append_log(rows, path, 0)
    sinks.append_log(rows, path, 1)
    assert sorted(r["iter"] for r in sinks.read_log(spark, path).collect()) == [0, 1]


def test_export_is_ordered(spark):
    path = scratch_path(spark, "export")
    df = spark.range(1000).selectExpr("id AS ImageId", "CAST(id % 10 AS INT) AS Label").repartition(5)
    sinks.export_csv(df, path, "ImageId")
    import glob
    lines = [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f).read().splitlines() if line != "ImageId,Label"]
    assert [int(line.split(",")[0]) for line in lines] == list(range(1000))


def test_keyed_uniform_ignores_partitions(spark):
    df = spark.range(2000)
    a = df.select(keyed_uniform(1, "id").alias("u"))
    assert a.exceptAll(df.repartition(7).select(keyed_uniform(1, "id").alias("u"))).count() == 0
    low, high, mean = a.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.02


def test_weight_names(spark):
    from sparkgrad.catalog.sigmoid import PAIR, seed_state
    log = seed_state(spark).params.withColumn("iter", F.lit(0))
    got = {r["weight_name"]: r["updated_weight"] for r in reports.weight_trajectory(log, PAIR).collect()}
    assert got == {"W1": .15, "W2": .25, "W3": .20, "W4": .30, "W5": .40, "W6": .45, "W7": .50, "W8": .55}


def test_grid_cells(spark):
    images = spark.createDataFrame([(1, 0, [float(i) for i in range(16)])], "id long, label int, x array<double>")
    cells = reshape.to_grid(images, 4).collect()
    assert all(r["value"] == r["row"] * 4 + r["col"] for r in cells) and len(cells) == 16


def test_equality_filter_reaches_the_scan(spark, sf_dir):
    one = readers.embedding_images(spark, sf_dir).where("id = 7")
    assert "PushedFilters: [IsNotNull(vec_id), EqualTo(vec_id,7)]" in plan(one)
    assert one.count() == 1


def test_scoring_plans(spark, sf_dir):
    images, state = readers.embedding_images(spark, sf_dir), State.pattern(spark, DIGITS)
    long = plan(score(images, state, "long"))
    assert "BroadcastHashJoin" in long and "CartesianProduct" not in long and "NestedLoop" not in long
    assert long.count("Exchange hashpartitioning(_row#") == 1  # one shuffle of image rows for both layers
    for engine in ("array", "block"):
        text = plan(score(images, state, engine)).split("Subquery")[0]
        assert "Exchange" not in text and "Join" not in text


def test_gradient_plan_has_one_small_shuffle(spark, sf_dir):
    images, state = readers.embedding_images(spark, sf_dir), State.pattern(spark, DIGITS)
    text = plan(gradients(images, state, Options(), "block"))
    assert text.count("Exchange hashpartitioning(layer#") == 1 and "SinglePartition" not in text
    array = plan(gradients(images, state, Options(), "array"))
    assert array.count("Exchange hashpartitioning(pos#") == 1 and "partial_sum" in array


class _Session:
    """Just the settings ``shared_dir`` looks at."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = self, self
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}-{folder}"

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getConf(self):
        return self

    def setCheckpointDir(self, path):
        self.local = path


def test_shared_folder_comes_from_the_session():
    assert shared_dir(_Session("spark://host:7077", "hdfs://shared/cp/")) == "hdfs://shared/cp"
    assert shared_dir(_Session("local[2]"))
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://host:7077"))


def test_sequence_goes_on_over_loads_and_retries(spark):
    path, numbers = scratch_path(spark, "numbered"), Sequence(spark, scratch_path(spark, "sequence"))
    scan = sinks.create_table_as(spark.range(100).selectExpr("id AS k"), scratch_path(spark, "scan"))
    append_numbered(scan, path, numbers, "a")
    append_numbered(scan.where("k < 0"), path, numbers, "empty")
    append_numbered(scan.selectExpr("-k AS k"), path, numbers, "b", key="k")
    append_numbered(scan, path, numbers, "a")  # the retry of a load after a later one
    append_numbered(scan.limit(5), path, numbers, "7", key="k")
    rows = read_numbered(spark, path).collect()
    assert sorted(r["id"] for r in rows) == list(range(1, 206))
    assert {r["load"]: r["id"] for r in rows if r["k"] == -99} == {"b": 101}
    assert [(c.load, c.first, c.n) for c in numbers.claims()] == [("a", 1, 100), ("empty", 101, 0), ("b", 101, 100), ("7", 201, 5)]
    with pytest.raises(ValueError, match="100 numbers before"):
        numbers.claim("a", 99)
    again = Sequence(spark, numbers.path)  # another session finds the mark
    assert again.claim("c", 1).first == 206


def test_claims_of_two_loaders_and_of_a_dead_one(spark, monkeypatch):
    numbers = Sequence(spark, scratch_path(spark, "sequence"))
    numbers.claim("a", 10)
    before = numbers.claims()
    numbers.claim("b", 10)
    late = Sequence(spark, numbers.path)
    monkeypatch.setattr(late, "claims", lambda: before)  # read before b claimed
    with pytest.raises(Exception, match="exist"):
        late.claim("c", 1)
    dead = numbers._jvm.org.apache.hadoop.fs.Path(f"{numbers.path}/claim-00000002.json")
    numbers._files.create(dead, False).close()
    assert numbers.claim("d", 3).first == 21 and numbers.claim("e", 1).first == 24


def test_latest_table_reads_new_folders_only(spark):
    log, path = scratch_path(spark, "log"), scratch_path(spark, "latest")
    schema = "k string, at long, v double"
    table = LatestTable(spark, log, path, ["k"], ["at"], ["v"])
    with pytest.raises(ValueError, match="not been merged"):
        table.read()
    loads = [[("a", 1, 1.0), ("b", 5, 2.0), (None, 1, 0.5)], [("a", 2, 3.0), ("b", 4, 9.0)], [], [("c", 0, None), (None, 2, 0.25)]]
    for k, rows in enumerate(loads):
        sinks.append_log(spark.createDataFrame(rows, schema), log, k)
        if k == 2:
            continue  # two loads are merged at once
        pending = table.pending()
        assert [p.rsplit("/", 1)[1] for p in pending] == [f"iter={i}" for i in ([2, 3] if k == 3 else [k])]
        read = {f.rsplit("/", 2)[1] for f in table.merged(pending).inputFiles()}
        assert read <= {f"iter={i}" for i in (2, 3, k)} | {f"upto={k - 1}", "upto=1"}
        got = table.refresh()
        whole = update.latest_per_key(sinks.read_log(spark, log), ["k"], ["at"], ["v"])
        assert sorted(got.collect(), key=str) == sorted(whole.collect(), key=str)
    assert table.refresh().count() == 4 and table.mark() == 3 and table.pending() == []
    # a refresh that died leaves no mark
    spark.range(1).write.parquet(f"{path}/upto=9")
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/upto=9/_SUCCESS")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, False)
    assert table.mark() == 3


def test_mergeable_softmax(spark):
    inf = float("inf")
    rows = [("a", i, z) for i, z in enumerate([1000.0, 999.0, -5000.0, None])] + [("b", 0, -700.0), ("b", 1, -700.0), ("c", 0, None)] + [
        (None, 0, 63.9), (None, 1, 64.1), ("d", 0, -inf), ("d", 1, 3.0)] + [("e", i, i * 0.37 - 200) for i in range(500)]
    got = {(r["k"], r["out"]): r["p"] for r in layers.softmax_rows_mergeable(
        spark.createDataFrame(rows, "k string, out int, z double"), ["k"]).collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        z = [(out, v) for k, out, v in rows if k == key and v is not None]
        top = max((v for _, v in z), default=0.0)
        total = sum(math.exp(v - top) for _, v in z)
        for k, out, v in rows:
            if k == key:
                want = None if v is None else pytest.approx(math.exp(v - top) / total, rel=1e-12)
                assert got[k, out] == want


@pytest.mark.parametrize("text, want", [
    ("a,b\n1,2\n", Dialect(",", True)), ("1;2,5\n2;3,5\n", Dialect(";", False)), ("x\ty\n1\t'a,b'\n", Dialect("\t", True)),
    ('a|b\n"1|2"|3\n4|5\n', Dialect("|", True)), ("one\ntwo\n", Dialect(",", False)), ("", Dialect(",", False))])
def test_dialects(spark, tmp_path, text, want):
    (tmp_path / "one.csv").write_text(text)
    assert detect_dialect(spark, str(tmp_path)) == want


def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    lines = ["id;label;v", "1;2;0.5", "2;;", "3;x;1", "4;1", "5;1;2;3", '6;1;"7"', "", "7;1;1e3"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    schema = schemas.T.StructType().add("id", "long").add("label", "integer").add("v", "double")
    rows, rejects = load_csv(spark, str(tmp_path / "in.csv"), schema, scratch_path(spark, "loaded"))
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, 2, 0.5), (2, None, None), (6, 1, 7.0), (7, 1, 1000.0)]
    found = rejects.collect()
    assert sorted(r["line"] for r in found) == ["3;x;1", "4;1", "5;1;2;3"] and all(r["file"].endswith("in.csv") for r in found)
