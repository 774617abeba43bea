"""Scoring and training on a stream of the given tables."""

from pyspark.sql import functions as F

from sparkgrad.catalog.forward import DIGITS, PREDICTED
from sparkgrad.catalog.loops import DIGIT_START, LR, param_rows, steps_sql
from sparkgrad.catalog.registry import query
from sparkgrad.plans.network import State
from sparkgrad.plans.training import Options, ParamStore
from sparkgrad.session import scratch_path
from sparkgrad.sources.readers import embedding_images
from sparkgrad.sources.sinks import read_log
from sparkgrad.streaming import online


@query("stream_score", PREDICTED + " SELECT id, label, prediction FROM pred")
def stream_score(spark, sf_dir):
    log = scratch_path(spark, "stream-log")
    stream = online.embedding_stream(spark, sf_dir)
    online.score_stream(stream, State.pattern(spark, DIGITS), log, scratch_path(spark, "stream-cp")).awaitTermination()
    return read_log(spark, log).select("id", "label", "prediction")


@query("stream_train", steps_sql(*DIGIT_START, 1))
def stream_train(spark, sf_dir):
    store = ParamStore(spark)
    stream = online.embedding_stream(spark, sf_dir)
    query = online.train_stream(stream, State.pattern(spark, DIGITS), store, Options(lr=LR), scratch_path(spark, "train-cp"))
    query.awaitTermination()
    return param_rows(store.newest(DIGITS))


LOADS = 3
_LOAD = f"rid * {LOADS} // (SELECT count(*) FROM embeddings)"


def _timed(spark, sf_dir):
    """The images, a minute apart by id, with the load that brings each; and the minutes of one load."""
    images = embedding_images(spark, sf_dir)
    n = images.count()
    return images.withColumn("time", F.expr("timestamp_seconds(1577836800 + id * 60)")).withColumn(
        "load", F.expr(f"id * {LOADS} div {n}")), n // LOADS + 2


@query("stream_train_dedup", steps_sql(*DIGIT_START, LOADS, where=lambda n: f"{_LOAD} = {n}"))
def stream_train_dedup(spark, sf_dir):
    """Every load brings the images of the load before once more; each image teaches once."""
    timed, minutes = _timed(spark, sf_dir)
    arriving, checkpoint, store = scratch_path(spark, "arriving"), scratch_path(spark, "dedup-cp"), ParamStore(spark)
    start = State.pattern(spark, DIGITS)
    for k in range(LOADS):  # each start goes on from the checkpoint and finds one more load
        timed.where(F.col("load").between(k - 1, k)).drop("load").write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(timed.drop("load").schema).parquet(arriving)
        images = online.distinct_stream(stream, "time", f"{minutes} minutes")
        online.train_stream(images, start, store, Options(lr=LR), checkpoint).awaitTermination()
    return param_rows(store.newest(DIGITS))


@query("stream_accuracy", PREDICTED + """
SELECT label, round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 6) AS pct_right, count(*) AS n_images
FROM pred GROUP BY label""")
def stream_accuracy(spark, sf_dir):
    """Accuracy by label after the last of several loads, from the state that the stream keeps."""
    timed, _ = _timed(spark, sf_dir)
    arriving, checkpoint, path = (scratch_path(spark, name) for name in ("arriving", "accuracy-cp", "accuracy"))
    for k in range(LOADS):
        timed.where(F.col("load") == k).drop("load", "time").write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(timed.drop("load", "time").schema).parquet(arriving)
        online.accuracy_stream(stream, State.pattern(spark, DIGITS), path, checkpoint, "label").awaitTermination()
    return online.newest_accuracy(read_log(spark, path), "label").selectExpr(
        "label", "round(pct_right, 6) AS pct_right", "n_images")
