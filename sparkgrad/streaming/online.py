"""Online scoring and training with Structured Streaming.

Both write one folder per micro-batch, named by the batch number. A micro-batch that
runs again after a failure replaces its own folder, so results appear once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkgrad.operators.reports import accuracy
from sparkgrad.plans.forward import predict
from sparkgrad.plans.network import State
from sparkgrad.plans.training import Options, ParamStore, step
from sparkgrad.sources.sinks import append_log


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder's table ``name.parquet``, one file or a folder of files, as a stream with the table's own schema."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("basePath", folder)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{path[:-1]}[t]")  # a stream takes a path as a folder, a pattern as files or folders


def embedding_stream(spark: SparkSession, folder: str) -> DataFrame:
    x: Column = F.col("embedding").cast("array<double>")
    return stream_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label", x.alias("x"))


def score_stream(images: DataFrame, state: State, log_path: str, checkpoint: str) -> StreamingQuery:
    """Score arriving images and append (iter, id, label, prediction) to the log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        held: list = []
        try:
            append_log(predict(batch, state, held=held), log_path, batch_id)
        finally:
            for shipped in held:  # a stream would leave one file on the driver per micro-batch
                shipped.destroy()

    return _start(images, write, checkpoint)


def train_stream(images: DataFrame, state: State, store: ParamStore, opts: Options, checkpoint: str) -> StreamingQuery:
    """One gradient step per micro-batch: version k + 1 comes from version k and batch k, counted from the start state.

    A restarted stream finds its start version in the store and goes on from there; another one under the same
    number is an error.
    """
    net, first = state.net, state.iteration
    if not store.has(first):
        store.save(net, state.params, first)
    elif not _same(store.load(net, first).params, state.params):
        raise ValueError(f"version {first} in {store.path} is not the given start state")

    def learn(batch: DataFrame, batch_id: int) -> None:
        step(batch, store.load(net, first + batch_id), store, opts)

    return _start(images, learn, checkpoint)


def distinct_stream(images: DataFrame, time: str, delay: str, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Each key once, for streams that deliver rows late or again.

    A row whose key came before, with event times at most ``delay`` apart, is left out. So is a row older than the
    watermark, which follows the newest ``time`` of the micro-batches before by ``delay``. State behind the watermark is
    dropped, so it is bounded by the keys of one ``delay`` and not by the length of the stream. Rows with a NULL among
    their keys repeat one another only if they are equal in all columns. The watermark starts at 1970; a row without a time is never late.
    """
    columns = images.columns
    lacking = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    twin = F.when(lacking, F.sha2(F.to_json(F.struct(*columns)), 256))
    marked = images.withColumn("_twin", twin).withWatermark(time, delay)
    return marked.dropDuplicatesWithinWatermark([*keys, "_twin"]).select(*columns)


def accuracy_stream(images: DataFrame, state: State, path: str, checkpoint: str, *by: str) -> StreamingQuery:
    """Running accuracy of arriving images per ``by``: after each micro-batch the groups that changed, as ``iter=<batch>``.

    The state is a sum and a count per group and outlives a restart; a micro-batch that runs again replaces its folder.
    """
    running = accuracy(predict(images, state), *by)
    return _start(running, lambda batch, batch_id: append_log(batch, path, batch_id), checkpoint, "update")


def newest_accuracy(log: DataFrame, *by: str) -> DataFrame:
    """The last row of every group that ``accuracy_stream`` wrote."""
    return log.groupBy(*by).agg(*[F.max_by(c, "iter").alias(c) for c in ("pct_right", "n_images")])


def _same(left: DataFrame, right: DataFrame) -> bool:
    keys = ["layer", "out", "in"]
    both = left.select(*keys, "w").join(right.select(*keys, F.col("w").alias("v")), keys, "full")
    return both.where("NOT (w <=> v)").isEmpty()


def _start(rows: DataFrame, each, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
