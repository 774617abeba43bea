"""Session defaults, shared folder for written intermediates, size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Parameters beyond this many values (32 MB as doubles) are never broadcast or
# packed into one row; layers then use the salted shuffle join.
MAX_BROADCAST_PARAMS = 4_000_000

_local_dirs: dict[str, str] = {}


def build_session(app: str = "sparkgrad", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a write into a few folders keeps one file open for each, in place of a sort by folder
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sparkgrad-")
        sc.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh folder name for a written intermediate; never reused."""
    return f"{shared_dir(spark)}/sparkgrad/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by writing ``df`` to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
