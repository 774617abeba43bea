"""Newest row per key of an append-only log, kept up to date from the log's new folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkgrad.operators.update import latest_per_key


class LatestTable:
    """Versions ``<path>/upto=<k>``: the newest values per key of all log folders ``iter=0 .. iter=k``.

    The number of a version is its high-water mark. ``refresh`` reads the newest complete version and the folders
    above its mark only, so its cost follows what is new and the number of keys, not the length of the log. A
    refresh that died left no complete version and is done again. A log folder must not change once it is merged.
    """

    def __init__(self, spark: SparkSession, log: str, path: str, keys: list[str], order: list[str], values: list[str]):
        self.spark, self.log, self.path = spark, log, path
        self.keys, self.order = keys, order
        self.values = [*order, *[v for v in values if v not in order]]
        self.columns = [*keys, *values]

    def _numbers(self, folder: str, name: str) -> list[int]:
        """Sorted numbers k of the ``name=k`` folders that a finished write has left."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(folder)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        found = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith(f"{name}=")]
        done = [p for p in found if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def mark(self) -> int | None:
        """Highest log folder that the table holds."""
        versions = self._numbers(self.path, "upto")
        return versions[-1] if versions else None

    def pending(self) -> list[str]:
        """Log folders above the mark."""
        mark = self.mark()
        return [f"{self.log}/iter={k}" for k in self._numbers(self.log, "iter") if mark is None or k > mark]

    def merged(self, folders: list[str]) -> DataFrame:
        """The table with the rows of ``folders``; reads these and the newest version."""
        columns = [*self.keys, *[v for v in self.values if v not in self.keys]]
        rows = self.spark.read.parquet(*folders).select(*columns)
        mark = self.mark()
        if mark is not None:
            rows = self.spark.read.schema(rows.schema).parquet(f"{self.path}/upto={mark}").unionByName(rows)
        return latest_per_key(rows, self.keys, self.order, [c for c in columns if c not in self.keys])

    def refresh(self) -> DataFrame:
        folders = self.pending()
        if folders:
            newest = int(folders[-1].rsplit("=", 1)[1])
            self.merged(folders).write.mode("overwrite").parquet(f"{self.path}/upto={newest}")
        return self.read()

    def read(self) -> DataFrame:
        mark = self.mark()
        if mark is None:
            raise ValueError(f"no version in {self.path}; the log {self.log} has not been merged yet")
        return self.spark.read.parquet(f"{self.path}/upto={mark}").select(*self.columns)
