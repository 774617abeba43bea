"""A sequence of row numbers that goes on over later loads."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.sources.row_ids import assign_row_ids, assign_row_ids_by


@dataclass(frozen=True)
class Claim:
    """Numbers ``first .. first + n - 1``, claimed by a load."""

    load: str
    first: int
    n: int


class Sequence:
    """Numbers handed out once, kept as one small file per claim in ``path``.

    A load that claims again under its name gets its own numbers again, so a retry leaves no gap and takes none of
    another load's. One loader claims at a time: a claim's file is created only if it is not there, and the loader that
    finds it there fails and may try again. A file left empty by a loader that died is no claim and is written again.
    """

    def __init__(self, spark: SparkSession, path: str, start: int = 1):
        self.spark, self.path, self.start = spark, path, start
        self._jvm = spark._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def claims(self) -> list[Claim]:
        """All claims in their order: one line per load."""
        if not self._files.exists(self._folder):
            return []
        rows = self.spark.read.schema("load string, first long, n long").json(self.path).where("load IS NOT NULL")
        return [Claim(**r.asDict()) for r in rows.orderBy("first", "n").collect()]

    def claim(self, load: str, n: int) -> Claim:
        claims = self.claims()
        for known in claims:
            if known.load == load:
                if known.n != n:
                    raise ValueError(f"load {load} claimed {known.n} numbers before, not {n}")
                return known
        last = claims[-1] if claims else Claim("", self.start, 0)
        new = Claim(load, last.first + last.n, n)
        at = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/claim-{len(claims):08d}.json")
        if self._files.exists(at) and self._files.getFileStatus(at).getLen() == 0:
            self._files.delete(at, False)
        out = self._files.create(at, False)  # an error if another loader has just made it
        try:
            out.write(bytearray(json.dumps(asdict(new)).encode()))
        finally:
            out.close()
        return new


def append_numbered(df: DataFrame, path: str, sequence: Sequence, load: str, key: str | None = None,
                    name: str = "id") -> Claim:
    """Number the rows of a load with the sequence's next numbers and write them as ``<path>/load=<load>``.

    Rows are numbered in scan order, or by ``key``; see ``assign_row_ids``. A load that runs again replaces its
    folder and keeps its numbers. Counting reads no columns.
    """
    claim = sequence.claim(load, df.count())
    numbered = assign_row_ids_by(df, key, name) if key else assign_row_ids(df, name)
    moved = numbered.withColumn(name, F.col(name) + F.lit(claim.first - 1))
    moved.write.mode("overwrite").parquet(f"{path}/load={load}")
    return claim


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """All loads, with the name of each row's load."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn("load", F.col("load").cast("string"))
