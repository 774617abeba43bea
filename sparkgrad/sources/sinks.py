"""Created tables, append-only logs and CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Create or replace a table from a query and return it as a new scan."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_log(df: DataFrame, path: str, iteration: int) -> None:
    """Add the rows of one iteration to a log partitioned by ``iter``.

    The iteration has its own folder, so a step that runs again after a failure
    replaces its own rows and never doubles them.
    """
    df.write.mode("overwrite").parquet(f"{path}/iter={iteration}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log; filters on ``iter`` prune folders."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn("iter", F.col("iter").cast("int"))


def export_csv(df: DataFrame, path: str, order_by: str, sep: str = ",") -> None:
    """Ordered CSV with a header; range-partitioned, one sorted file per range."""
    df.orderBy(order_by).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
