"""Table and CSV readers, and adapters to the (id, label, x) image form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header line.

    A declared schema needs no extra pass over the file; without one the types
    are inferred, which reads the whole input once more. Names are lower-cased.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.toDF(*[c.lower() for c in df.columns])


def embedding_images(spark: SparkSession, folder: str, scale: float = 1.0) -> DataFrame:
    """``embeddings`` as images: id, label, x ARRAY<DOUBLE>."""
    x = F.col("embedding").cast("array<double>")
    if scale != 1.0:
        x = F.transform(x, lambda v: v * F.lit(scale))
    return read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label", x.alias("x"))


def lineitem_features(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as a large scoring input with four scaled numeric features."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("label"),
        F.array(
            F.col("l_quantity") / F.lit(50.0),
            F.col("l_extendedprice") / F.lit(100000.0),
            F.col("l_discount") * F.lit(10.0),
            F.col("l_tax") * F.lit(10.0),
        ).alias("x"),
    )


def lineitem_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as the two-input examples of the sigmoid net."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.lit(None).cast("int").alias("label"),
        F.array("l_discount", "l_tax").alias("x"),
    )


def infer_shape(images: DataFrame) -> DataFrame:
    """One row (n_in, n_out) found in the data: widest vector, highest label + 1."""
    return images.agg(
        F.max(F.size("x")).alias("n_in"),
        (F.max("label") + F.lit(1)).cast("int").alias("n_out"),
    )
