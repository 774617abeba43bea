"""Declared table schemas."""

from pyspark.sql import types as T

LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# (layer, out, in, w): one row per parameter; `in` = BIAS_KEY holds the bias.
BIAS_KEY = -1
PARAMS = T.StructType([
    T.StructField("layer", INT, False),
    T.StructField("out", INT, False),
    T.StructField("in", INT, False),
    T.StructField("w", DOUBLE),
])

PREDICTION_LOG = T.StructType([
    T.StructField("id", LONG, False),
    T.StructField("label", INT),
    T.StructField("prediction", INT),
])


def image_schema(n_pixels: int, with_id: bool = True) -> T.StructType:
    """Wide image table: (id,) label, pixel0 .. pixel{n-1}."""
    lead = [T.StructField("id", LONG)] if with_id else []
    return T.StructType(
        lead
        + [T.StructField("label", INT)]
        + [T.StructField(f"pixel{i}", DOUBLE) for i in range(n_pixels)]
    )
