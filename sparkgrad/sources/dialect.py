"""CSV whose dialect is found in the file, with the lines that don't fit kept apart."""

from __future__ import annotations

import csv
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SEPARATORS = ";\t|,"  # the comma last, as numbers and prose have it too
SAMPLE_LINES, SAMPLE_CHARS = 200, 10_000


@dataclass(frozen=True)
class Dialect:
    sep: str
    header: bool


def detect_dialect(spark: SparkSession, path: str, names: list[str] | None = None) -> Dialect:
    """Separator and header of the first file by name, from its first ``SAMPLE_LINES`` lines.

    The separator is the one that cuts most lines into the same number of fields, two or more; of equal ones the one
    with more fields, then the order of ``SEPARATORS``. The first line is a header if it has the given ``names``, or,
    without names, no number although a later line has one. A file of single fields has the separator ``,``.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        raise ValueError(f"no file in {path}")
    lines = [r[0] for r in spark.read.text(files[0]).select(F.substring("value", 1, SAMPLE_CHARS)).limit(SAMPLE_LINES).collect()]
    lines = [line for line in lines if line.strip()]

    def fit(sep: str) -> tuple[int, int]:
        counts = Counter(n for n in (len(row) for row in csv.reader(lines, delimiter=sep)) if n > 1)
        return max(((times, n) for n, times in counts.items()), default=(0, 0))

    sep = max(SEPARATORS, key=fit)  # the first of equal ones
    sep = sep if fit(sep)[0] else ","
    rows = list(csv.reader(lines, delimiter=sep))
    if not rows:
        return Dialect(sep, False)
    if names is not None:
        return Dialect(sep, [f.strip().lower() for f in rows[0]] == [n.lower() for n in names])
    return Dialect(sep, not any(map(_number, rows[0])) and any(_number(f) for row in rows[1:] for f in row))


def _number(field: str) -> bool:
    try:
        float(field)
    except ValueError:
        return False
    return True


def load_csv(spark: SparkSession, path: str, schema: StructType, out: str,
             dialect: Dialect | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse a CSV once into a table of rows and a table of rejects (line, file).

    Rejected are lines with too few or too many fields and lines with a value that is not of its column's type. An empty
    field is NULL and no fault. Every line other than the header is in one of the two.
    """
    dialect = dialect or detect_dialect(spark, path, schema.names)
    whole = StructType(list(schema.fields)).add("_line", "string")
    parsed = spark.read.schema(whole).option("header", dialect.header).option("sep", dialect.sep).option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path)
    tagged = parsed.withColumn("_file", F.col("_metadata.file_path")).withColumn("rejected", F.col("_line").isNotNull())
    tagged.write.mode("overwrite").partitionBy("rejected").parquet(out)
    stored = StructType(list(whole.fields)).add("_file", "string").add("rejected", "boolean")
    both = spark.read.schema(stored).parquet(out)
    return (both.where("NOT rejected").select(*schema.names),
            both.where("rejected").selectExpr("_line AS line", "_file AS file"))
