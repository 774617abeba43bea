"""Arrow maps over texts, in slices bounded by bytes: what a task holds doesn't grow with the rows of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose values in ``column`` have at most ``limit`` bytes together; a longer value is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def map_texts(docs: DataFrame, text: str, keep: Sequence[str], added: str, make: Callable[[], Callable[[list], Sequence]],
              done: Callable[[], None] | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """The columns in ``keep`` and those of the DDL string ``added``.

    ``make`` is called once per task and returns a function from the texts of a slice to the added columns, each a list or
    an array; ``done``, if given, is called when the task has no more rows.
    """
    source = docs.select(*keep, F.col(text).cast("string").alias("\0text"))
    new = StructType.fromDDL(added)
    names = [*keep, *new.names]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("the names of the output columns clash")
    kinds, width = [to_arrow_type(f.dataType) for f in new.fields], len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in by_bytes(batch, width, limit):
                found = work(part.column(width).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], *[pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)]], names)
        if done:
            done()

    return source.mapInArrow(run, StructType([*source.schema.fields[:-1], *new.fields]))
