"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors lie in at most ``CELLS`` cells, each around a centre, and a cell is dealt by hash into blocks of bounded size. The largest angle to the
centre, taken over all vectors of a cell, bounds who can be near them: a vector is sent only to the blocks of cells whose centre is within that angle plus the
threshold's. They are rotated to the axes of a PCA, so that the leading dimensions carry most of the norm. A tile
compares two blocks. It multiplies the leading ``STEP`` dimensions first and bounds what the others can still add by the product of the two suffix
norms (Cauchy-Schwarz): a pair whose sum plus bound can't reach the threshold is dropped, the others get the next dimensions. Those that
are left are verified with the cosine of the original vectors in double precision. Any rotation and any centres give the same
pairs, so both may be fitted on a bounded sample (``SAMPLE`` vectors, chosen by hash).

All rows are compared; a tile returns, instead of pairs, the number of links of each vector and a
spanning forest of at most one edge per vector, so a group of near copies of any size stays small. Equal vectors are one
row with a count and a number of its own from the start; ids are only carried along. A row is sent once to each tile that may hold a link of it.

Defined results: a vector that is NULL, empty, zero, or has a NULL or non-finite component links with nothing
and is kept; vectors of different lengths don't link; rows that share an id are one vector in the components, but count each as a link; a NULL id is
linked like any other and is the number of a component only if that has no other, then its rows are kept; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.components import components
from sparkgrad.llm.text import read
from sparkgrad.session import materialize

THRESHOLD = 0.9
BLOCK = 32768
BLOCK_BYTES = 16 << 20
LEAST_BLOCK = 512
BLOCKS = 16  # at least so many, if the blocks needn't be smaller for that than LEAST_BLOCK
CELLS = 256
ROUNDS = 6
STRIP = 1024
STEP = 16
SAMPLE = 4096
PAIRS_AT_ONCE = 1 << 18
SLACK = 1e-4  # single precision decides only what is farther below the threshold than this


def usable(v: Column) -> Column:
    """The vector is there and has finite components, not all of them zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce((F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0), F.lit(False))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def axes(vectors: np.ndarray) -> np.ndarray:
    """Columns: directions of falling second moment."""
    values, directions = np.linalg.eigh(vectors.T @ vectors)
    return directions[:, np.argsort(values)[::-1]]


def suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norm of what is left from each dimension on."""
    tail = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([tail, np.zeros((len(x), 1))]))


def near_pairs(a: np.ndarray, b: np.ndarray, rotation: np.ndarray, threshold: float, same: bool):
    """Yields index arrays (i, j) of pairs with a cosine of at least ``threshold``. ``same``: only i < j."""
    ra, rb = a @ rotation, b @ rotation
    na, nb, dim = suffix_norms(ra), suffix_norms(rb), a.shape[1]
    fa, fb = ra.astype(np.float32), rb.astype(np.float32)
    for start in range(0, len(a), STRIP):
        rows = slice(start, start + STRIP)
        k = min(STEP, dim)
        reach = fa[rows, :k] @ fb[:, :k].T
        reach += np.outer(na[rows, k].astype(np.float32), nb[:, k].astype(np.float32))
        left, right = np.nonzero(reach >= threshold - SLACK)
        left += start
        if same:
            left, right = left[left < right], right[left < right]
        for at in range(0, len(left), PAIRS_AT_ONCE):
            i, j = left[at:at + PAIRS_AT_ONCE], right[at:at + PAIRS_AT_ONCE]
            total = np.einsum("ij,ij->i", ra[i, :k], rb[j, :k])
            for low in range(k, dim, STEP):
                high = min(low + STEP, dim)
                total += np.einsum("ij,ij->i", ra[i, low:high], rb[j, low:high])
                alive = total + na[i, high] * nb[j, high] >= threshold - SLACK
                i, j, total = i[alive], j[alive], total[alive]
            sure = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
            if sure.any():
                yield i[sure], j[sure]


def join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unites the classes of i[k] and j[k]; a label is the smallest index of its class."""
    while True:
        x, y = labels[i], labels[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def compare(ids: np.ndarray, copies: np.ndarray, block: np.ndarray, vectors: np.ndarray, rotation: np.ndarray,
            threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """One tile: links per row, and the row whose class it belongs to."""
    kinds = np.unique(block)
    first = np.flatnonzero(block == kinds[0])
    second = first if len(kinds) == 1 else np.flatnonzero(block == kinds[1])
    counts, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for i, j in near_pairs(vectors[first], vectors[second], rotation, threshold, len(kinds) == 1):
        i, j = first[i], second[j]
        np.add.at(counts, i, copies[j])
        np.add.at(counts, j, copies[i])
        join_labels(labels, i, j)
    return counts, labels


def centres(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Unit centres of about ``wanted`` cells: far apart at first, then moved to the mean of what is nearest."""
    if not len(sample):
        return np.ones((1, sample.shape[1])) / max(1, sample.shape[1]) ** 0.5
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < min(wanted, len(sample)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    c = sample[chosen]
    for _ in range(ROUNDS):
        own = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        norms = np.linalg.norm(sums, axis=1)
        c = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], c)
    return c


def angles(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ c.T, -1, 1))


def may_meet(x: np.ndarray, c: np.ndarray, radius: np.ndarray, threshold: float) -> np.ndarray:
    """Per vector and cell: whether the cell can hold a vector within the threshold, by the triangle inequality of angles."""
    return angles(x, c) <= radius + np.arccos(np.clip(threshold, -1, 1)) + SLACK


def unpacked(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(pa.concat_arrays([c.flatten() for c in vectors.chunks]) if vectors.num_chunks else [], float).reshape(-1, dim)


def linked(rows: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(num, links, other) per vector and tile with a link. ``rows``: num, copies, v, all of length ``dim``."""
    spark = rows.sparkSession
    n = rows.count()
    share = min(1.0, SAMPLE / max(n, 1))
    picked = rows.where(F.pmod(F.xxhash64("num", F.lit("pca")), F.lit(1 << 30)) < share * (1 << 30)).select("v").collect()
    sample = unit_rows(np.array([r["v"] for r in picked], float)) if picked else np.zeros((0, dim))
    rotation = axes(sample) if picked else np.eye(dim)
    size = max(1, min(BLOCK, BLOCK_BYTES // (8 * dim), max(LEAST_BLOCK, -(-n // BLOCKS))))
    c = centres(sample, min(CELLS, -(-n // size)))
    kind = rows.schema["v"].dataType.simpleString()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = angles(unit_rows(unpacked(pa.chunked_array([batch.column(2)]), dim)), c)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to.argmin(axis=1), pa.int32()), pa.array(to.min(axis=1))],
                                             ["num", "copies", "v", "cell", "angle"])

    placed = materialize(rows.select("num", "copies", "v").mapInArrow(put, f"num long, copies long, v {kind}, cell int, angle double"), "cells")
    found = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()  # at most CELLS rows
    radius, blocks = np.full(len(c), -np.inf), np.zeros(len(c), np.int64)
    for r in found:
        radius[r["cell"]], blocks[r["cell"]] = r["radius"], -(-r["n"] // size)
    first = np.cumsum(blocks) - blocks

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = may_meet(unit_rows(unpacked(pa.chunked_array([batch.column(2)]), dim)), c, radius, threshold)
            own = batch.column(3).to_numpy()
            cells[np.arange(len(own)), own] = True
            lists = [np.flatnonzero(m) for m in cells]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(lists, pa.list_(pa.int32()))], ["num", "copies", "v", "cell", "cells"])

    near = placed.select("num", "copies", "v", "cell").mapInArrow(meet, f"num long, copies long, v {kind}, cell int, cells array<int>")
    at = lambda values, k: F.get(F.lit(values.tolist()), k)  # noqa: E731 - CELLS numbers
    dealt = near.withColumn("block", at(first, F.col("cell")) + F.pmod(F.xxhash64("num"), at(blocks, F.col("cell"))))
    tiles = dealt.withColumn("meets", F.explode(F.flatten(F.transform("cells", lambda k: F.sequence(at(first, k), at(first + blocks - 1, k)))))).select(
        F.least("block", "meets").alias("low"), F.greatest("block", "meets").alias("high"), "num", "copies", "block", "v")

    def tile(table: pa.Table) -> pa.Table:
        x = unit_rows(unpacked(table.column("v"), dim))
        ids, copies, block = (table.column(c).to_numpy() for c in ("num", "copies", "block"))
        if table.column("low")[0] != table.column("high")[0] and len(np.unique(block)) == 1:
            counts, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))  # the other block is empty
        else:
            counts, labels = compare(ids, copies, block, x, rotation, threshold)
        some = counts > 0
        return pa.table({"num": ids[some], "links": counts[some], "other": ids[labels[some]]})

    return tiles.groupBy("low", "high").applyInArrow(tile, "num long, links long, other long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).withColumn("ok", usable(F.col("v")))
    distinct = rows.where("ok").groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    reps = materialize(distinct.withColumn("num", F.monotonically_increasing_id()), "vectors")
    dims = sorted(r[0] for r in reps.select(F.size("v")).distinct().collect())  # few: the lengths of the vectors
    found = None
    for dim in dims:
        part = linked(reps.where(F.size("v") == dim), dim, threshold)
        found = part if found is None else found.unionByName(part)
    plain = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if found is None:
        return plain
    found = materialize(found, "links")
    links = found.groupBy("num").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("num").alias("u"), F.col("other").alias("v"))
    several = rows.where("ok AND id IS NOT NULL").groupBy("id").agg(
        F.min(F.xxhash64("v")).alias("h1"), F.max(F.xxhash64("v")).alias("h2")).where("h1 <> h2").select(F.col("id").alias("shared"))
    if not several.isEmpty():
        of = rows.where("ok").join(several, F.col("id") == F.col("shared")).join(reps.select(F.col("v").alias("of"), "num"), F.col("v") == F.col("of"))
        least = of.groupBy("id").agg(F.min("num").alias("least")).withColumnRenamed("id", "i")
        edges = edges.unionByName(of.join(least, F.col("id") == F.col("i")).select(F.col("num").alias("u"), F.col("least").alias("v")))
    roots = components(edges)
    named = materialize(reps.join(links, "num", "left").join(roots, F.col("num") == F.col("node"), "left").select(
        F.col("v").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "num").alias("root"), "first"), "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.where("ok").join(named.join(smallest, "root"), F.col("v") == F.col("of")).select(
        "id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(plain)


def op3_embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


# every pair of usable vectors, and all that can be reached over links; rows are numbered, as ids may repeat or be NULL
OP3_SQL = f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
usable AS MATERIALIZED (SELECT r, vec_id, embedding::DOUBLE[] AS v FROM e
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM usable AS a JOIN usable AS b ON a.r <> b.r
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= {THRESHOLD} ELSE false END),
hops AS MATERIALIZED (SELECT a, b FROM links UNION SELECT a.r, b.r FROM usable AS a JOIN usable AS b ON a.vec_id = b.vec_id AND a.r <> b.r),
reach(r, root) AS (SELECT r, r FROM e UNION SELECT hops.b, reach.root FROM reach JOIN hops ON hops.a = reach.r),
classes AS (SELECT reach.r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.root GROUP BY reach.r),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN classes ON classes.r = e.r LEFT JOIN counts ON counts.a = e.r
"""
