"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where more than half of its word shingles' XXH64 values have it. Two
fingerprints within ``radius`` bits are linked. Fingerprints are cut into segments; by the pigeonhole
principle a pair within the radius is near in one segment, so each fingerprint looks up the small Hamming ball
around each of its segments in the table of segments, and the pairs met are verified over all 64 bits.
With 2 segments and radius 2 that is one ball of radius 1 (33 keys of 32 bits) and one exact key.

Equal fingerprints are one node from the start, so a group of copies of any size costs one row; the rest
are equi-joins on (segment, key), whose hot keys Spark can split. Components come from ``components``.

Defined results: a NULL text or one without a word has fingerprint zero and is linked like any other;
a NULL key is grouped like any other and never is a component's number unless all keys of it are NULL;
rows that repeat a key are grouped by their texts; an empty table gives an empty result; further columns are ignored or, in
``one_of_each``, passed through.
"""

from __future__ import annotations

from itertools import chain, combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.components import components
from sparkgrad.llm.slices import map_texts
from sparkgrad.llm.text import read
from sparkgrad.session import materialize

SHINGLE = 3
RADIUS = 2
SEGMENTS = 2
SEED = 42
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*[words[k:] for k in range(shingle)])) if len(words) >= shingle else iter([b" ".join(words)])
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        size = min(CHUNK, n - start)
        h = np.fromiter((xxhash.xxh64_intdigest(next(shingles), SEED) for _ in range(size)), np.uint64, size)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp), one row per input row."""
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("t"))
    return map_texts(source, "t", ("id",), "fp long", lambda: lambda found: ([fingerprint(t) for t in found],))


def balls(radius: int, segments: int) -> list[tuple[int, int, list[int]]]:
    """Per segment: first bit, mask, and the differences to look up.

    A pair that differs in ``radius`` bits can't differ in more than its share in all segments at once: the
    first segments get the whole share, the others one bit less, and those with less than none aren't needed.
    """
    width, share, extra = 64 // segments, radius // segments, radius % segments + 1
    if width * segments != 64:
        raise ValueError("the segments have to be equal")
    out = []
    for k in range(segments):
        reach = share if k < extra else share - 1
        if reach >= 0:
            flips = chain.from_iterable(combinations(range(width), d) for d in range(reach + 1))
            out.append((k * width, (1 << width) - 1, [sum(1 << b for b in f) for f in flips]))
    return out


def ball(segment: Column, flips: list[int]) -> Column:
    """All keys around a segment."""
    return F.transform(F.array(*[F.lit(f).cast("long") for f in flips]), lambda flip: flip.bitwiseXOR(segment))


def links(distinct: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (u, v), u < v, of different fingerprints within the radius. ``distinct``: one row per fp."""
    pieces = balls(radius, segments)
    cut = lambda shift, mask: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(mask))
    table = distinct.select("fp", F.posexplode(F.array(*[cut(s, m) for s, m, _ in pieces])).alias("segment", "at")).select(
        F.col("fp").alias("v"), "segment", "at")
    probes = distinct.select("fp", F.posexplode(F.array(*[
        ball(cut(s, m), flips) for s, m, flips in pieces])).alias("segment", "ball")).select(
        F.col("fp").alias("u"), "segment", F.explode("ball").alias("at"))
    return probes.join(table, ["segment", "at"]).where(
        (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS,
                    segments: int = SEGMENTS) -> DataFrame:
    """(id, fp, component_id), one row per input row; component_id is the smallest id of the group."""
    prints = materialize(fingerprints(docs, key, text), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "fingerprints-distinct")
    roots = components(links(distinct, radius, segments))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("id", "fp", "component_id")


def hashed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, t), one row per input row."""
    t = F.col(text).cast("string")
    return docs.select(F.col(key).alias("id"), F.xxhash64(t).alias("text_hash"), t.alias("t"))


def fingerprint_groups(rows: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """(id, text_hash, root), one row per row of (id, text_hash, t); root names the component."""
    both = materialize(fingerprints(rows.select(F.struct("id", "text_hash").alias("of"), "t"), "of", "t"), "fingerprints")
    roots = components(links(materialize(both.select("fp").distinct(), "fingerprints-distinct"), radius, segments))
    return both.join(roots, F.col("fp") == F.col("node"), "left").select("id.id", "id.text_hash", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS,
                segments: int = SEGMENTS) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest key (NULL is the last); the input's columns.

    Between rows of one key in one group the text's hash decides; rows equal in key and text are one document. Rows that
    repeat a key in different groups are different documents.
    """
    order = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")
    groups = fingerprint_groups(hashed(docs, key, text), radius, segments)
    kept = materialize(groups.groupBy("root", "id", "text_hash").agg(F.count("*").alias("rows")).groupBy("root").agg(
        F.min(F.struct(order.alias("order"), "rows")).alias("least")).select("least.order.id", "least.order.text_hash", "least.rows"), "kept")
    among = lambda ids: docs.join(
        ids, docs[key].eqNullSafe(ids["id"]) & (F.xxhash64(docs[text].cast("string")) == ids["text_hash"]), "left_semi")
    repeated = kept.where("rows > 1")
    if repeated.isEmpty():
        return among(kept)
    return among(kept.where("rows = 1")).unionByName(among(repeated).dropDuplicates([key, text]))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
