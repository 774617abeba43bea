"""Removal of repeated byte strings by difference-cover blockwise suffix sorting.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier (in a document with a smaller
id, or earlier in the same one). Sorting all suffixes would need a record per byte of the corpus, so
suffixes are bucketed first, and whole buckets without a repeat never leave their document:

1. Anchors. Of the ``GRAM``-byte strings inside each window of ``length`` bytes those with the smallest
   hash are anchors; equal windows have equal anchors. About 3 in 100 bytes are one. An anchor's hash is
   its bucket: all suffixes that start at most ``reach`` bytes before it.
2. Copies. Occurrences of an anchor with equal surroundings (all windows around it are then equal) are
   one class: the first one stays, the others' windows are repeats. This is done inside each Arrow batch first,
   then per bucket, so a passage of any frequency is a row per batch at most.
3. Suffix sort. First occurrences whose anchor also has other surroundings send those bytes. ``cover_sort`` sorts one
   bucket of suffixes (one distance to the anchor) at a time: by the bytes up to the next position of a
   difference cover, and long ties by the precomputed rank of that cover sample. Only sample
   positions have ranks, which bounds the memory. In the sorted bucket a group of equal strings is adjacent;
   all but its first are repeats.
4. Repeats meet their document, and the bytes that they cover go.

Frequent anchors. A phrase of 32 to 99 bytes in every document is one anchor with as many surroundings. Anchors of about ``HOT`` or more
surroundings are found in a sample of the documents first (at least one in ``SAMPLE_ONE_IN``); the ``HOT_GRAMS`` most frequent are dealt by their
surroundings in step 2, all others by the anchor, so the largest group has about ``HOT`` rows or one in ``HOT_GRAMS`` of all, whichever is more. The sample only decides how rows
are dealt; results don't depend on it. In step 3 an anchor with more than ``HOT`` surroundings isn't sorted in one task: its suffixes are split by distance and by a
longer common string, again and again; strings of full length need no sort but a grouped minimum.

Order: by id, then by a hash of the text (for different texts under one id), then by place. Defined results: a NULL
or empty text has nothing to remove; identical rows (id and text) are one document and get one result; a NULL id
comes last; an empty table gives an empty result; further columns are ignored or, in ``dedup_text``, passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.slices import by_bytes
from sparkgrad.llm.text import read
from sparkgrad.session import materialize

LENGTH = 100
GRAM = 32
PERIOD = 64
HOT = 20_000
BUCKET_BYTES = 4 << 20
HOT_GRAMS = 1 << 20
SAMPLE_BYTES = 64 << 20
SAMPLE_ONE_IN = 1000
SAMPLE_HITS = 8
PIECE = 1 << 20
TOGETHER = 16 << 20
LAST = (1 << 63) - 1
SPAN = "id long, tie long, start long, stop long"


def difference_cover(period: int) -> list[int]:
    """Residues such that every residue is a difference of two: 0..r-1 and the multiples of r."""
    r = isqrt(period - 1) + 1
    return sorted({*range(r), *range(0, period, r)})


# ---- rolling hashes and anchors --------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, and the powers of an odd base and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    values = np.random.default_rng(9).integers(1, 1 << 63, 256, np.uint64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(base, -1, 1 << 64), np.uint64)])
    return values, up, down


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of each run of ``width`` values."""
    span, now = 1, values
    while 2 * span <= width:
        now = pick(now[:-span], now[span:])
        span *= 2
    return now if span == width else pick(now[:len(values) - width + 1], now[width - span:])


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """place, hash of the gram, hash of the surroundings, bytes there on the left and on the right; by place."""
    n, reach = len(data), length - gram
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    values, up, down = powers(PIECE + 4 * length)
    found = []
    for begin in range(0, n - length + 1, PIECE):  # windows that start in this piece
        low, high = max(0, begin - reach), min(n, begin + PIECE + 2 * length)
        x = np.frombuffer(data, np.uint8, high - low, low)
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(values[x] * up[:len(x)], out=sums[1:])
        first, grams = begin - low, min(begin + PIECE, n - length + 1) - begin + reach
        at = np.arange(first, first + grams)
        h = (sums[at + gram] - sums[at]) * down[at]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        least = sliding(h, reach + 1, np.minimum)
        edge = np.zeros(reach, np.uint64)
        chosen = at[sliding(np.r_[edge, least, edge], reach + 1, np.maximum) == h]
        place = chosen + low
        left, right = np.minimum(place, reach), np.minimum(n - place, length)
        around = (sums[chosen + right] - sums[chosen - left]) * down[chosen - left]
        found.append((place, h[chosen - first], around, left, right))
    out = tuple(np.concatenate(c) for c in zip(*found))
    keep = np.unique(out[0], return_index=True)[1]  # neighbouring pieces share some
    return tuple(c[keep] for c in out)


def later_copies(order: tuple[np.ndarray, ...], same: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sorts rows by ``same``, then by ``order``; returns the sorting and whether a row has an equal one before it."""
    by = np.lexsort((*order[::-1], *same[::-1]))
    again = np.zeros(len(by), bool)
    if len(by):
        again[1:] = np.logical_and.reduce([c[by][1:] == c[by][:-1] for c in same])
    return by, again


def repeated(by: np.ndarray, again: np.ndarray, ids: np.ndarray, ties: np.ndarray, place: np.ndarray, left: np.ndarray,
             right: np.ndarray, length: int) -> np.ndarray:
    """Rows with an equal one before them that hold a whole window; the same place of an identical document is no earlier one."""
    twin = np.zeros(len(by), bool)
    if len(by):
        twin[1:] = np.logical_and.reduce([c[by][1:] == c[by][:-1] for c in (ids, ties, place)])
    rows = by[again & ~twin]
    return rows[left[rows] + right[rows] >= length]


def merged(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each owner united where they touch. ``owner``: small non-negative numbers."""
    if not len(owner):
        return owner, start, stop
    by = np.lexsort((start, owner))
    owner, start, stop = owner[by], start[by], stop[by]
    shift = owner * (int(stop.max()) + 2)  # no span reaches into the next owner's
    reach = np.maximum.accumulate(stop + shift)
    head = np.r_[True, start[1:] + shift[1:] > reach[:-1]]
    tail = np.r_[np.flatnonzero(head)[1:] - 1, len(head) - 1]
    return owner[head], start[head], reach[tail] - shift[tail]


def spans_table(ids, ties, owner, start, stop) -> pa.RecordBatch:
    owner, start, stop = merged(owner, start, stop)
    return pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(ties[owner]), pa.array(start), pa.array(stop)],
                                      ["id", "tie", "start", "stop"])


ENTRY = np.dtype([("gram", "<u8"), ("around", "<u8"), ("id", "<i8"), ("tie", "<i8"), ("place", "<i8"), ("left", "<i2"), ("right", "<i2")])


def hot_grams(texts: DataFrame, length: int, gram: int, total: int) -> np.ndarray:
    """Hashes of the anchors with about HOT or more surroundings, at most HOT_GRAMS, sorted. ``total``: bytes of all texts."""
    rate = min(1.0, max(1 / SAMPLE_ONE_IN, SAMPLE_BYTES / max(total, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 0):
                found = [anchors(d or b"", length, gram) for d in part.column(0).to_pylist()]
                pairs = np.unique(np.stack([np.concatenate([f[k] for f in found]) for k in (1, 2)]), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["gram", "around"])

    some = texts.where(F.pmod(F.xxhash64("id", "tie", F.lit("hot")), F.lit(1 << 30)) < rate * (1 << 30)).select("data")
    counts = some.mapInArrow(run, "gram long, around long").distinct().groupBy("gram").agg(F.count("*").alias("n"))
    found = counts.where(F.col("n") >= max(SAMPLE_HITS, HOT * rate)).orderBy(F.desc("n"), "gram").limit(HOT_GRAMS).collect()
    return np.sort(np.array([r["gram"] for r in found], np.int64).view(np.uint64))


def bucketed(texts: DataFrame, length: int, gram: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Rows of a bucket: anchors as packed columns (block), or a span that is decided already (block NULL).

    An anchor's bucket follows from its hash, or from that of its surroundings if it is one of ``hot``.
    """
    hot_held = texts.sparkSession.sparkContext.broadcast(hot)  # at most HOT_GRAMS numbers
    schema = pa.schema([("bucket", pa.int32()), ("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("block", pa.binary())])

    def rows(ids: np.ndarray, ties: np.ndarray, parts: list[tuple[np.ndarray, ...]], owner: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, h, around, left, right = (np.concatenate(c) for c in zip(*parts))
        by, again = later_copies((ids[owner], ties[owner], place), (h, around, left, right))
        whole = repeated(by, again, ids[owner], ties[owner], place, left, right, length)
        who, start, stop = merged(owner[whole], place[whole] - left[whole], place[whole] + right[whole])
        yield pa.RecordBatch.from_arrays([
            pa.array((who % buckets).astype(np.int32)), pa.array(ids[who]), pa.array(ties[who]), pa.array(start), pa.array(stop),
            pa.nulls(len(who), pa.binary())], schema=schema)
        head = by[~again]
        bucket = (np.where(np.isin(h[head], hot_held.value), around[head], h[head]) % np.uint64(buckets)).astype(np.int32)
        head, bucket = head[np.argsort(bucket, kind="stable")], np.sort(bucket, kind="stable")
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        packed = []
        for e in np.split(head, cuts[1:]):
            columns = (h[e], around[e], ids[owner[e]], ties[owner[e]], place[e], left[e], right[e])
            packed.append(b"".join(c.astype(ENTRY[i]).tobytes() for i, c in enumerate(columns)))
        none = pa.nulls(len(packed), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), none, none, none, none, pa.array(packed, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts, owner, size = [], [], 0
            for k in range(len(ids)):
                data = batch.column(2)[k].as_py() or b""
                found = anchors(data, length, gram)
                if len(found[0]):
                    parts.append(found)
                    owner.append(np.full(len(found[0]), k))
                    size += len(data)
                if size >= TOGETHER:
                    yield from rows(ids, ties, parts, np.concatenate(owner))
                    parts, owner, size = [], [], 0
            if parts:
                yield from rows(ids, ties, parts, np.concatenate(owner))

    return texts.select("id", "tie", "data").mapInArrow(run, f"bucket int, {SPAN}, block binary")


def unpack(blocks: list[bytes]) -> list[np.ndarray]:
    size = ENTRY.itemsize
    columns = [[] for _ in ENTRY.names]
    for block in blocks:
        n, at = len(block) // size, 0
        for i, name in enumerate(ENTRY.names):
            kind = ENTRY[name]
            columns[i].append(np.frombuffer(block, kind, n, at))
            at += n * kind.itemsize
    return [np.concatenate(c) for c in columns]


def classes(anchored: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    """Spans of repeated surroundings (gram NULL), and first occurrences whose anchor has other surroundings too, as all ``hot`` ones do."""
    hot_held = anchored.sparkSession.sparkContext.broadcast(hot)
    schema = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("gram", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        decided = table.filter(pc.is_null(table.column("block"))).select(["id", "tie", "start", "stop"])
        decided = decided.append_column("gram", pa.nulls(len(decided), pa.int64())).cast(schema)
        blocks = table.column("block").drop_null().to_pylist()
        if not blocks:
            return decided
        gram, around, ids, ties, place, left, right = unpack(blocks)
        left, right = left.astype(np.int64), right.astype(np.int64)
        by, again = later_copies((ids, ties, place), (gram, around, left, right))
        whole = repeated(by, again, ids, ties, place, left, right, length)
        key, owner = np.unique(np.stack([ids[whole], ties[whole]]), axis=1, return_inverse=True)
        owner, start, stop = merged(owner.ravel(), place[whole] - left[whole], place[whole] + right[whole])
        heads = by[~again]  # still sorted by gram
        equal = gram[heads][1:] == gram[heads][:-1]
        heads = heads[np.r_[False, equal] | np.r_[equal, False] | np.isin(gram[heads], hot_held.value)]
        copies = pa.table([pa.array(key[0][owner]), pa.array(key[1][owner]), pa.array(start), pa.array(stop),
                           pa.nulls(len(owner), pa.int64())], schema=schema)
        firsts = pa.table([pa.array(ids[heads]), pa.array(ties[heads]), pa.array(place[heads]), pa.nulls(len(heads), pa.int64()),
                           pa.array(gram[heads].view(np.int64))], schema=schema)
        return pa.concat_tables([decided, copies, firsts])

    return anchored.groupBy("bucket").applyInArrow(run, f"{SPAN}, gram long")


def surroundings(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, id, tie, place, left, around) with the bytes around each wanted anchor (start)."""
    reach = length - gram
    places = wanted.groupBy(F.col("id").alias("i"), F.col("tie").alias("t")).agg(F.collect_list(F.struct("gram", "start")).alias("at"))
    low = F.greatest(F.col("p.start") - reach, F.lit(0)).cast("int")
    return texts.join(places, (F.col("id") == F.col("i")) & (F.col("tie") == F.col("t"))).select(
        "id", "tie", "data", F.explode("at").alias("p")).select(
        F.col("p.gram").alias("gram"), "id", "tie", F.col("p.start").alias("place"),
        (F.col("p.start") - low).cast("int").alias("left"),
        F.substring("data", low + 1, (F.col("p.start") - low + length).cast("int")).alias("around"))


# ---- suffix sort -----------------------------------------------------------------------------------------------------

def cover_sort(key: np.ndarray, text: np.ndarray, left: np.ndarray, right: np.ndarray, length: int, period: int = PERIOD):
    """Yields (distance, rows): rows whose ``length`` bytes from ``distance`` before the anchor on equal those of an earlier row.

    ``text``: one padded row of surroundings per occurrence, in the order of occurrence, with the anchor at column
    ``reach`` in all; ``left``, ``right``: bytes that are there. Only rows with one ``key`` are compared.
    """
    n, width = text.shape
    reach = width - length
    sample = [c for c in range(reach + period) if c % period in set(difference_cover(period))]
    words = -(-length // 8) * 8
    padded = np.zeros((n, width + period + words), np.uint8)
    padded[:, :width] = text
    number = lambda a, b: np.ascontiguousarray(np.pad(padded[:, a:b], ((0, 0), (0, -(b - a) % 8)))).view(">u8")
    column, order, fresh = -1, None, None
    for start in range(reach + 1):  # one bucket of suffixes after the other
        distance = reach - start
        at = next(c for c in sample if c >= start)
        if at != column:  # ranks of the next sample: order, and bytes in common with the row before
            column = at
            tail = number(at, at + words)
            order = np.lexsort((*[tail[:, k] for k in range(tail.shape[1])][::-1], key))
            rows = padded[order, at:at + length]
            differ = rows[1:] != rows[:-1]
            common = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
            common[key[order][1:] != key[order][:-1]] = -1
        head, rest = at - start, length - (at - start)
        rank = np.empty(n, np.int64)
        rank[order] = np.r_[0, np.cumsum(common < rest)] if n else []
        valid = np.flatnonzero((left >= distance) & (right >= length - distance))
        leading = number(start, start + head)[valid] if head else np.zeros((len(valid), 0), ">u8")
        by, again = later_copies((valid,), (rank[valid], *[leading[:, k] for k in range(leading.shape[1])]))
        if again.any():
            yield distance, valid[by[again]]


def sorted_repeats(rows: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """Spans of repeated strings around anchors. ``rows``: key, least, most (distances), id, tie, place, left, around."""
    reach = length - gram

    def run(table: pa.Table) -> pa.Table:
        key, ids, ties, place, left, least, most = (table.column(c).to_numpy() for c in ("key", "id", "tie", "place", "left", "least", "most"))
        around = table.column("around").to_pylist()
        by = np.lexsort((place, ties, ids, key))
        if len(by):  # identical documents send the same place twice
            by = by[np.r_[True, np.logical_or.reduce([c[by][1:] != c[by][:-1] for c in (key, ids, ties, place)])]]
        key, ids, ties, place, left, least, most = (c[by] for c in (key, ids, ties, place, left, least, most))
        text = np.frombuffer(b"".join([bytes(reach - x) + around[i] + bytes(length - (len(around[i]) - x)) for i, x in zip(by, left)]), np.uint8).reshape(len(by), reach + length)
        right = np.array([len(around[i]) for i in by]) - left
        owners, starts = [], []
        for distance, found in cover_sort(key, text, left, right, length):
            found = found[(least[found] <= distance) & (distance <= most[found])]
            owners.append(found)
            starts.append(place[found] - distance)
        owner = np.concatenate([np.zeros(0, np.int64), *owners])
        start = np.concatenate([np.zeros(0, np.int64), *starts])
        pair, inverse = np.unique(np.stack([ids, ties]), axis=1, return_inverse=True)
        return pa.Table.from_batches([spans_table(pair[0], pair[1], inverse.ravel()[owner], start, start + length)])

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, SPAN)


def split_hot(rows: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose keys have at most HOT rows each, and spans found where whole strings are the key."""
    reach, spans = length - gram, None
    while True:
        hot = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(F.col("key").alias("hot_key"))
        if hot.isEmpty():
            return rows, spans
        hot = materialize(hot, "hot")
        cold = rows.join(hot, F.col("key") == F.col("hot_key"), "left_anti")
        halves = F.array(F.struct(F.col("least"), F.floor((F.col("least") + F.col("most")) / 2).cast("int").alias("most")),
                         F.struct((F.floor((F.col("least") + F.col("most")) / 2) + 1).cast("int").alias("least"), F.col("most")))
        parts = rows.join(hot, F.col("key") == F.col("hot_key"), "left_semi").withColumn("half", F.explode(halves)).withColumn(
            "least", F.col("half.least")).withColumn("most", F.col("half.most"))
        # bytes that all windows of these distances share
        shared = F.substring("around", (F.col("left") - F.col("least") + 1).cast("int"), (F.lit(length) - F.col("most") + F.col("least")).cast("int"))
        parts = parts.where((F.col("least") <= F.col("left")) & (F.octet_length("around") - F.col("left") >= length - F.col("most"))).withColumn(
            "key", F.xxhash64("key", "least", "most", shared)).drop("half")
        parts = materialize(parts, "hot-parts")
        one = parts.where("least = most")
        first = one.groupBy("key").agg(F.min(F.struct("id", "tie", "place")).alias("first")).withColumnRenamed("key", "k")
        repeats = one.join(first, F.col("key") == F.col("k")).where(F.struct("id", "tie", "place") > F.col("first")).select(
            "id", "tie", (F.col("place") - F.col("least")).alias("start"), (F.col("place") - F.col("least") + length).alias("stop"))
        spans = repeats if spans is None else spans.unionByName(repeats)
        rows = materialize(cold.unionByName(parts.where("least < most")), "hot-rest")


def repeats(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Repeated spans (id, tie, start, stop); they may touch and overlap. ``texts``: id, tie, data."""
    total = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = int(max(1, -(-total // BUCKET_BYTES)))
    hot = hot_grams(texts, length, gram, total)
    found = materialize(classes(bucketed(texts, length, gram, buckets, hot), length, hot), "repeats")
    spans = [found.where("gram IS NULL").select("id", "tie", "start", "stop")]
    open_ = found.where("gram IS NOT NULL").select("id", "tie", "start", "gram")
    rows = surroundings(texts, open_, length, gram).withColumnRenamed("gram", "key").withColumns(
        {"least": F.lit(0), "most": F.lit(length - gram)})
    if not open_.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > HOT).isEmpty():
        rows, whole = split_hot(materialize(rows, "surroundings"), length, gram)
        spans += [] if whole is None else [whole]
    spans.append(sorted_repeats(rows, length, gram, buckets))
    return reduce(DataFrame.unionByName, spans)


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, id, tie, data): the input's row, its place in the order, and its bytes."""
    filled = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(F.struct(*[docs[c] for c in docs.columns if c != text]).alias("row"),
                       F.coalesce(docs[key].cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(filled).alias("tie"),
                       filled.cast("binary").alias("data"))


def cut(data: bytes, spans: list[dict] | None) -> tuple[np.ndarray, int]:
    """Which bytes stay, and the number of maximal removed runs."""
    edges = np.zeros(len(data) + 1, np.int64)
    if spans:
        starts, stops = (np.array([s[c] for s in spans]) for c in ("start", "stop"))
        np.add.at(edges, starts, 1)
        np.add.at(edges, stops, -1)
    gone = np.cumsum(edges)[:-1] > 0
    return ~gone, int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0


def whole_characters(data: bytes, stays: np.ndarray) -> np.ndarray:
    """A character stays if any of its bytes does."""
    x = np.frombuffer(data, np.uint8)
    number = np.cumsum((x & 0xC0) != 0x80)
    kept = np.zeros(len(x) + 1, bool)
    kept[number[stays]] = True
    return kept[number]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per input row: row (struct of the other columns), n_bytes, n_removed, n_spans, kept (bytes), kept_text (whole characters)."""
    texts = numbered(docs, key, text)
    listed = repeats(texts.select("id", "tie", "data"), length, gram).groupBy("id", "tie").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))  # identical rows send the same spans
    joined = texts.join(listed, ["id", "tie"], "left").select("row", "data", "spans")
    schema = f"row {joined.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"
    names = ["row", "n_bytes", "n_removed", "n_spans", "kept", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(by_bytes(b, 1) for b in batches):
            out = []
            for k in range(batch.num_rows):
                data, spans = batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
                if not spans:
                    out.append((len(data), 0, 0, data, data.decode("utf-8", "replace")))
                    continue
                stays, runs = cut(data, spans)
                x = np.frombuffer(data, np.uint8)
                text = x[whole_characters(data, stays)].tobytes().decode("utf-8", "replace")
                out.append((len(data), int((~stays).sum()), runs, x[stays].tobytes(), text))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    return joined.mapInArrow(run, schema)


def dedup_text(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The input with repeated strings cut out of the text and ``n_chars`` (if there is one) counted anew.

    A character stays if any of its bytes does. Documents of which nothing but white space is left go.
    """
    done = dedup(docs, key, text).where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {text: F.col("kept_text"), n_chars: F.length("kept_text").cast(dict(docs.dtypes).get(n_chars, "long"))}
    return done.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
