"""Importance resampling of documents towards a target distribution of hashed n-grams.

Features are all runs of 1 to ``max_n`` consecutive words; a feature's bucket is its CRC-32 modulo ``buckets``. Bucket counts of
all documents and of all target texts (with one added) give each bucket a gain, the scaled logarithm of its share in
the target over that in the corpus. A document's weight is the sum of its features' gains; with Gumbel noise drawn from its key
on top, the highest scores are a sample without replacement by importance.

Words are found a slice of texts at a time (batch concatenation): the texts are joined with a separator that occurs nowhere in
them, one regex pass finds all words and separators, and a search in the separators' places gives each word its document, by which runs that
reach over two documents are masked before the buckets are counted.

Each text is read once. Its buckets are written as packed numbers, from which counts (one vector of ``buckets`` numbers per task, then a
sum by bucket) and weights are taken. Gains are one number per bucket, so their size is fixed. Ranks come from a range partitioning by
score, not from one sorted task.

Defined results: a NULL or empty text or one without a word has no features and weight 0; a NULL key draws its noise as an empty string would, and
comes last among equal scores; rows that repeat a key have equal noise and are drawn as separate rows; among rows equal in score and key the order
is that of the input rows; an empty table gives an empty result, empty targets gains against zero counts; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.slices import map_texts
from sparkgrad.llm.text import read
from sparkgrad.session import materialize
from sparkgrad.sources.row_ids import assign_row_ids_by

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SALT = "2024"
CACHE_ENTRIES = 300_000

# A-Z to a-z; the separator's own character becomes a space, which no word holds either
LOWER = bytes.maketrans(bytes(range(65, 91)) + b"\0", bytes(range(97, 123)) + b" ")
SEPARATOR = b"\0"
# bytes of UTF-8 from 0x80 on belong to characters from U+0080 on; the separator is found like a word
WORD = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")


class WordBuckets(dict):
    """Bucket of each word met; the separator has -1."""

    def __init__(self, buckets: int):
        super().__init__({SEPARATOR: -1})
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        found = crc32(word) % self.buckets
        self[word] = found
        return found

    def trim(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.clear()
            self[SEPARATOR] = -1


def slice_features(texts: list[str | None], cache: WordBuckets, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, bounds of each text's features, and all features' buckets, text by text."""
    joined = SEPARATOR.join([(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in texts])
    found = WORD.findall(joined)
    codes = np.fromiter(map(cache.__getitem__, found), np.int64, len(found))
    cache.trim()
    marks = np.flatnonzero(codes < 0)  # a separator ends each text but the last
    place = np.flatnonzero(codes >= 0)
    doc = np.searchsorted(marks, place)
    words = np.bincount(doc, minlength=len(texts))
    buckets, owners = [codes[place]], [doc]
    if max_n > 1:
        spoken = [w for w in found if w != SEPARATOR]
        runs = spoken
        for n in range(2, max_n + 1):
            runs = [a + b" " + b for a, b in zip(runs, spoken[n - 1:])]
            inside = doc[:len(doc) - n + 1] == doc[n - 1:]
            grams = np.fromiter((crc32(r) % cache.buckets for r in runs), np.int64, len(runs))
            buckets.append(grams[inside])
            owners.append(doc[:len(doc) - n + 1][inside])
    all_buckets, owner = np.concatenate(buckets), np.concatenate(owners)
    if max_n > 1:
        order = np.argsort(owner, kind="stable")
        all_buckets, owner = all_buckets[order], owner[order]
    return words, np.searchsorted(owner, np.arange(len(texts) + 1)), all_buckets


def features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """The columns in ``keep``, n_words, n_features and the buckets as packed numbers."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def make():
        cache = WordBuckets(buckets)

        def work(texts):
            words, bounds, found = slice_features(texts, cache, max_n)
            packed, width = found.astype(kind).tobytes(), np.dtype(kind).itemsize
            return words, np.diff(bounds), [packed[a * width:b * width] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

        return work

    return map_texts(docs, text, keep, "n_words long, n_features long, packed binary", make)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; each task adds up a vector of its own first."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in found.where("n_features > 0").select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def weights(found: DataFrame, gain: np.ndarray, keep: tuple[str, ...]) -> DataFrame:
    """The columns in ``keep``, n_words, n_features and the sum of the features' gains."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    names = [*keep, "n_words", "n_features"]
    source = found.select(*names, "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(p.as_buffer(), kind)].sum()) for p in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], [*names, "weight"])

    return source.mapInArrow(run, source.drop("packed").withColumn("weight", F.lit(0).cast("long")).schema)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", max_n: int = MAX_N,
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, salt: str = SALT) -> DataFrame:
    """(key, n_features, weight, score, rank) per row; rank is NULL for the rows that aren't drawn."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("t"))
    found = materialize(features(source, ("key",), "t", max_n, buckets), "features")
    aim = features(target.select(F.col(target_text).alias("t")), (), "t", max_n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aim, buckets))
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialize(weights(found, gain, ("key",)).withColumn("score", F.col("weight") + noise), "scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = percent * eligible.count() // 100
    order = F.struct((-F.col("score")).alias("score"), F.col("key").isNull().alias("last"), F.col("key").alias("key"))
    ranked = assign_row_ids_by(eligible.select("key", "n_features", "weight", "score", order.alias("order")), "order", "at")
    columns = ["key", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("at") <= drawn, F.col("at").cast("long")).alias("rank")).unionByName(
        scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).withColumnRenamed("key", "doc_id")


# CRC-32 is folded over the bytes of each different word, with a table that is itself made by SQL
OP12_SQL = rf"""
WITH crc_steps AS (SELECT range AS i, list_reduce([range] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256)),
crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM crc_steps),
said AS MATERIALIZED (
  SELECT 0 AS src, row_number() OVER () AS row, doc_id AS id, coalesce(text, '') AS body FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
words AS MATERIALIZED (SELECT src, row, unnest(regexp_extract_all(
  translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM said),
coded AS MATERIALIZED (SELECT w, xor(4294967295, list_reduce([4294967295] || [('0x' || hex)::BIGINT FOR hex IN regexp_extract_all(hex(w), '..')],
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % {BUCKETS} AS bucket FROM (SELECT DISTINCT w FROM words), crc_table),
counts AS (SELECT bucket, count(*) FILTER (src = 0) AS s, count(*) FILTER (src = 1) AS t FROM words JOIN coded USING (w) GROUP BY bucket),
gains AS MATERIALIZED (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
  / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts),
weighed AS (SELECT row, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN coded USING (w) JOIN gains USING (bucket) WHERE src = 0 GROUP BY row),
scored AS MATERIALIZED (SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('{SALT}:' || id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM said LEFT JOIN weighed USING (row) WHERE src = 0),
ranked AS (SELECT *, CASE WHEN n_features >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) END AS place,
  count(*) FILTER (n_features >= {MIN_WORDS}) OVER () AS eligible FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * eligible // 100 THEN place END AS rank FROM ranked
"""
