"""Alignment of the tokens of two tokenizers over the same texts, by byte ranges.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model. Both cut the bytes of space + text; where tokens of
both end, a group ends. An A and a B token are linked if their byte ranges overlap, so every stretch between two neighbouring ends of
either is one link. Counts of linked id pairs over the corpus say which A id is the usual counterpart of a B id.

Identity map: for each A id the B id of the same bytes is computed beforehand. Groups of one A and one B token that are such a pair need no
pair at all: a task counts them in one vector of A's length. Only the links of other groups become pairs, first counted within a block of
texts, then shuffled and summed by pair.

Corpus counts go back to the documents by block: the table of pairs may grow with the corpus, so it is never broadcast; a block asks for
each of its different pairs once and gets its answers in one group of bounded size. What is broadcast are vectors of the vocabularies' lengths.

Defined results: texts that are NULL, empty, or whose tokens of A or B don't join to space + text have no tokens: zeros and an empty digest; strings of
special tokens are plain text; rows are handled one by one, so repeated rows count each for itself and NULL keys are kept; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from sparkgrad.llm import byte_bpe
from sparkgrad.llm.slices import by_bytes
from sparkgrad.llm.text import read
from sparkgrad.session import materialize, scratch_path

PIECES = "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
PAIRS_AT_ONCE = 1 << 16
LOW = (1 << 32) - 1
COUNTED = [StructField("n_a", LongType()), StructField("n_b", LongType()), StructField("n_groups", LongType()), StructField("n_links", LongType()),
           StructField("groups_sha256", StringType())]
PACKED = [*COUNTED, StructField("same", BinaryType()), StructField("mixed", BinaryType()), StructField("at", IntegerType()),
          StructField("pairs", ArrayType(LongType())), StructField("counts", ArrayType(LongType()))]
DOCUMENT, PAIR, SAME = 0, 1, 2


@dataclass
class Vocabularies:
    """Both tokenizers with the bytes of their ids."""

    spec: str
    model: bytes

    def __post_init__(self):
        from sentencepiece import SentencePieceProcessor

        self.a = byte_bpe.encoder(self.spec, plain=True)
        self.b = SentencePieceProcessor(model_proto=self.model)
        byte_of = {c: b for b, c in enumerate(byte_bpe.byte_characters())}
        size = max(self.a.library.get_vocab(with_added_tokens=True).values()) + 1
        self.a_bytes = [b""] * size
        for entry, i in json.loads(self.spec)["model"]["vocab"].items():
            # an entry with a character that stands for no byte is a special token's name
            self.a_bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else b""
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        first: dict[bytes, int] = {}
        for i, x in enumerate(self.b_bytes):
            if x and (x not in first or self.b.is_byte(first[x])):  # a piece before a single byte's own id
                first[x] = i
        self.same = np.array([first.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        a, b = [b"%d" % i for i in range(len(self.a_bytes))], [b"%d" % i for i in range(len(self.b_bytes))]
        self.names = [x + end for ids, ends in ((a, (b",", b"|")), (b, (b",", b";"))) for end in ends for x in ids]


@dataclass
class Aligned:
    """Tokens and links of some texts, one after the other."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    link_text: np.ndarray  # per link: number of its text
    link_a: np.ndarray  # per link: id of A
    link_b: np.ndarray
    identical: np.ndarray  # per link: a group of its own whose two ids are the identity pair


def align(texts: list[str | None], v: Vocabularies, keep_groups: list | None = None) -> Aligned:
    """``keep_groups``: a list that gets each text's groups as written into its digest."""
    wanted = [(" " + t) if t else "" for t in texts]
    packed = v.a.encode(wanted)
    by_a = [np.frombuffer(p, v.a.kind).astype(np.int64) for p in packed]
    by_b = [np.array(x, np.int64) for x in v.b.encode([t or "" for t in texts], num_threads=1)] if texts else []
    for i, text in enumerate(wanted):
        raw = text.encode("utf-8", "surrogatepass")
        whole = bool(raw) and int(v.a_sizes[by_a[i]].sum()) == len(raw) == int(v.b_sizes[by_b[i]].sum()) and (
            b"".join(map(v.a_bytes.__getitem__, by_a[i].tolist())) == raw == b"".join(map(v.b_bytes.__getitem__, by_b[i].tolist())))
        if not whole:
            by_a[i] = by_b[i] = np.zeros(0, np.int64)
    n_a, n_b = np.array([len(x) for x in by_a], np.int64), np.array([len(x) for x in by_b], np.int64)
    a, b = np.concatenate([*by_a, np.zeros(0, np.int64)]), np.concatenate([*by_b, np.zeros(0, np.int64)])
    end_a, end_b = np.cumsum(v.a_sizes[a]), np.cumsum(v.b_sizes[b])  # texts end in both, so none reaches into the next

    ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
    ends = ends[np.diff(ends, prepend=-1) > 0]
    in_a, in_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    both = (end_a[in_a] == ends) & (end_b[in_b] == ends) if len(ends) else np.zeros(0, bool)
    alone = both & np.concatenate([[True], both[:-1]]) if len(ends) else both
    link_a, link_b = a[in_a] if len(ends) else a, b[in_b] if len(ends) else b
    link_text = np.repeat(np.arange(len(texts)), n_a)[in_a] if len(ends) else np.zeros(0, np.int64)

    # written form: A tokens of a group, then its B tokens; the last of each has another mark behind it
    shared = ends[both]
    group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
    upto_a, upto_b = np.searchsorted(end_a, shared, "right"), np.concatenate([[0], np.searchsorted(end_b, shared, "right")])
    size_a, size_b = len(v.a_bytes), len(v.b_bytes)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + upto_b[group_a]] = a + size_a * np.isin(end_a, shared, assume_unique=True)
    codes[np.arange(len(b)) + (upto_a[group_b] if len(b) else 0)] = 2 * size_a + b + size_b * np.isin(end_b, shared, assume_unique=True)
    names, at, digests = v.names, 0, []
    for n in (n_a + n_b).tolist():
        written = b"".join(map(names.__getitem__, codes[at:at + n].tolist()))[:-1]
        digests.append(hashlib.sha256(written).hexdigest() if n else "")
        if keep_groups is not None:
            keep_groups.append(written.decode())
        at += n
    count = lambda some: np.bincount(link_text[some], minlength=len(texts))
    return Aligned(n_a, n_b, count(both), count(slice(None)), digests, link_text, link_a, link_b, alone & (v.same[link_a] == link_b))


@dataclass
class Alignment:
    """``pairs``: (a, b, links) over the corpus. ``documents``: per row the kept columns, the counts of tokens, groups and
    links, the digest of the groups, n_best and count_sum."""

    pairs: DataFrame
    documents: DataFrame


def _packed_blocks(docs: DataFrame, keep: tuple[str, ...], text: str, held, block_bytes: int, path: str) -> DataFrame:
    """Three kinds of written rows: documents with their links packed, pairs per block, identity pairs per task."""
    source = docs.select(*keep, F.col(text).cast("string").alias("\0text"))
    width = len(keep)
    schema = StructType([StructField("kind", IntegerType()), StructField("block", LongType()),
                         *[StructField(f"key{i}", f.dataType) for i, f in enumerate(source.schema.fields[:-1])], *PACKED])
    arrow = to_arrow_schema(schema)

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow],
                                          arrow.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabularies(*held.value)
        kind_a, seen = v.a.kind, np.zeros(len(v.a_bytes), np.int64)
        first = TaskContext.get().partitionId() << 32
        waiting: list[dict] = []
        pairs: list[np.ndarray] = []
        size = 0

        def flush(block: int) -> Iterator[pa.RecordBatch]:
            different, place, counts = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
            place, at = place.astype("<u4"), 0
            for part in waiting:
                bounds = at + np.concatenate([[0], np.cumsum(part.pop("n_mixed"))])
                mixed = [place[i:j].tobytes() for i, j in zip(bounds.tolist(), bounds[1:].tolist())]
                at = int(bounds[-1])
                n = len(mixed)
                yield rows(n, kind=np.full(n, DOCUMENT), block=np.full(n, block), mixed=mixed, **part)
            for i in range(0, len(different), PAIRS_AT_ONCE):
                some = slice(i, i + PAIRS_AT_ONCE)
                yield rows(1, kind=[PAIR], block=[block], at=[i], pairs=[different[some]], counts=[counts[some]])
            waiting.clear()
            pairs.clear()

        for batch in batches:
            for part in by_bytes(batch, width):
                found = align(part.column(width).to_pylist(), v)
                n = part.num_rows
                same = found.link_a[found.identical]
                seen += np.bincount(same, minlength=len(seen))
                bounds = np.searchsorted(found.link_text[found.identical], np.arange(n + 1)).tolist()
                packed = same.astype(kind_a)
                rest = ~found.identical
                pairs.append(found.link_a[rest] << 32 | found.link_b[rest])
                waiting.append(dict(
                    n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups, n_links=found.n_links, groups_sha256=found.digests,
                    same=[packed[i:j].tobytes() for i, j in zip(bounds, bounds[1:])], n_mixed=np.bincount(found.link_text[rest], minlength=n),
                    **{f"key{i}": part.column(i) for i in range(width)}))
                size += part.column(width).nbytes
                if size >= block_bytes:
                    yield from flush(first)
                    first, size = first + 1, 0
        yield from flush(first)
        some = np.flatnonzero(seen)
        yield rows(1, kind=[SAME], block=[first], at=[0], pairs=[some << 32 | v.same[some]], counts=[seen[some]])

    source.mapInArrow(run, schema).write.partitionBy("kind").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """``rows``: (i, n), at most ``size`` of them."""
    out = np.zeros(size, np.int64)
    for r in rows.collect():
        out[r["i"]] = r["n"]
    return out


def align_corpus(docs: DataFrame, spec_path: str, model_path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> Alignment:
    """``spec_path``, ``model_path``: vocabulary files on the driver."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    with open(model_path, "rb") as file:
        files = byte_bpe.file_text(spec_path), file.read()
    v, held = Vocabularies(*files), sc.broadcast(files)
    written = _packed_blocks(docs, keep, text, held, block_bytes, scratch_path(spark, "alignment"))
    of_kind = lambda kind: written.where(F.col("kind") == kind)

    each = F.posexplode(F.arrays_zip("pairs", "counts")).alias("pos", "p")
    asked = of_kind(PAIR).select("block", "at", each).select("block", (F.col("at") + F.col("pos")).alias("place"), F.col("p.pairs").alias("pair"),
                                                            F.col("p.counts").alias("n"))
    same = of_kind(SAME).select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts").toDF("pair", "n")
    totals = materialize(asked.select("pair", "n").unionByName(same).groupBy("pair").agg(F.sum("n").alias("links")), "alignment-pairs")
    high, low = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit(LOW))
    best = _vector(totals.groupBy(low.alias("i")).agg(F.max("links").alias("n")), len(v.b_bytes))
    there = np.flatnonzero(v.same >= 0)
    identity = F.broadcast(spark.createDataFrame(pa.table({"pair": there << 32 | v.same[there]})))  # at most one row per id of A
    same_total = _vector(totals.join(identity, "pair").select(high.alias("i"), F.col("links").alias("n")), len(v.a_bytes))
    same_best = (same_total > 0) & (same_total == best[v.same])
    numbers = sc.broadcast((same_total, same_best.astype(np.int64), best, v.a.kind))

    answers = asked.join(totals, "pair").select(F.col("block").alias("asker"), "place", "pair", "links")
    fields = [StructField(n, f.dataType) for n, f in zip(keep, docs.select(*keep).schema.fields)]
    out = StructType([*fields, *COUNTED, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    arrow = to_arrow_schema(out)

    def finish(documents: pa.Table, answers: pa.Table) -> pa.Table:
        same_total, same_best, best, kind = numbers.value
        pair, links, order = (answers.column(c).to_numpy() for c in ("pair", "links", "place"))
        total, is_best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
        total[order], is_best[order] = links, links == best[pair & LOW]

        def sums(column: str, kind: str, vectors: tuple[np.ndarray, ...]) -> list[np.ndarray]:
            raw = [x.as_py() for x in documents.column(column)]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in raw])]) // np.dtype(kind).itemsize
            at = np.frombuffer(b"".join(raw), kind)
            return [np.diff(np.concatenate([[0], np.cumsum(x[at])])[bounds]) for x in vectors]

        same_sums, mixed_sums = sums("same", kind, (same_best, same_total)), sums("mixed", "<u4", (is_best, total))
        columns = [documents.column(f"key{i}") for i in range(len(fields))] + [documents.column(f.name) for f in COUNTED]
        return pa.table([*columns, *[pa.array(x + y) for x, y in zip(same_sums, mixed_sums)]], schema=arrow)

    documents = of_kind(DOCUMENT).select("block", *[f"key{i}" for i in range(len(fields))], *[f.name for f in COUNTED], "same", "mixed")
    done = documents.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(finish, out)
    return Alignment(totals.select(high.cast("int").alias("a"), low.cast("int").alias("b"), "links"), done)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align_corpus(read(spark, sf_dir, "documents"), byte_bpe.vocabulary_path(), byte_bpe.vocabulary_path(PIECES))
    return found.documents
