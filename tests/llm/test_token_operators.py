"""Token files, importance resampling and alignment against plain versions."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sparkgrad.llm import alignment, byte_bpe, resampling, token_files
from sparkgrad.llm.crc32c import crc32c, masked
from sparkgrad.llm.slices import by_bytes
from sparkgrad.session import scratch_path
from tests.llm.rows import AWKWARD, SCHEMA, TEXTS, frame, sf_documents
from tools.check_queries import compare, connect

PATH = byte_bpe.vocabulary_path()
PIECES = byte_bpe.vocabulary_path(alignment.PIECES)
ODD = ["a  b", "a  <|endoftext|>  b", "d'accord! x's' 'tis (it'll) ,,'',, 12.5% $1,000 a1b2 Å.B é'é", "end \n\n", " \n x\n", "x \x1c\x1d y\x1fz \x1e", " lead", "tail ", "\n\n x \t y", "it's 's  's", "a <|endoftext|> b<|endoftext|>", "　wide 　x", "\x85 \x1c x\x1d y", "--- ----", "　", "🎉🎉 é",
       "nul\0inside \0 x", "x" * 300, "ÄÖ ß", "▁ ▁▁a", "<s> <unk> </s> <0x41>", "a​b ​c", "᠎ ᠎x"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def plain_mask(crc):
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    parts = [b"123456789", bytes(32), b"abcd", bytes(range(256)) * 5, b"x" * 128, b"y" * 129, b"z" * 127]
    ends = np.cumsum([len(p) for p in parts])
    found = crc32c(np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends)
    assert found.tolist() == [plain_crc32c(p) for p in parts]
    assert found[0] == 0xE3069283 and found[1] == 0x8A9136AA  # published check values
    assert masked(found).tolist() == [plain_mask(c) for c in found.tolist()]


def test_slices_are_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n is not None else None for n in (3, 4, None, 20, 1, 1, 0, 9)])], ["t"])
    assert [p.column(0).to_pylist() for p in by_bytes(batch, 0, 8)] == [["aaa", "aaaa", None], ["a" * 20], ["a", "a", ""], ["a" * 9]]


def test_cached_words_encode_like_whole_texts(spark, sf_dir, library, monkeypatch):
    texts = [t or "" for t in TEXTS + ODD] + [r["text"] or "" for r in sf_documents(spark, sf_dir).collect()]
    for entries in (byte_bpe.CACHE_ENTRIES, 5):
        monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", entries)
        for plain in (False, True):
            encoder = byte_bpe.Encoder(byte_bpe.file_text(PATH), plain)
            assert encoder.cuts
            encoder.words.clear(), encoder.words.old.clear()
            library.encode_special_tokens = plain
            for at in range(0, len(texts), 7):
                some = texts[at:at + 7]
                assert [np.frombuffer(p, encoder.kind).tolist() for p in encoder.encode(some)] == [
                    library.encode(t, add_special_tokens=False).ids for t in some]
    library.encode_special_tokens = False


def test_a_word_that_repeats_among_texts_is_looked_up_once(library):
    encoder = byte_bpe.Encoder(byte_bpe.file_text(PATH))
    asked, inner = Counter(), encoder.words

    class Counted(dict):
        def __missing__(self, part):
            asked[part] += 1
            return inner[part]

    texts = ["one two, two, three\nfour two", None, "", " two", "two  two", "two \n two", "two ", "é two\u00a0two \x1cx x's <|endoftext|x", "\ttwo two,"] * 20
    encoder.words = Counted()
    got = [np.frombuffer(p, encoder.kind).tolist() for p in encoder.encode(pa.array(texts))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder.words, again = inner, encoder.encode(pa.array(["x"] + texts).slice(1))
    assert [np.frombuffer(p, encoder.kind).tolist() for p in again] == got
    plain = ["aa bb cc, bb"] * 50
    asked.clear()
    encoder.words = Counted()
    encoder.encode(plain)
    assert asked == {"bb": 1, "cc,": 1, "cc": 1}


def test_other_vocabularies_are_encoded_whole():
    other = byte_bpe.vocabulary_path("word_bpe_49k.json")
    encoder, whole = byte_bpe.Encoder(byte_bpe.file_text(other)), Tokenizer.from_file(other)
    whole.no_truncation(), whole.no_padding()
    assert not encoder.cuts
    assert [np.frombuffer(p, encoder.kind).tolist() for p in encoder.encode(["Two  words", None])] == [
        whole.encode("Two  words", add_special_tokens=False).ids, []]


def records_of(path):
    """A plain reader of the framing."""
    data = open(f"{path}.records", "rb").read()
    index, at = [0], 0
    while at < len(data):
        size, = struct.unpack_from("<Q", data, at)
        body = data[at + 12:at + 12 + size]
        assert struct.unpack_from("<I", data, at + 8)[0] == plain_mask(plain_crc32c(data[at:at + 8]))
        assert struct.unpack_from("<I", data, at + 12 + size)[0] == plain_mask(plain_crc32c(body))
        at += size + 16
        index.append(at)
        yield body
    assert open(f"{path}.index", "rb").read() == np.array(index, "<u8").tobytes()


def expected_files(rows, library):
    out, start = [], 0
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op11_matches_the_library(spark, sf_dir, library):
    docs = [(r["doc_id"], r["text"]) for r in sf_documents(spark, sf_dir).orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in token_files.op11_token_files(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected_files(docs, library)


def test_token_files_of_awkward_rows(spark, library):
    files = token_files.write(frame(spark), PATH, scratch_path(spark, "records"), file_bytes=2000)
    listed = files.orderBy("part", "seq").collect()
    assert len(listed) > 3
    bodies = [b for r in listed for b in records_of(r["path"])]
    keys = [struct.unpack_from("<q?", b) for b in bodies]
    order = [k if there else None for k, there in keys]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0)) and len(order) == len(AWKWARD)
    got = token_files.sequences(files).orderBy("start").collect()
    assert [(r["key"], r["ids"]) for r in got] == [token_files.opened(b) for b in bodies]
    assert Counter((r["key"], bytes(r["ids"])) for r in got) == Counter(
        (k, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for k, t, *_ in AWKWARD)
    assert [r["start"] for r in got] == [0, *np.cumsum([len(r["ids"]) // 4 for r in got])[:-1].tolist()]

    one, again, other = ([tuple(r) for r in token_files.shuffled(files, s, lot=3, tasks=2).collect()] for s in (1, 1, 2))
    assert one == again != other
    assert Counter(one) == Counter(other) == Counter((r["key"], r["ids"]) for r in got)


def test_a_damaged_record_is_an_error(spark):
    files = token_files.write(spark.createDataFrame([(1, "some text"), (2, "more")], "doc_id long, text string").coalesce(1), PATH,
                              scratch_path(spark, "records"))
    path = files.first()["path"]
    data = bytearray(open(f"{path}.records", "rb").read())
    data[40] ^= 1
    open(f"{path}.records", "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        token_files.sequences(files).collect()
    open(f"{path}.records", "wb").write(data[:-3])
    with pytest.raises(Exception, match="cut off|damaged"):
        token_files.sequences(files).collect()


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    files = token_files.write(nothing, PATH, scratch_path(spark, "records"))
    assert files.count() == 0 and token_files.sequences(files).count() == 0 and token_files.shuffled(files, 1).count() == 0
    assert resampling.resample(nothing, nothing).count() == 0
    found = alignment.align_corpus(nothing, PATH, PIECES)
    assert found.documents.count() == 0 and found.pairs.count() == 0


def plain_features(text, max_n):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, max_n=1, min_words=20, percent=10):
    found = [plain_features(t, max_n) for _, t in rows]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in plain_features(x, max_n)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (ss + 10_000.0) / ((s[b] + 1.0) * (tt + 10_000.0)))) for b in s}
    out = []
    for i, ((key, _), (n, f)) in enumerate(zip(rows, found)):
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([key, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words])
    drawn = sorted((-o[3], o[0] is None, o[0] or 0, i) for i, o in enumerate(out) if o[4])
    ranks = {d[3]: k + 1 for k, d in enumerate(drawn[:percent * len(drawn) // 100])}
    return [(*o[:4], ranks.get(i)) for i, o in enumerate(out)]


def nulls(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) if v is not None else (True, 0) for v in r))


@pytest.mark.parametrize("max_n, percent", [(1, 10), (3, 60)])
def test_resampling_of_awkward_rows(spark, max_n, percent):
    rows = [(a[0], a[1]) for a in AWKWARD] + [(1000 + i, t) for i, t in enumerate(ODD)]
    target = [TEXTS[7], None, "", "The River is in MAÑANA", "x#y river"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("key", F.lit("x")).repartition(3)
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = resampling.resample(docs, aim, max_n=max_n, percent=percent).collect()
    want = plain_resample(rows, target, max_n, 20, percent)
    assert nulls([tuple(r)[:4] for r in got]) == nulls([w[:4] for w in want])
    # equal rows may swap their ranks
    assert sorted((r["rank"], r["score"], r["key"] or -1) for r in got if r["rank"]) == sorted((w[4], w[3], w[0] or -1) for w in want if w[4])


def test_op12_matches_sql(spark, sf_dir):
    ok, message = compare(spark, connect(sf_dir), "op12_resampling", sf_dir)
    assert ok, message


def plain_alignment(rows, library, pieces):
    """Token byte ranges of both sides, all overlapping pairs by comparison."""
    vocab = {i: s for s, i in library.get_vocab().items()}
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    byte_of = {(chr(b) if b in printable else chr(next(spare))): b for b in range(256)}
    a_bytes = lambda i: bytes(byte_of[c] for c in vocab[i])
    b_bytes = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    out, counts = [], Counter()
    for key, text in rows:
        raw = (" " + text).encode() if text else b""
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            a, b = [], []
        ranges = lambda ids, of: [(e - len(of(i)), e, i) for i, e in zip(ids, np.cumsum([len(of(i)) for i in ids]).tolist())]
        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        ends = sorted({e for _, e, _ in ra} & {e for _, e, _ in rb})
        groups = ";".join(f"{','.join(str(i) for s, e, i in ra if lo < e <= hi)}|{','.join(str(i) for s, e, i in rb if lo < e <= hi)}"
                          for lo, hi in zip([0, *ends], ends))
        links, j0 = [], 0
        for s, e, i in ra:
            while j0 < len(rb) and rb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(rb) and rb[j][0] < e:
                links.append((i, rb[j][2]))
                j += 1
        counts.update(links)
        out.append((key, len(a), len(b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest() if a else "", groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return counts, [(k, na, nb, ng, len(l), d, sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l)) for k, na, nb, ng, l, d, _ in out]


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 500])
def test_alignment_against_all_pairs(spark, sf_dir, library, block_bytes, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 50)
    short = [r for r in sf_documents(spark, sf_dir).select("doc_id", "text").collect() if len(r["text"] or "") < 4000]
    rows = [(a[0], a[1]) for a in AWKWARD if len(a[1] or "") < 4000] + [(1000 + i, t) for i, t in enumerate(ODD)] + [tuple(r) for r in short]
    library.encode_special_tokens = True
    counts, want = plain_alignment(rows, library, SentencePieceProcessor(model_file=PIECES))
    library.encode_special_tokens = False
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x")).withColumn("n_a", F.lit(5)).repartition(3)
    found = alignment.align_corpus(docs, PATH, PIECES, block_bytes=block_bytes)
    assert {(r["a"], r["b"]): r["links"] for r in found.pairs.collect()} == counts
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert nulls([tuple(r) for r in found.documents.select(*names).collect()]) == nulls(want)
    assert sum(w[1] > 0 for w in want) > len(short)


def test_op13_returns_every_document(spark, sf_dir):
    rows = alignment.op13_alignment(spark, sf_dir)
    assert dict(rows.dtypes) == {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
                                 "groups_sha256": "string", "n_best": "bigint", "count_sum": "bigint"}
    assert [r[0] for r in rows.select("doc_id").orderBy("doc_id").collect()] == [
        r[0] for r in sf_documents(spark, sf_dir).select("doc_id").orderBy("doc_id").collect()]
