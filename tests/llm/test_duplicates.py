"""SimHash, embeddings, repeated byte strings, components, and the pipeline: against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

import corpus_pipeline
from sparkgrad.llm import embedding_pairs, simhash, suffix_dedup
from sparkgrad.llm.components import components
from tests.llm.rows import AWKWARD, SCHEMA, TEXTS, frame, sf_documents


def classes(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 300), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}


# ---- simhash ----

def plain_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ").replace(
        "\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_fingerprint_matches_spark_hash(spark):
    text = "one two three"
    assert simhash.fingerprint(text) == spark.sql(f"SELECT xxhash64('{text}')").first()[0]


@pytest.mark.parametrize("radius, segments", [(2, 2), (3, 2), (1, 2), (4, 4), (2, 4)])
def test_links_match_all_pairs(spark, radius, segments):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(60)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for p in prints for _ in range(4)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), radius, segments)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= radius}
    assert want and {tuple(r) for r in got.collect()} == want


def test_op2_matches_brute_force(spark, sf_dir):
    docs = sf_documents(spark, sf_dir).collect()
    ids = sorted(r["doc_id"] for r in docs)
    texts = {r["doc_id"]: r["text"] for r in docs}
    fp = [plain_fingerprint(texts[i]) for i in ids]
    root = classes(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 2])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op2_simhash(spark, sf_dir).collect()}
    assert got == {i: (f"{f:016x}", ids[r]) for i, f, r in zip(ids, fp, root)}


def test_simhash_awkward_rows(spark):
    rows = simhash.near_duplicates(frame(spark)).collect()
    assert len(rows) == len(AWKWARD)
    blank = {r["component_id"] for r in rows if r["fp"] == 0}
    assert blank == {0}  # NULL, empty and blank texts are one group
    kept = simhash.one_of_each(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 100 not in ids


def test_one_row_per_group_and_not_per_key(spark):
    rows = [(1, prose_of(1)), (2, prose_of(1)), (7, prose_of(2)), (7, prose_of(3)), (7, prose_of(3)), (9, prose_of(4)), (9, prose_of(1)),
            (None, prose_of(5)), (None, prose_of(6)), (None, prose_of(1)), (None, None), (3, "")]
    want = [(1, prose_of(1)), (3, ""), (7, prose_of(2)), (7, prose_of(3)), (9, prose_of(4)), (None, prose_of(5)), (None, prose_of(6))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, root int").repartition(3)
    for kept in (simhash.one_of_each(docs), corpus_pipeline.near_dedup(spark, docs, "")):
        assert kept.columns == docs.columns
        assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, want))


def check_stage(spark, texts):
    """The stage keeps the smallest id of each group of fingerprints linked at two bits, found here pair by pair."""
    prints = [plain_fingerprint(t) for t in texts]
    root = classes(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(kept) == [(i, texts[i]) for i in sorted(set(root))]
    return root


def test_near_dedup_stage_matches_brute_force(spark):
    rng, texts = random.Random(11), []
    for seed, n in ((1, 30), (2, 120), (3, 400), (4, 1500)):
        words = prose_of(seed, n).split()
        for _ in range(25):  # a few words differ: distances on both sides of the radius
            copy = list(words)
            for k in rng.sample(range(n), rng.randrange(1, 4)):
                copy[k] = copy[k].upper() if rng.random() < 0.2 else "z" + copy[k]
            texts.append(" ".join(copy))
    texts += [None, "", " \n", "one", "One", "one two", "a b c d e", "a b c d", texts[0] + "  ", *TEXTS]
    root = check_stage(spark, texts)
    assert 20 < len(set(root)) < len(texts) - 20


def test_near_dedup_stage_of_the_documents(spark, sf_dir):
    check_stage(spark, [r["text"] for r in sf_documents(spark, sf_dir).orderBy("doc_id").collect()])


def prose_of(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


# ---- embeddings ----

def brute_pairs(vectors, threshold):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    for a in range(len(vectors)):
        for b in range(a):
            if ok[a] and ok[b] and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a], float), np.array(vectors[b], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    yield a, b


def test_embeddings_match_brute_force(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding_pairs, "BLOCK", 40)
    monkeypatch.setattr(embedding_pairs, "STEP", 3)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(25, 8))
    vectors = [[float(np.float32(x)) for x in base[k % 25] + rng.normal(size=8) * rng.choice([0, 0.2, 0.4])] for k in range(180)]
    vectors += [None, [], [0.0] * 8, [1.0, None, *[0.0] * 6], [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0], [2.0, 4.1], [1e-30] * 8, [1e30] * 8]
    rows = spark.createDataFrame([(i, v, 0, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, rep int, v int")
    vectors = [r["embedding"] for r in rows.orderBy("vec_id").collect()]
    pairs = list(brute_pairs(vectors, 0.9))
    links = np.bincount([x for p in pairs for x in p], minlength=len(vectors))
    root = classes(len(vectors), pairs)
    got = {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_pairs.near_duplicates(rows).collect()}
    assert pairs and got == {i: (links[i], root[i], root[i] == i) for i in range(len(vectors))}
    rows.write.parquet(f"{tmp_path}/embeddings")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    assert {r[0]: r[1:] for r in database.execute(embedding_pairs.OP3_SQL).fetchall()} == got


def test_embeddings_without_ids(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding_pairs, "BLOCK", 20)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 5))
    rows = [(None if k % 3 == 0 else k % 50, [float(np.float32(x)) for x in base[k % 30] + rng.normal(size=5) * rng.choice([0, 0.1])]) for k in range(120)]
    rows += [(None, [9.0, 0.0, 0.0, 0.0, 0.5]), (None, [-1.0, 5.0, 0.0, 0.0, 0.0]), (None, [-1.0, 5.0, 0.0, 0.0, 0.0]), (None, None), (7, None), (None, [0.0] * 5),
             (500, [0.0, 0.0, -3.0, 9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("num", F.lit("x")).withColumn("first", F.lit(1))
    got = sorted((tuple(r) for r in embedding_pairs.near_duplicates(frame).collect()), key=str)
    frame.write.parquet(f"{tmp_path}/embeddings")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    assert got == sorted(database.execute(embedding_pairs.OP3_SQL).fetchall(), key=str)
    assert any(r[0] is None and r[1] and r[2] is not None and not r[3] for r in got) and (None, 1, None, True) in got


def test_far_cells_never_meet():
    rng = np.random.default_rng(6)
    centres = embedding_pairs.unit_rows(rng.normal(size=(40, 16)))
    x = embedding_pairs.unit_rows(np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 16)) * 0.02)
    c = embedding_pairs.centres(x[::3], 32)
    to = embedding_pairs.angles(x, c)
    cell, radius = to.argmin(axis=1), np.array([to[to.argmin(axis=1) == k, k].max(initial=-np.inf) for k in range(len(c))])
    may = embedding_pairs.may_meet(x, c, radius, 0.9)
    near = np.argwhere(x @ x.T >= 0.9)
    assert may[near[:, 0], cell[near[:, 1]]].all() and may.mean() < 0.3


def test_embeddings_empty_table(spark):
    assert embedding_pairs.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- repeated byte strings ----

def brute_cut(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted({(suffix_dedup.LAST if i is None else i, t or "") for i, t in rows}):
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(data[p:p + length])
        runs = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[i, text] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check_cut(spark, rows):
    docs = spark.createDataFrame([(i, t, t, 1) for i, t in rows], "doc_id long, text string, data string, spans int")
    got = suffix_dedup.dedup(docs).selectExpr("row.doc_id", "coalesce(row.data, '')", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)").collect()
    want = brute_cut(rows)
    assert len(got) == len(rows) and sum(r[3] for r in got)
    for r in got:
        assert tuple(r)[2:] == want[suffix_dedup.LAST if r[0] is None else r[0], r[1]]


def puzzles():
    rng = random.Random(5)
    passages = ["".join(rng.choice("abé") for _ in range(rng.choice([60, 99, 100, 101, 150, 400]))) for _ in range(10)]
    rows = [(i, "".join(rng.choice([rng.choice(passages), rng.choice(passages)[rng.randrange(50):],
                                    "".join(rng.choice("xyz é") for _ in range(rng.randrange(80)))]) for _ in range(rng.randrange(5)))) for i in range(100)]
    return rows + [(1000, "ab" * 300), (1001, "ab" * 300), (1002, "a" * 1000), (1003, None), (None, passages[3] + passages[4]),
                   (1004, rows[5][1]), (1004, rows[5][1]), (1004, rows[6][1]), (1005, "ü" * 120), (1006, "b" * 99), (1007, "")]


def test_cut_matches_brute_force(spark):
    check_cut(spark, puzzles())


def test_cut_in_pieces_and_with_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    check_cut(spark, puzzles()[:40] + puzzles()[-12:])


def test_a_phrase_in_every_row_is_dealt_by_its_surroundings(spark, monkeypatch):
    rng = random.Random(11)
    phrase = "".join(rng.choice("abcdefgh ") for _ in range(95))
    other = lambda: "".join(rng.choice("klmnop qrst") for _ in range(120))
    rows = [(i, other() + phrase + other()) for i in range(400)]
    rows += [(1000 + i, rows[i][1][30:] + other()) for i in range(40)]
    texts = suffix_dedup.numbered(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").select("id", "tie", "data")
    total = sum(len(t) for _, t in rows)

    def largest(hot):
        sizes = suffix_dedup.bucketed(texts, 100, 32, 40, hot).where("block IS NOT NULL").groupBy("bucket").agg(F.sum(F.octet_length("block")).alias("n"))
        return max(r["n"] for r in sizes.collect()) / suffix_dedup.ENTRY.itemsize

    none = np.zeros(0, np.uint64)
    assert len(suffix_dedup.hot_grams(texts, 100, 32, total)) == 0 and largest(none) > 400
    monkeypatch.setattr(suffix_dedup, "HOT", 50)
    hot = suffix_dedup.hot_grams(texts, 100, 32, total)
    assert 0 < len(hot) < 40 and largest(hot) < 200
    check_cut(spark, rows)
    monkeypatch.setattr(suffix_dedup, "HOT_GRAMS", 1)
    assert len(suffix_dedup.hot_grams(texts, 100, 32, total)) == 1
    check_cut(spark, rows)


def test_anchors_of_pieces_are_those_of_the_whole(monkeypatch):
    data = "".join(t or "" for t in TEXTS).encode()
    whole = suffix_dedup.anchors(data, 100, 32)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    for a, b in zip(suffix_dedup.anchors(data, 100, 32), whole):
        assert np.array_equal(a, b)
    assert np.diff(whole[0]).max() <= 69  # every window of 100 bytes holds an anchor


@pytest.mark.parametrize("period", [4, 16, 32, 64, 100])
def test_difference_cover(period):
    cover = suffix_dedup.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_op9_matches_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in sf_documents(spark, sf_dir).collect()]
    want, texts = brute_cut(rows), dict(rows)
    for r in suffix_dedup.op9_suffix_dedup(spark, sf_dir).collect():
        assert tuple(r)[1:] == want[r["doc_id"], texts[r["doc_id"]] or ""]


def test_cut_texts_keep_whole_characters(spark):
    passage = "é" * 60
    docs = spark.createDataFrame([(1, "x" + passage, 61, None), (2, passage + "è", 61, "k"), (3, passage, 60, "k")],
                                 "doc_id long, text string, n_chars long, row string")
    got = {r["doc_id"]: r for r in suffix_dedup.dedup_text(docs).collect()}
    assert set(got) == {1, 2} and got[2]["text"] == "è" and got[2]["n_chars"] == 1 and got[2]["row"] == "k"


def test_cut_awkward_rows_and_empty_table(spark):
    rows = [(r[0], r[1]) for r in AWKWARD]
    assert suffix_dedup.dedup(frame(spark)).count() == len(rows)
    assert suffix_dedup.dedup_text(frame(spark)).columns == frame(spark).columns
    assert suffix_dedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


# ---- pipeline ----

def test_pipeline_stages(spark, sf_dir):
    docs = sf_documents(spark, sf_dir)
    columns = docs.columns
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "near_dedup":
            prints = [plain_fingerprint(t) for _, t in rows]
            assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
        if name == "passage_dedup":
            want = brute_cut(list(before.items()))
            assert all(want[i, before[i]][1] == 0 or len(t.encode()) >= want[i, before[i]][0] - want[i, before[i]][1] for i, t in rows)
        if name != "mix_sources":
            assert len({i for i, _ in rows}) == len(rows)
        before = dict(rows)
    assert rows and set(before) <= set(given)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == len(rows)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_pipeline_of_awkward_and_no_rows(spark, sf_dir):
    for docs in (frame(spark), spark.createDataFrame([], SCHEMA)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "test-stage")
        docs.count()
