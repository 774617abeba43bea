"""Language identification and the line CRF: held-out accuracy, numeric checks, defined results."""

import itertools
import math
import time
import tracemalloc

import numpy as np
import pytest

from sparkgrad.llm import langid, line_crf
from tests.llm.rows import AWKWARD, SCHEMA, frame


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = langid.op10_language_id(spark, folder).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_no_letter_is_und_and_nothing_learnt_is_und(spark):
    model = langid.train(["the cat and dog"] * 5 + ["der hund und katze"] * 5, ["en"] * 5 + ["de"] * 5)
    assert [model.predict(t)[0] for t in (None, "", "123 .,!", "the dog and", "der hund")] == ["und", "und", "und", "en", "de"]
    assert langid.predict(frame(spark), model).count() == len(AWKWARD)
    assert langid.train([], []).predict("text") == ("und", 0.0, True)
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.sample(empty, empty["doc_id"].isNotNull(), "text", "lang") == ([], [])
    assert langid.predict(empty, model).count() == 0


def test_long_text_scores_as_in_one_piece(monkeypatch):
    model = langid.train(["the cat and dog"] * 5 + ["der hund und katze"] * 5, ["en"] * 5 + ["de"] * 5)
    text = "the dog und katze, a river " * 40
    whole = model.logits(text)
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert np.allclose(model.logits(text), whole)


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    unary, table = rng.normal(size=6), rng.normal(size=(2, 2))
    weight, good = 0.0, np.zeros(6)
    for path in itertools.product((0, 1), repeat=6):
        w = math.exp(sum(u for u, y in zip(unary, path) if y) + sum(table[a, b] for a, b in zip(path, path[1:])))
        weight += w
        good += w * np.array(path)
    assert np.allclose(line_crf.marginals(unary, table), good / weight)


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    unary, table, y = rng.normal(size=(3, 4)), rng.normal(size=(2, 2)), np.array([1, 0, 1])
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)
    _, by_unary, by_table = line_crf.chain_gradient(unary, mask, y, table)
    value = lambda u, t: line_crf.chain_gradient(u, mask, y, t)[0]
    step = 1e-6
    for at in np.ndindex(unary.shape):
        d = np.zeros_like(unary)
        d[at] = step
        assert by_unary[at] == pytest.approx((value(unary + d, table) - value(unary - d, table)) / (2 * step), abs=1e-5)
    for at in np.ndindex(2, 2):
        d = np.zeros((2, 2))
        d[at] = step
        assert by_table[at] == pytest.approx((value(unary, table + d) - value(unary, table - d)) / (2 * step), abs=1e-5)


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = line_crf.op4_line_crf(spark, folder).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(p for p, y in held if y)


def test_crf_defined_results(spark):
    model = line_crf.train(["the cat is in the house.\nand a dog."] * 3 + ["x# x# x# x#"] * 3, [1] * 3 + [0] * 3)
    rows = line_crf.score(frame(spark), model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert model.score(None) == model.score(" \n ") == model.share
    assert line_crf.score(spark.createDataFrame([], SCHEMA), model).count() == 0
    nothing = line_crf.learn(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int"))
    assert nothing.score("some text") == 0.5


def test_sample_has_one_row_per_key(spark):
    docs = spark.createDataFrame([(1, "hot document"), (1, "other text")] * 50 + [(2, "cold")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 20 + [(2, 0), (3, None)], "doc_id long, quality int")
    texts, y, share = line_crf.sample(docs, labels, "doc_id", "text", "quality")
    assert list(zip(texts, y)) == [("cold", 0), ("hot document", 1)] and share == 20 / 21


def test_packed_chains_learn_like_padded_ones():
    rng = np.random.default_rng(8)
    lengths = np.array([1, 2, 3, 4, 9, 30, 1, 5])
    assert sorted(np.concatenate(line_crf.packs(lengths)).tolist()) == list(range(8))
    assert all(lengths[p].max() < 2 * lengths[p].min() for p in line_crf.packs(lengths))
    table, y = rng.normal(size=(2, 2)), np.array([1, 0] * 4)
    unary = rng.normal(size=(8, 30))
    mask = np.arange(30) < lengths[:, None]
    value, _, by_table = line_crf.chain_gradient(unary * mask, mask, y, table)
    parts = [line_crf.chain_gradient((unary * mask)[p, :lengths[p].max()], mask[p, :lengths[p].max()], y[p], table) for p in line_crf.packs(lengths)]
    assert value == pytest.approx(sum(p[0] for p in parts)) and np.allclose(by_table, sum(p[2] for p in parts))


def test_a_labelled_text_of_many_short_lines_stays_small():
    texts = ["the cat is in the house.\nand a dog."] * 1500 + ["x# x# x# x#"] * 1500 + ["\n".join("abc"[k % 3] for k in range(3000))]
    tracemalloc.start()
    began = time.process_time()
    model = line_crf.train(texts, [1] * 1500 + [0] * 1501)
    assert tracemalloc.get_traced_memory()[1] < 200e6 and time.process_time() - began < 120
    tracemalloc.stop()
    assert model.score(texts[0]) > 0.5 > model.score(texts[1600])


def plain_score(model, text):
    """Features, forward-backward in logarithms and weighting, written down once more."""
    lines = [part for line in (text or "").split("\n") for part in (line[k:k + line_crf.LINE_CHARS] for k in range(0, len(line), line_crf.LINE_CHARS)) if part.strip()]
    if not lines:
        return model.share
    own = [line_crf.line_features(line, line in lines[:i]) for i, line in enumerate(lines)]
    none = [0.0] * line_crf.N_OWN
    score = [sum(w * v for w, v in zip(model.weights, own[i] + (own[i - 1] if i else none) + (own[i + 1] if i + 1 < len(own) else none))) for i in range(len(own))]
    n, t = len(own), model.table
    forward, backward = [[0.0, score[0]]], [[0.0, 0.0]]
    for i in range(1, n):
        forward.append([np.logaddexp(forward[-1][0] + t[0, b], forward[-1][1] + t[1, b]) + b * score[i] for b in (0, 1)])
    for i in range(n - 1, 0, -1):
        backward.insert(0, [np.logaddexp(t[a, 0] + backward[0][0], t[a, 1] + score[i] + backward[0][1]) for a in (0, 1)])
    good = [1 / (1 + math.exp(forward[i][0] + backward[i][0] - forward[i][1] - backward[i][1])) for i in range(n)]
    return sum(g * len(line) for g, line in zip(good, lines)) / sum(map(len, lines))


def test_scores_match_a_plain_version(spark):
    model = line_crf.train(["the cat is in the house.\nand a dog."] * 3 + ["x# x# x# x#"] * 3, [1] * 3 + [0] * 3)
    for r in line_crf.score(frame(spark), model, keep=("text",)).collect():
        assert r["score"] == pytest.approx(plain_score(model, r["text"]), abs=1e-9)


def plain_language(model, text):
    """Letters of words with an edge mark on both sides, runs of 2 to 4 characters hashed one by one."""
    def code(c):
        return ord(c) if c.isalpha() else 0

    codes = [0, *[code(c) for c in (text or "").lower()], 0]
    found = []
    for n in (2, 3, 4):
        for i in range(len(codes) - n + 1):
            run = codes[i:i + n]
            if not any(run) or n > 2 and 0 in run[1:-1]:
                continue
            h = run[0]
            for c in run[1:]:
                h = (h * 2654435761 + c) % 2**32
            mixed = ((h ^ h >> 15) * 2246822519 + n * 40503) % 2**32
            found.append(mixed >> 32 - langid.BITS)
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    z = sum(model.table[h].astype(float) for h in found) / len(found) + model.bias
    p = np.exp(z / model.temperature - (z / model.temperature).max())
    return model.languages[int(p.argmax())], float(p.max() / p.sum())


def test_languages_match_a_plain_version(spark):
    model = langid.train(["the cat and dog"] * 5 + ["der hund und katze"] * 5, ["en"] * 5 + ["de"] * 5)
    for r in langid.predict(frame(spark), model, keep=("text",)).collect():
        if len(r["text"] or "") < 30_000:
            name, score = plain_language(model, r["text"])
            assert r["lang_pred"] == name and r["score"] == pytest.approx(score, abs=1e-5), r["text"][:50]


def test_null_keys_are_scored_and_not_held_out(spark, tmp_path):
    docs = spark.createDataFrame([(None, "the house is on the hill", "en", "a", 5), (3, "der Hund ist da", "de", "a", 5)] * 3,
                                 "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (line_crf.op4_line_crf, langid.op10_language_id):
        rows = query(spark, str(tmp_path)).collect()
        assert len(rows) == 6 and {r["held_out"] for r in rows if r["doc_id"] is None} == {None}
