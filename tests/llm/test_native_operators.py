"""Sharding, quality rules, mixing: against plain Python on small awkward tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

from sparkgrad.llm import mixing, quality_rules, sharding
from tests.llm.rows import AWKWARD, SCHEMA, frame, sf_documents
from tools.check_queries import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


# ---- sharding ----

def test_slots_have_no_gaps_and_equal_keys_share_a_shard(spark):
    rows = sharding.shard(frame(spark), [1.0] * 7).collect()
    assert len(rows) == len(AWKWARD)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        shards[r["doc_id"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_sizes_and_checksums(spark):
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.shard(frame(spark), [1.0] * 3).collect())
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in AWKWARD)
    assert got == want


def test_a_new_shard_takes_rows_only_into_itself(spark, sf_dir):
    docs = sf_documents(spark, sf_dir)
    before = {r["doc_id"]: r for r in sharding.shard(docs, [1.0] * 40).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, [1.0] * 41).collect()}
    moved = {d for d in after if after[d] != before[d]["shard"]}
    assert moved and all(after[d] == 40 for d in moved)
    assert all(before[d]["grown_shard"] == after[d] for d in after)


def test_weights_shift_the_shares(spark):
    rows = sharding.shard(spark.range(6000).selectExpr("id AS doc_id", "'' AS text"), [3.0, 1.0, 2.0]).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 6000 for r in rows}
    assert share[0] == pytest.approx(0.5, abs=0.03) and share[1] == pytest.approx(1 / 6, abs=0.03)
    with pytest.raises(ValueError):
        sharding.shard(frame(spark), [1.0, 0.0])


def spark_hash(*parts):
    """XXH64 over the parts, each with the hash before it as seed; NULLs are skipped. Parts: text, or (number, bytes)."""
    h = 42
    for part in parts:
        if part is None or isinstance(part, tuple) and part[0] is None:
            continue
        h = xxhash.xxh64_intdigest(part.encode() if isinstance(part, str) else int(part[0]).to_bytes(part[1], "little", signed=True), h)
    return h


def plain_unit(*parts):
    return ((spark_hash(*parts) >> 12) + 0.5) / (1 << 52)


@pytest.mark.parametrize("weights", [[1.0] * 7, [3.0, 1.0, 0.5, 2.0]])
def test_the_winner_is_the_highest_score(spark, weights):
    for r in sharding.shard(frame(spark), weights, 2.5).collect():
        scores = [-math.log(plain_unit("shard", (r["doc_id"], 8), (s, 4))) / w for s, w in enumerate([*weights, 2.5])]
        assert r["shard"] == scores[:-1].index(min(scores[:-1])) and r["grown_shard"] == scores.index(min(scores))


def test_slots_of_a_hot_identical_row(spark):
    rows = sharding.shard(spark.createDataFrame([(7, "same")] * 500 + [(k, "x") for k in range(50)], "doc_id long, text string"), [1.0] * 3).collect()
    assert len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1
    for shard in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


# ---- quality rules ----

def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_match_plain_python(spark):
    docs = quality_rules.judge(frame(spark)).collect()
    assert len(docs) == len(AWKWARD)
    for r in docs:
        c = r["_judged"]["counts"]
        want = plain_counts(r["text"])
        assert (c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"]) == want
        assert r["_judged"]["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_rules_keep_the_columns_and_clean_text(spark):
    clean = "the cat and the dog of the house is in the garden that was on the hill by a river for years with no end"
    docs = spark.createDataFrame([(1, clean, "x"), (2, clean.replace(" ", "### "), "x"), (3, "a b", "x"), (4, None, "x")],
                                 "doc_id long, text string, _judged string")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1]


def test_stop_words_of_other_scripts_and_cases(spark):
    english = "The cat And the dog OF The house is In the garden that was on the hill by a river for years with no end".split()
    russian = "кошка и собака живут в доме у реки который стоит на высоком холме уже много лет и никто не знает почему так вышло здесь".split()
    none = "xqz vbn wrt plk mnb sdf xcv qwrt zxq vbnm wrtz plkj mnbv sdfg xcvb qwrtz zxqv vbnw wrtp plkm mnbs".split()
    rows = [(1, " ".join(w.title() if k % 2 else w for k, w in enumerate(english))), (2, " ".join(russian)), (3, " ".join(none)), (4, " ".join(english).upper())]
    kept = quality_rules.keep_good(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    counts = {r["doc_id"]: r["_judged"]["counts"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert counts[1]["n_stop_words"] == counts[4]["n_stop_words"] >= 14 and counts[2]["n_latin_words"] == 0


def test_op7_sql_on_awkward_rows(spark, tmp_path):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate([*(a[1] for a in AWKWARD), "ΑΒΓ абв ABC İN Kelvin DAS MÁS für FÜR " * 6, "12 34 " * 20, "日本語 テキスト " * 12])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    ok, message = compare(spark, database, "op7_quality_rules", str(tmp_path))
    assert ok, message


def test_op7_against_sql(spark, sf_dir):
    ok, message = compare(spark, connect(sf_dir), "op7_quality_rules", sf_dir)
    assert ok, message


def test_no_shuffle_and_no_python(spark, sf_dir, capsys):
    quality_rules.op7_quality_rules(spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# ---- mixing ----

def plain_targets(sizes, weights=(5, 2, 1), times=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > times * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = times * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, docs):
    sizes, taken, target, largest = Counter(), Counter(), {}, Counter()
    for d, t, s in docs:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    for r in rows:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"] * r["n"]
        target[r["source"]] = r["target"]
        assert r["source_size"] == sizes[r["source"]]
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        repeats = max((r["n"] * r["size"] for r in rows if r["source"] == s), default=0)
        assert abs(taken[s] - want[s]) <= max(largest[s], repeats) / 2 + 1e-6


def test_mix_meets_its_targets_and_reruns_agree(spark, sf_dir):
    docs = sf_documents(spark, sf_dir)
    rows = mixing.mix(docs).collect()
    check_mix(rows, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(docs.repartition(5)).collect()))


def test_mix_of_several_levels_with_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    monkeypatch.setattr(mixing, "STRIDE", 3)
    docs = [(i, "w " * (i % 50 + 1), "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    check_mix(mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect(), docs)


def test_mix_of_awkward_rows(spark):
    rows = mixing.mix(frame(spark)).collect()
    assert sum(r["n"] for r in rows) == len(AWKWARD)
    check_mix(rows, [(d, t, s) for d, t, _, s, *_ in AWKWARD])
    out = mixing.mixed(frame(spark))
    assert out.columns == frame(spark).columns
    copies = sum(r["copies"] * r["n"] for r in rows)
    assert out.count() == copies


def test_different_texts_without_a_key_are_different_units(spark):
    docs = [(None, "w " * (10 + k % 7) + str(k), "a") for k in range(300)] + [(k, "w " * 20, "b") for k in range(100)]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    assert max(r["n"] for r in rows) == 1 and len(rows) == 400
    check_mix(rows, docs)


def plain_mix(docs, weights=(5, 2, 1), times=3, seed=8):
    """The meetings one by one, as the tree deals them."""
    units = Counter((s, d, size(t), spark_hash(t) if t is not None else 42) for d, t, s in docs)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    target = plain_targets(Counter({s: sum(n * k[2] for k, n in units.items() if k[0] == s) for s in {k[0] for k in units}}))
    copies = {}
    for source in {k[0] for k in units}:
        own = [(k[2], k[1], signed(k[3]), n) for k, n in units.items() if k[0] == source]
        total = sum(u[0] * u[3] for u in own)
        ratio = target[source] / total if total else 0.0
        base, part = math.floor(ratio), ratio - math.floor(ratio)
        level = defaultdict(list)
        blocks = -(-len(own) // mixing.BLOCK)
        for u in own:
            if part == 0 or u[0] == 0:
                copies[source, *u[:3]] = base
            else:
                h = signed(spark_hash((seed, 4), (u[1], 8), (u[0], 8), (u[2], 8)))
                level[h % blocks].append([*u, part])
        most = max(-(-sum(1 for k in units if k[0] == s) // mixing.BLOCK) for s in {k[0] for k in units})
        order = lambda u: (u[0], u[1] is not None, u[1] or 0, u[2], u[3], u[4])
        mass = lambda u: float(u[0] * u[3])

        def meet(r, x):
            room_r, room_x, has_r, has_x = (1 - r[4]) * mass(r), (1 - x[4]) * mass(x), r[4] * mass(r), x[4] * mass(x)
            up, down = min(room_r, has_x), min(has_r, room_x)
            rises = plain_unit((seed, 4), (r[0 + 1], 8), (r[0], 8), (r[2], 8), (x[1], 8), (x[0], 8), (x[2], 8)) * (up + down) < down
            words = up if rises else -down
            clip = lambda p: max(0.0, min(1.0, p))
            if (room_r <= has_x) if rises else (has_r <= room_x):
                return [*x[:4], clip(x[4] - words / mass(x))], [*r[:4], float(rises)]
            return [*r[:4], clip(r[4] + words / mass(r))], [*x[:4], 1 - float(rises)]

        while most:
            last, following = most == 1, defaultdict(list)
            for block, found in level.items():
                found = sorted(found, key=order, reverse=True)
                waits = [] if last else [u for i, u in enumerate(found) if (i + 1) % mixing.STRIDE == 0 or i == len(found) - 1]
                rest, done = None, []
                for u in found:
                    if any(u is w for w in waits):
                        continue
                    if rest is None:
                        rest = u
                    else:
                        rest, out = meet(rest, u)
                        done.append(out)
                if last:
                    side = float(math.floor(rest[4] + 0.5))
                    gap, closed = (rest[4] - side) * mass(rest), [[*rest[:4], side]]
                    for u in sorted(done, key=order, reverse=True):
                        wants = gap >= mass(u) if u[4] == 0 else -gap >= mass(u)
                        if wants:
                            gap += -mass(u) if u[4] == 0 else mass(u)
                        closed.append([*u[:4], 1 - u[4] if wants else u[4]])
                    done = closed
                else:
                    following[block // mixing.STRIDE] += ([rest] if rest else []) + waits
                for u in done:
                    copies[source, *u[:3]] = base + int(u[4])
            level, most = following, 0 if last else -(-most // mixing.STRIDE)
    return copies


def test_meetings_match_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 6)
    monkeypatch.setattr(mixing, "STRIDE", 3)
    docs = [(None if i % 11 == 0 else i // 2, "w " * (i * 7 % 40 + 1) + "x" * (i % 2), ["hot", "hot", "a", "b", None][i % 5]) for i in range(300)]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)).collect()
    assert {(r["source"], r["size"], r["id"], r["h"]): r["copies"] for r in rows} == plain_mix(docs)


@pytest.mark.parametrize("operator", [
    lambda d: sharding.shard(d, [1.0]), quality_rules.keep_good, mixing.mix, mixing.mixed])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
