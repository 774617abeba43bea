"""BPE against the tokenizers library; HTML extraction on small pages."""

import hashlib
import json
import random
import re
import unicodedata
from html import unescape

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparkgrad.llm import bpe, html_text
from tests.llm.rows import AWKWARD, SCHEMA, TEXTS, frame, sf_documents

PATH = bpe.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_encode_and_decode_match_the_library(spark, sf_dir, library):
    rows = bpe.encode(sf_documents(spark, sf_dir).select("doc_id", "text").unionByName(frame(spark).select("doc_id", "text")),
                      PATH, keep=("doc_id", "text")).collect()
    assert len(rows) == 200 + len(AWKWARD)
    for r in rows:
        assert (np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) == expected(library, r["text"])


def test_digests(spark, library):
    for r in bpe.digests(frame(spark), PATH, keep=("doc_id", "text")).collect():
        ids, text = expected(library, r["text"])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_cache_generations_do_not_change_results(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    codec = bpe.load(PATH)
    for text in TEXTS[:9] + TEXTS[10:]:
        ids, decoded = codec.encode(text)
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(library, text)


def test_random_characters_match_the_library(library):
    rng, codec = random.Random(3), bpe.load(PATH)
    known = [c for c in map(chr, [*range(0x600), *range(0x1E00, 0x2200), *range(0x1F600, 0x1F650)]) if unicodedata.category(c) != "Cn"]
    parts = ["'s", "'RE", " ", "\n", "don't", "ABC", "1234", "\x00", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|"]
    texts = ["\x001 a1 1 \x00a a!a"] + ["".join(rng.choice(known if rng.random() < 0.6 else parts) for _ in range(40)) for _ in range(3000)]
    for text in texts:
        ids, decoded = codec.encode(text)
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(library, text), ascii(text)


def test_words_are_merged_once_for_all_tasks_of_a_worker(spark, monkeypatch):
    merged, given, merge = [], [], bpe.Codec.merge
    monkeypatch.setattr(bpe, "map_texts", lambda *args: given.append(args))
    monkeypatch.setattr(bpe.Codec, "merge", lambda self, piece: merged.append(piece) or merge(self, piece))
    bpe.digests(frame(spark), PATH)
    make, *done = given[0][4:]
    results = []
    for _ in range(2):  # two tasks
        results.append(make()(["River, river bank", None, "bank, bank river!"]))
        for end in done:
            end()
    assert results[0] == results[1]
    assert sorted(merged) == [b"!", b",", b"bank", b"river"]


def test_pieces_beside_the_limit_of_short_queue_entries_match_the_library(library):
    rng, codec = random.Random(4), bpe.load(PATH)
    for n in (1, 2, 3, (1 << bpe.SHORT) - 1, 1 << bpe.SHORT, (1 << bpe.SHORT) + 1, 50_000):
        for text in ("".join(rng.choices("etaoinshr", k=n)), "".join(rng.choices("!?.-=", k=n)), "ab" * (n // 2) + "é,"):
            ids, decoded = codec.encode(text)
            assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(library, text)


def test_the_pattern_of_the_file_decides_about_marks():
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"] = r"[\p{L}.]+|[^\s\p{L}]"
    other, codec = Tokenizer.from_str(json.dumps(spec)), bpe.Codec(spec)
    for text in ["river.", "river.bank, and!! the... end", "a.b.c"]:
        ids, decoded = codec.encode(text)
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(other, text)


def test_empty_tables(spark):
    assert bpe.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_of_the_test_pages(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in html_text.op5_html_blocks(spark, sf_dir).collect():
        page = pages[r["page_id"]]
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"])


LONG = "The quick fox and the dog are in the house of the king, and it was for that reason that the town by the sea is quiet."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple &#233;", "plain & simple é"),
    (f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>", f"{LONG}\nShort.\n{LONG}"),
    (f"<nav><a href=x>Home</a></nav><div class='side-bar sidebar'>{LONG}</div><p>{LONG}</p>", LONG),
    (f"<article><p>A<br>b &lt;c&gt;</p><aside>{LONG}</aside><div id=comments><p>{LONG}</div><p>end</article><p>{LONG}</p>", "A b <c>\nend"),
    (f"<article><ul><li>one<li>two</ul><p>open <b>bold<p>next <a href='>'>link</a> tail of a sentence", "one\ntwo\nopen bold\nnext link tail of a sentence"),
    (f"<p>{LONG}</p><p><a href=a>one</a> <a href=b>two</a></p><form><p>{LONG}</form><script>'</p>' < 3</script>", LONG),
    (f"<div hidden>{LONG}</div><div style='display: none'>{LONG}</div><div role=banner>{LONG}</div><p>{LONG}", LONG),
    ("<article>a < b and c > d<!-- x <p> --> e</article>", "a < b and c > d e"),
    ("<p>cut off <b", "cut off"),
    (f"<body class='has-sidebar'><article class='post with-comments'><header><h1>Head</h1></header><p>Text.</p></article>"
     f"<article class='comment'><p>{LONG}</p></article></body>", "Head\nText."),
    (f"<article><p>First.</p><section id='comments'><article><p>{LONG}</p></article></section><p>Last.</p></article>", "First.\nLast."),
])
def test_page(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("odd", ["<svg class='icon'/>", "<math/>", "<object data=x>", "<noscript>", "<template>", "<svg>", "<svg/><svg><p>no</p></svg>"])
def test_text_after_a_tag_without_a_close(odd):
    assert html_text.main_text(f"<p>{LONG}</p>{odd}<p>{LONG}</p>") == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("names", ["class='content has-sidebar'", "id='page' class='no-comments'", "class='site nav-fixed'", "class='post with-share'"])
def test_layout_names_keep_the_page(names):
    assert html_text.main_text(f"<div {names}><article><p>{LONG}</p></article></div>") == LONG
    assert html_text.main_text(f"<div {names}><p>{LONG}</p><div class='main-nav'>{LONG}</div><div id=comments>{LONG}</div></div>") == LONG


def test_an_unclosed_script_takes_the_rest():
    assert html_text.main_text(f"<p>{LONG}</p><script><p>{LONG}</p>") == LONG


def test_ambiguous_blocks_follow_the_nearest():
    assert html_text.second_pass([None, True, None, None, False, None]) == [True, True, True, False, False, False]
    assert html_text.second_pass([True, None, False]) == [True, True, False]
    assert html_text.second_pass([None, None]) == [True, True] and html_text.second_pass([]) == []


@pytest.mark.parametrize("names", ["login-page", "page-header", "main header-page", "notice-board", "article-tags", "search-results", "ad-free", "banner-top"])
def test_a_wrapper_is_kept_whatever_its_name(names):
    page = f"<div class='{names}'><p>{LONG}</p><p>{LONG}</p><div class='ad'>{LONG}</div><div class='promo-box'>{LONG}</div></div><div class='notice'>{LONG}</div>"
    assert html_text.main_text(page) == f"{LONG}\n{LONG}"


def test_teasers_beside_plain_text():
    cards = "".join(f"<article><h2><a href=x>Story {k}</a></h2><p>More of it is here.</p></article>" for k in range(3))
    assert html_text.main_text(f"<div>{cards}</div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>").split("\n")[-3:] == [LONG, "Short.", LONG]
    one = "<article><a href=x>Story</a> of the day</article>"
    assert html_text.main_text(f"<p>{LONG}</p><p>{LONG}</p>{one}").split("\n")[:2] == [LONG, LONG]


def plain_two_pass(page):
    """The rules written down once more, block by block, quadratic."""
    blocks = list(html_text.blocks_of(page))

    def rule(b, marked):
        size = len(b.text)
        words = re.findall(r"[^\W\d_]+", b.text.lower())
        stops = sum(w in html_text.STOPS for w in words) / len(words) if words else 0
        if b.link_chars > 0.4 * max(1, len(b.text.replace(" ", ""))):
            return "bad"
        if marked:
            return "good" if size >= 70 or stops >= 0.15 else "?"
        if size >= 200 and stops >= 0.15 or size >= 70 and stops >= 0.3:
            return "good"
        if b.link_chars and (size < 70 or size < 200 and stops < 0.15):
            return "bad"
        return "?"

    size = lambda b: len(b.text.replace(" ", ""))
    outside = sum(size(b) for b in blocks if not b.mark and rule(b, False) == "good")
    inside = [b for b in blocks if b.mark]
    teasers = outside > sum(size(b) - b.link_chars for b in inside) and (
        len({b.mark for b in inside}) > 1 or any(b.link_chars for b in inside))
    marked = bool(inside) and not teasers
    labels = [rule(b, marked and b.mark > 0) if b.mark or not marked else "bad" for b in blocks]
    total = sum(size(b) for b, x in zip(blocks, labels) if x == "good")
    for i, b in enumerate(blocks):
        for element in b.named:
            below = sum(size(c) for c, x in zip(blocks, [rule(c, marked and c.mark > 0) if c.mark or not marked else "bad" for c in blocks])
                        if x == "good" and element in c.named)
            if 2 * below <= total:
                labels[i] = "bad"
    final = []
    for i, b in enumerate(blocks):
        if labels[i] != "?":
            final.append(labels[i] == "good")
            continue
        same = [(abs(i - j), labels[j] != "good") for j, c in enumerate(blocks) if labels[j] != "?" and (not marked or (c.mark > 0) == (b.mark > 0))]
        final.append(not min(same)[1] if same else True)
    return "\n".join(b.text for b, good in zip(blocks, final) if good)


def strange_pages(n):
    rng = random.Random(5)
    parts = [f"<p>{LONG}</p>", "<p>Short.</p>", "<p><a href=x>one</a> two</p>", "<article>", "</article>", "<div class='promo-box'>", "</div>", "<div class=ad>",
             "<p>zxq vbn wrt plk mnb sdf xcv qwrt zxq vbn wrt plk mnb sdf xcv qwrt zxq</p>", "<nav>", "</nav>", "<h2>Head of it</h2>", f"<p>{LONG} {LONG}</p>",
             f"<p><a href=x>{LONG}</a> and the rest of it</p>", "<div class='has-ads'>", "<ul><li>a<li>b</ul>", "<main>", "</main>", "<div id=page-header>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_two_passes_against_a_plain_version(spark, sf_dir):
    pages = [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    for page in pages + [p.replace("<article>", "").replace("</article>", "") for p in pages] + strange_pages(800):
        assert html_text.main_text(page) == plain_two_pass(page), page[:300]


def test_articles_without_their_mark(spark):
    lost = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        page = r["html"]
        want = html_text.main_text(page).split("\n")
        got = html_text.main_text(page.replace("<article>", "").replace("</article>", "")).split("\n")
        assert set(got) <= set(want)
        lost, total = lost + sum(w not in got for w in want), total + len(want)
    assert lost <= 0.02 * total


def test_pages_with_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, block string"
    rows = [(1, "u", f"<p>{LONG}", "x", 1, "b"), (1, "u", f"<p>{LONG}", "x", 1, "b"), (None, None, None, None, None, None)]
    got = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == [(0, ""), (1, LONG), (1, LONG)]
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []


def test_very_long_page():
    assert len(html_text.main_text("<article>" + f"<p>{LONG}</p>" * 20_000)) == 20_000 * (len(LONG) + 1) - 1
