"""Main text of web pages by two-pass block rules.

A tolerant tag scanner cuts a page into blocks, one per run of text between block-level tags. Elements that by their tag, role or a
plain mark never hold main text (menus, forms, scripts, hidden parts ...) are left out whole. The first pass decides blocks by link
density, length and stop-word density: good, bad, or ambiguous. The second pass gives every ambiguous block the label of its nearest decided
neighbour; between a good and a bad one at equal distance it is good.

Two features of a block shift the first pass. A class or id that names an advert, a notice and the like (``NEVER_NAMES``) makes the blocks below
it bad, unless the element holds most of the page's good text and so is a wrapper; names of ``FIRM_NAMES`` always count. Where the page marks its article
(``article``, ``main``, or the same as role or item property), length alone or some stop words make the blocks in it good, blocks outside are
bad, and ambiguous ones look for neighbours on their own side. Marks of teasers (several marks, or one with links, with more good text outside)
are no such marks.

One map over slices of Arrow batches; a page is handled alone, in time linear in its length.

Defined results: NULL or empty html gives an empty text; unclosed and stray tags are allowed; a
page cut off in the middle keeps what was read; a page without any decided block keeps its ambiguous ones;
repeated rows are handled alike, an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.quality_rules import STOP_WORDS
from sparkgrad.llm.slices import map_texts
from sparkgrad.llm.text import read

MAX_LINK_DENSITY = 0.4
SHORT_CHARS = 70
LONG_CHARS = 200
STOPS_LOW = 0.15
STOPS_HIGH = 0.3
STOPS = frozenset(STOP_WORDS)

# Names of HTML elements, and words of classes, ids and roles.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
TO_THE_END = frozenset("script style textarea title iframe noframes xmp".split())  # an unclosed one takes the rest of the page
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe noframes template xmp svg math object".split())
NEVER_TAGS = frozenset(
    "nav footer aside form script style textarea title noscript iframe noframes template xmp svg math object head button select "
    "menu dialog audio video canvas map datalist label input".split())
CLOSED_BY_OWN_KIND = frozenset("p li dt dd tr td th option".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners breadcrumb breadcrumbs byline-social comment comments "
    "commentlist consent cookie cookies copyright dialog disclaimer disqus footer gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup promo promos promotion recommended related replies respond "
    "responses search share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription tags toolbar widget widgets".split())
FIRM_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox comment comments commentlist consent cookie cookies disqus footer menu "
    "menus nav navbar navigation replies respond responses sidebar sidebars".split())
READER_NAMES = frozenset("comment comments commentlist disqus replies respond responses".split())
SWITCHES = frozenset("has have no not with without is show hide fixed sticky enabled disabled on off open closed left right".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PARTS = re.compile(r"[a-z]+")
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    mark: int  # number of the outermost article mark around it, 0 for none
    named: tuple[int, ...] = ()  # numbers of the elements around it whose names speak against it
    chars: int = field(init=False)

    def __post_init__(self):
        self.chars = len(self.text.replace(" ", ""))


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(source)}


def unwanted(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """True for an element that holds no main text."""
    if tag in NEVER_TAGS or tag == "header" and not in_article:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in NEVER_ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "").lower()))


def against(tag: str, attrs: dict[str, str], in_article: bool) -> str:
    """What the class and id names say: "firm", "vote" or ""."""
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()
    if tag in ("html", "body", "article", "main"):  # a part of a name may be a switch of the page: has-sidebar, no-comments
        names = [n for n in names if n in NEVER_NAMES]
    said = [name_says(name, in_article) for name in names]
    return "firm" if "firm" in said else "vote" if "vote" in said else ""


def name_says(name: str, in_article: bool) -> str:
    """A name counts if it, or its first or last part, is one of NEVER_NAMES and no part makes it a switch."""
    parts = NAME_PARTS.findall(name)
    if SWITCHES.intersection(parts):
        return ""
    # the header of an article is its own headline
    found = [x for x in (name, *parts[:1], *parts[-1:]) if x in NEVER_NAMES and not (in_article and x == "header")]
    if name in FIRM_NAMES or READER_NAMES.intersection(found):
        return "firm"
    return "vote" if found else ""


def is_article(tag: str, attrs: dict[str, str]) -> bool:
    return (tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article")
            or attrs.get("itemprop", "").lower() == "articlebody")


def blocks_of(page: str) -> Iterator[Block]:
    """Blocks of wanted text in page order."""
    # tag, unwanted, article mark, in link, elements with names against them; each holds for what is inside
    stack: list[tuple[str, bool, int, bool, tuple[int, ...]]] = []
    marks = elements = 0
    parts: list[str] = []
    links = 0
    unclosed: set[str] = set()

    def block() -> Iterator[Block]:
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            yield Block(text, links, *((stack[-1][2], stack[-1][4]) if stack else (0, ())))
        parts.clear()
        links = 0

    def said(raw: str) -> None:
        nonlocal links
        if raw and not (stack and stack[-1][1]):
            text = html.unescape(raw)
            parts.append(text)
            if stack and stack[-1][3]:
                links += len("".join(text.split()))

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        said(page[at:found.start() if found else end])
        if not found:
            break
        at = found.end()
        closing, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is None:
                if tag == "p":
                    yield from block()
                continue
            if any(entry[0] in BLOCK_TAGS for entry in stack[depth:]):
                yield from block()
            del stack[depth:]
            continue
        if tag == "br":
            said(" ")
        if tag in BLOCK_TAGS:
            yield from block()
        if tag in VOID_TAGS:
            continue
        if tag in CLOSED_BY_OWN_KIND:  # an open one of the same kind ends here, unless a list or table lies between
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK_TAGS:
                    break
        attrs = attributes(found[3]) if found[3].strip(" /\n\t") else {}
        over = stack[-1] if stack else ("", False, 0, False, ())
        if tag in RAW_TAGS:  # their content is no markup
            if tag in ("svg", "math") and found[3].rstrip().endswith("/"):
                continue
            if tag not in unclosed:
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if close:
                    at = close.end()
                    continue
                unclosed.add(tag)  # no later one is closed either
            if tag in TO_THE_END:
                at = end
            continue
        if found[3].rstrip().endswith("/") and tag not in BLOCK_TAGS and tag != "a":
            continue
        mark, named, elements = over[2], over[4], elements + 1
        if not mark and is_article(tag, attrs):
            mark = marks = marks + 1
        says = against(tag, attrs, bool(mark))
        if says == "vote":
            named += (elements,)
        stack.append((tag, over[1] or says == "firm" or unwanted(tag, attrs, bool(mark)), mark, over[3] or tag == "a", named))
    yield from block()


def by_rules(block: Block, marked: bool) -> bool | None:
    """Label by link density, length and stop-word density; True: good, False: bad, None: ambiguous. ``marked``: with an article's thresholds."""
    if block.link_chars > MAX_LINK_DENSITY * max(1, block.chars):
        return False
    words = LETTERS.findall(block.text.lower())
    density = sum(w in STOPS for w in words) / max(1, len(words))
    if marked:
        return True if len(block.text) >= SHORT_CHARS or density >= STOPS_LOW else None
    if len(block.text) >= SHORT_CHARS and (density >= STOPS_HIGH or len(block.text) >= LONG_CHARS and density >= STOPS_LOW):
        return True
    doubtful = len(block.text) < SHORT_CHARS or density < STOPS_LOW and len(block.text) < LONG_CHARS
    return False if doubtful and block.link_chars else None


def first_pass(blocks: list[Block]) -> tuple[list[bool | None], bool]:
    """Labels, and whether the page marks its article."""
    plain = [by_rules(b, False) for b in blocks]
    good = lambda some: sum(b.chars for b, p in zip(blocks, plain) if p and some(b))
    own = sum(b.chars - b.link_chars for b in blocks if b.mark)
    teasers = good(lambda b: not b.mark) > own and (len({b.mark for b in blocks if b.mark}) > 1 or any(b.link_chars for b in blocks if b.mark))
    marked = any(b.mark for b in blocks) and not teasers
    labels = [by_rules(b, True) if marked and b.mark else p for b, p in zip(blocks, plain)]
    # a wrapper has most of the good text below it
    held: dict[int, int] = {}
    total = 0
    for b, label in zip(blocks, labels):
        if label and (b.mark or not marked):
            total += b.chars
            for element in b.named:
                held[element] = held.get(element, 0) + b.chars
    wrappers = {element for element, n in held.items() if 2 * n > total}
    return [False if marked and not b.mark or set(b.named) - wrappers else label for b, label in zip(blocks, labels)], marked


def second_pass(labels: list[bool | None], sides: list[bool] | None = None) -> list[bool]:
    """Ambiguous labels from the nearest decided neighbour; good wins a tie, and where nothing is decided.

    ``sides``: blocks of one side take labels of their own side only.
    """
    n = len(labels)
    sides = sides or [False] * n

    def nearest(order: range) -> list[tuple[int, bool | None]]:
        out: list[tuple[int, bool | None]] = [(n + 1, None)] * n
        last: dict[bool, int] = {}
        for i in order:
            if labels[i] is not None:
                last[sides[i]] = i
            if sides[i] in last:
                out[i] = (abs(i - last[sides[i]]), labels[last[sides[i]]])
        return out

    decided = []
    for (d1, before), (d2, after) in zip(nearest(range(n)), nearest(range(n - 1, -1, -1))):
        near = [x for d, x in ((d1, before), (d2, after)) if x is not None and d == min(
            e for e, y in ((d1, before), (d2, after)) if y is not None)]
        decided.append(any(near) if near else True)
    return decided


def labelled(page: str | None) -> list[tuple[Block, bool]]:
    """All blocks with their final labels."""
    found = list(blocks_of(page or ""))
    labels, marked = first_pass(found)
    return list(zip(found, second_pass(labels, [marked and b.mark > 0 for b in found])))


def main_text(page: str | None) -> str:
    return "\n".join(b.text for b, good in labelled(page) if good)


def extract(pages: DataFrame, source: str = "html", keep: tuple[str, ...] = ("page_id", "url"), text: str = "text") -> DataFrame:
    """The columns in ``keep`` and the main text."""
    return map_texts(pages, source, keep, f"`{text}` string", lambda: lambda found: ([main_text(p) for p in found],))


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
