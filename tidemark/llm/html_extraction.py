"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  First pass, one block at a time: a block inside a menu, header, footer,
sidebar, notice, advert, form or comment section goes; a block whose characters are mostly link text goes; a long block
with few links stays if enough of its words are stop words (of any of ``STOP_WORDS``' languages, signs around words ignored) and
goes if not; a short block, a heading, and a long one of middling density are left open.  Second pass: open blocks inherit
the label of the nearest decided neighbours - both alike: theirs; differing: the nearer one's, a tie stays; a heading goes with
what follows it.  What lies beyond the first and the last block counts as boilerplate, or as text inside an
``article`` or ``main`` element, which tells a page's text already: there long blocks of low stop-word density (other languages, noise)
are left open too, an advert or form amid the text is no neighbour, and blocks outside such elements go if one of them holds text that stays.

Text is whole: character references decoded, white space inside a block one space, blocks joined in page order by one
space; scripts, styles, templates and markup comments hold no text.  Unclosed elements end with the element around them, a
``main`` or ``article`` ends an unclosed menu or header, unclosed scripts, styles and comments run to the end, as in HTML.

Pages are rows of their own: no shuffle, an Arrow batch at a time, and time linear in a page's length.
Defined results: null and empty pages, and pages without text that stays, give an empty text.  Equal rows each give a row.
Other columns pass through, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.frames import python_map, schema_with, spare

#: Characters from which a block is long; link characters over all from which it is a list of links; stop words over
#: words from which a long block is text, and under which it isn't.
LONG, MAX_LINKS, TEXT_DENSITY, LEAST_DENSITY = 70, 0.5, 0.25, 0.12
#: Characters of a batch of results.
BATCH_CHARS = 1 << 23

# Frequent function words.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be been but by can could for from had has have he her his how i if in into is it its
just more my no not of on one or other our out she so some than that the their them then there these they this to up was we were
what when which who will with would you your
aber als am an auch auf aus bei bis das dass dem den der des die doch du ein eine einem einen einer er es für hat ich im in ist
ja kann mit nach nicht noch nur oder sich sie sind so über um und uns vom von vor war was wenn werden wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas plus pour
qu que qui sa se ses son sont sur un une vous
al como con de del donde el ella en entre era es esta este fue ha hasta la las lo los más me mi muy no nos o para pero por porque
que se si sin sobre son su sus también un una y ya
""".split())
# HTML's element names.
BLOCKS = frozenset("""address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
search section select summary table tbody td textarea tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("""aside button canvas datalist dialog fieldset footer form header iframe input label menu nav noscript
object option search select svg textarea title""".split())
RAW = "script style template xmp iframe noembed noframes textarea title".split()
# Words of class and id names, and roles, that mark what isn't the article.
MARKS = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie
cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager
pagination paywall popup promo promotion related replies respond share sharing sidebar signup social sponsor sponsored
subscribe subscription teaser toolbar widget""".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_TOKEN = re.compile(rf"""(?is)<!--(?:-?>|.*?(?:--!?>|\Z))            # comments
    |<(?P<raw>{"|".join(RAW)})(?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)|\Z)   # elements without markup inside
    |<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""", re.X)
_MARK = re.compile(r"""(?is)\b(?P<name>class|id|role)\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s>]+))""")
_MARK_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """A run of text between block-level tags; ``container``: number of the article or main around it, 0 outside."""

    dropped: bool = False
    heading: bool = False
    container: int = 0
    parts: list = field(default_factory=list)
    linked: list = field(default_factory=list)
    text: str = ""
    links: int = 0  # characters of link text


def _marked(attrs: str) -> bool:
    for m in _MARK.finditer(attrs):
        value = m["a"] or m["b"] or m["c"] or ""
        if m["name"].lower() == "role":
            if value.strip().lower() in ROLES:
                return True
        elif not MARKS.isdisjoint(w.lower() for w in _MARK_WORD.findall(value)):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The non-empty blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []  # open elements but those whose end tags may be left out: (name, kind)
    depth = {"drop": 0, "main": 0, "a": 0, "heading": 0, "": 0}
    containers = 0
    paragraph = None  # inside a p, li, ...: (height of the stack at its start, whether its marks say boilerplate)
    now = Block()

    def pop_to(height: int) -> None:
        while len(stack) > height:
            depth[stack.pop()[1]] -= 1

    def end_block() -> None:
        nonlocal now
        if not now.parts:
            return
        now.text = " ".join(html.unescape("".join(now.parts)).split())
        if now.text:
            now.links = len(" ".join(html.unescape("".join(now.linked)).split())) if now.linked else 0
            out.append(now)
        now = Block()

    def add(text: str) -> None:
        if not now.parts:
            now.dropped = depth["drop"] > 0 or bool(paragraph and paragraph[1])
            now.container = containers if depth["main"] else 0
            now.heading = depth["heading"] > 0
        now.parts.append(text)
        if depth["a"]:
            now.linked.append(text)

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at:token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if token["raw"]:
            if token["raw"].lower() in BLOCKS:
                end_block()
            continue
        if not name:
            continue
        if name == "br":
            add(" ")
        block = name in BLOCKS
        if block:
            end_block()
            if paragraph is not None:  # inline elements left open end with their paragraph
                if len(stack) > paragraph[0] and all(n not in BLOCKS for n, _ in stack[paragraph[0]:]):
                    pop_to(paragraph[0])
                paragraph = None
        if name in VOID:
            continue
        if token["close"]:
            for height in range(len(stack) - 1, -1, -1):
                if stack[height][0] == name:
                    pop_to(height)
                    break
                if not block and stack[height][0] in BLOCKS:
                    break  # an inline end tag closes no block
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "option", "optgroup"):
            paragraph = (len(stack), _marked(token["attrs"]))
            continue
        kind = ""
        if name in ("article", "main"):
            while stack and any(n in ("nav", "header") for n, _ in stack):
                pop_to(max(h for h, (n, _) in enumerate(stack) if n in ("nav", "header")))
            kind = "main"
            containers += not depth["main"]
        elif name in HEADINGS:
            kind = "heading"
        elif name == "a":
            if stack and stack[-1][0] == "a":
                pop_to(len(stack) - 1)
            kind = "a"
        elif name in BOILERPLATE or (name not in ("html", "body") and token["attrs"] and _marked(token["attrs"])):
            kind = "drop"
            if name == "header" and depth["main"]:
                kind = ""  # an article's own header holds its title
        if kind != "main" and token["attrs"].rstrip().endswith("/") and name not in BLOCKS:
            continue  # <svg .../> and the like hold nothing
        stack.append((name, kind))
        depth[kind] += 1
    if at < len(page):
        add(page[at:])
    end_block()
    return out


def _first_pass(block: Block) -> bool | None:
    """Text (True), boilerplate (False) or open (None), by the block alone."""
    if block.dropped:
        return False
    if block.links > MAX_LINKS * len(block.text):
        return False
    if block.heading or len(block.text) < LONG:
        return None
    words = _WORD.findall(block.text.lower())
    density = sum(map(STOP_WORDS.__contains__, words)) / max(1, len(words))
    if density >= TEXT_DENSITY:
        return True
    return False if density < LEAST_DENSITY and not block.container else None


def labels(page: list[Block]) -> list[bool]:
    """Which blocks are text."""
    first = [_first_pass(b) for b in page]
    if any(label and b.container for label, b in zip(first, page)):
        first = [label if b.container else False for label, b in zip(first, page)]
    out = []
    before: list[tuple[bool | None, int]] = []  # label and distance of the nearest decided block in the same container
    for which in (range(len(page)), range(len(page) - 1, -1, -1)):
        found: list[tuple[bool | None, int]] = [(None, 0)] * len(page)
        label, distance, container = None, 0, None
        for k in which:
            if page[k].container != container:
                container, label, distance = page[k].container, bool(page[k].container), 0
            distance += 1
            found[k] = (label, distance)
            if first[k] is not None and not (container and page[k].dropped):
                label, distance = first[k], 0
        if not before:
            before = found
    for k, label in enumerate(first):
        if label is None:
            (left, far_left), (right, far_right) = before[k], found[k]
            if page[k].heading or left == right:
                label = right
            else:
                label = left if far_left < far_right else right if far_right < far_left else True
        out.append(bool(label))
    return out


def main_text(page: str | None) -> str:
    """The main text of one page."""
    found = blocks(page or "")
    return " ".join(b.text for b, keep in zip(found, labels(found)) if keep)


def _extracted(page: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, start, size, texts = batch.column(batch.schema.get_field_index(page)), 0, 0, []
            for k, value in enumerate(column):
                texts.append(main_text(value.as_py()))
                size += len(texts[-1])
                if size >= BATCH_CHARS or k == len(column) - 1:
                    part = batch.slice(start, k + 1 - start)
                    found = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["text", "n_chars"])
                    yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, into])
                    start, size, texts = k + 1, 0, []
    return run


def extract(pages: DataFrame, page: str = "html", into: str = "main") -> DataFrame:
    """``pages`` with a struct column ``into`` (``spare`` of it, if there is one): the main text and its number of code points."""
    into = spare(pages, into)
    return python_map(pages, _extracted(page, into), schema_with(pages, into, "struct<text:string,n_chars:bigint>"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "main.text", "main.n_chars")
