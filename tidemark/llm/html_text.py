"""Main text of web pages by two-pass block rules.

A page is read as tags, character references and text. What stands in elements that are never content (scripts, styles, forms,
navigation, headers of pages, footers, asides, ...) or in elements whose class, id or role says so (adverts,
comments, cookie notices, ...) is left out; what remains between block elements forms blocks.

First pass: a block is good, bad, near-good or short by its length, its link density (share of characters inside links)
and its stop-word density. Stop words are those of the page's language if it names a known one, else of all. Second pass: an
ambiguous block (short or near-good) takes the label of its nearest decided neighbours; between a good and a bad one, near-good
counts as good, and short as the nearer. A block inside a content element (article, main) or a heading that leads one is
decided as good unless it is mostly links. A page without an article element is judged by these rules alone.

Null and empty pages, and pages without a good block, have the text ''. Unclosed, stray and cut-off tags are taken as browsers
mostly do: a paragraph ends where the next block begins, an open element ends with its parent. Very long pages are read
whole. Rows that repeat are each read. Extra columns are not touched. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: Element names.
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
SKIPPED = frozenset("nav aside footer form head button dialog menu header".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that mark what is not content.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|comments?|disqus|cookies?|consent|notice|gdpr|popup|modal|newsletter|subscribe"
    r"|sidebar|nav\w*|menu|breadcrumbs?|pagination|pager|footer|masthead|topbar|toolbar|share|social|related|recommended|widget"
    r"|skip|login|signup|search|copyright|legal|complementary|contentinfo)(?:$|[\s_-])"
)
#: Frequent words by language.
STOP_WORDS = {
    "en": "the and of to in a is it that for was on are with as be at by this from not or an have he".split(),
    "de": "der die das und in zu den ist von mit sich auf für nicht ein eine als auch dem es im".split(),
    "fr": "le la les de des et en un une que qui est dans pour au avec sur pas du il ce".split(),
    "es": "el la los las de y en que un una es por con para del se no su al lo como".split(),
}
_ALL = frozenset(word for words in STOP_WORDS.values() for word in words)
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOPS_LOW, STOPS_HIGH = 0.12, 0.2
LINKS_HIGH = 0.4

_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$))", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|lang|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


class _Block:
    __slots__ = ("content", "heading", "links", "parts", "text")

    def __init__(self, content: bool, heading: bool):
        self.content, self.heading, self.links, self.parts, self.text = content, heading, 0, [], ""


def _blocks(html: str) -> tuple[list[_Block], str]:
    """Blocks in page order, and the page's language."""
    found: list[_Block] = []
    #: Open elements: name, whether content, whether left out.
    opened: list[tuple[str, bool, bool]] = []
    content = left_out = heading = False
    linked, language, at = 0, "", 0
    block = _Block(False, False)

    def ended() -> None:
        nonlocal block
        text = _SPACE.sub(" ", "".join(block.parts)).strip()
        if text:
            block.text = text
            found.append(block)
        block = _Block(content, heading)

    def put(text: str) -> None:
        if text and not left_out:
            text = unescape(text)
            block.parts.append(text)
            if linked:
                block.links += len(_SPACE.sub(" ", text).strip())

    size = len(html)
    while at < size:
        tag = _TAG.search(html, at)
        if tag is None:
            put(html[at:])
            break
        put(html[at:tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if not tag[1]:
            given = {k.lower(): a or b or c for k, a, b, c in _NAMED.findall(tag[3])} if tag[3] and "=" in tag[3] or "hidden" in tag[3] else {}
            if name == "html":
                language = given.get("lang", "").lower()[:2]
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}\s*(?:>|$)", re.I).search(html, at)
                at = stop.end() if stop else size
                continue
            if name in BLOCKS:
                if name in ("p", "li", "dt", "dd", "td", "th", "tr", "option") and opened and opened[-1][0] == name:
                    opened.pop()
                elif opened and opened[-1][0] == "p":
                    opened.pop()
                elif name != "br":
                    # An inline element left open inside a paragraph ends with it.
                    depth = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] in BLOCKS), -1)
                    if depth >= 0 and opened[depth][0] == "p":
                        del opened[depth:]
            if name == "a":
                linked += 1
            if name not in VOID:
                inside = content or name in CONTENT
                own = name in SKIPPED and not (name == "header" and content)
                marks = " ".join(given.get(k, "") for k in ("class", "id", "role")).lower()
                if not own and marks.strip() and name not in ("html", "body", "article", "main"):
                    own = bool(MARKED.search(marks))
                own = own or "hidden" in given and given["hidden"] != "until-found" or given.get("aria-hidden") == "true"
                parent_out = opened[-1][2] if opened else False
                opened.append((name, inside, parent_out or own))
        else:
            if name == "a":
                linked = max(linked - 1, 0)
            depth = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == name), -1)
            if depth >= 0:
                del opened[depth:]
        if name in BLOCKS:
            content = opened[-1][1] if opened else False
            heading = name in HEADINGS and not tag[1]
            if name != "br":
                linked = 0
            ended()
        left_out = opened[-1][2] if opened else False
    ended()
    return found, language


def _first_pass(block: _Block, stops: frozenset) -> str:
    length = len(block.text)
    if block.links > LINKS_HIGH * length:
        return "bad"
    if block.content:
        return "good"
    words = block.text.lower().split()
    density = sum(word.strip(".,;:!?\"'()") in stops for word in words) / len(words)
    if "©" in block.text or "copyright" in block.text.lower():
        return "bad"
    if length < LENGTH_LOW:
        return "bad" if block.links else "short"
    if density >= STOPS_HIGH:
        return "good" if length > LENGTH_HIGH else "near"
    return "near" if density >= STOPS_LOW else "bad"


def _second_pass(labels: list[str], headings: list[bool]) -> list[bool]:
    """Ambiguous blocks inherit from the nearest decided neighbours; with no good block at all, near-good ones are good."""
    if "good" not in labels:
        labels = ["good" if label == "near" else label for label in labels]
    before: list[tuple[str, int]] = []
    last = ("bad", -1)
    for k, label in enumerate(labels):
        before.append(last)
        if label in ("good", "bad"):
            last = (label, k)
    after, following = [("bad", len(labels))] * len(labels), ("bad", len(labels))
    for k in range(len(labels) - 1, -1, -1):
        after[k] = following
        if labels[k] in ("good", "bad"):
            following = (labels[k], k)
    out = []
    for k, label in enumerate(labels):
        (left, i), (right, j) = before[k], after[k]
        if label in ("good", "bad"):
            out.append(label == "good")
        elif left == right:
            out.append(left == "good")
        elif label == "near" or headings[k] and right == "good":
            out.append(True)
        else:
            out.append((left if k - i <= j - k else right) == "good")
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    blocks, language = _blocks(html)
    if any(block.content for block in blocks):
        # The page says where its article is: what is outside it is judged as a neighbour of none.
        blocks = [block for block in blocks if block.content]
    stops = frozenset(STOP_WORDS[language]) if language in STOP_WORDS else _ALL
    good = _second_pass([_first_pass(block, stops) for block in blocks], [block.heading for block in blocks])
    return " ".join(block.text for block, keep in zip(blocks, good, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                texts = [main_text(html) for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()),
                ], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(job, "page_id long, url string, text string, n_chars long")
