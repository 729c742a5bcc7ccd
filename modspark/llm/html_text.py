"""Main text of web pages by tag-path ratios.

Text nodes of a page are grouped by their path of tags from the root. Article paths hold
long texts with marks of punctuation, menus and lists of links short ones without. Both
ratios are averaged per path, smoothed along the page, so that a short heading between
paragraphs is carried by them, and fused; paths above a share of the best one are content,
all of them, and so are the blocks that share their container, the deepest that holds them all. Elements that are no article by their
meaning (navigation, footers, forms, adverts, comments, ...) never count.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|/?[a-zA-Z](?:=\s*+(?:"[^"]*+"|'[^']*+')|=|[^>=]++)*+(?:>|\Z))""", re.S
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
MARKED = re.compile(r"""\s(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

# fixed values: elements of HTML by what they mean for the text
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEVER = {
    "nav", "header", "footer", "aside", "form", "button", "select", "fieldset", "dialog", "menu", "noscript", "template",
    "svg", "canvas", "object", "head", "audio", "video", "map", "label", "legend", "datalist",
}
BLOCKS = {
    "html", "body", "li", "dd", "dt", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup", "option", "optgroup",
    "summary", "hgroup", "center", "dir", "listing", "plaintext", "frameset", "hr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_PARAGRAPH = HEADINGS | {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer",
    "form", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
# all other tags, unknown ones among them, run on in their line
LINES = BLOCKS | CLOSES_PARAGRAPH | NEVER | RAW
SAME_CLOSES = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "p": {"p"},
}
SCOPES = {"ul", "ol", "dl", "table", "select", "div", "article", "section", "main", "body"}
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|promo|promotion|sponsor|sponsored|sidebar|menu|nav|navbar|"
    r"navigation|breadcrumbs?|footer|header|masthead|comments?|disqus|replies|cookies?|consent|gdpr|notice|popup|modal|"
    r"newsletter|subscribe|subscription|share|sharing|social|related|recommended|recommendations|widget|login|signup|search|"
    r"toolbar|pagination|pager|tags|contentinfo|complementary|dialog|alert)(?:$|[\s_-])",
    re.I,
)
ADVERT = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|promo|promotion|sponsor|sponsored)(?:$|[\s_-])", re.I)
"""What marks a piece of a line as no part of the text."""
OWN_HEADER = re.compile(r"\b(?:post|entry|article|story)[_-]header\b", re.I)
QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
HIDDEN = re.compile(r"\shidden(?=[\s=/>])", re.I)
UNSEEN = re.compile(r"""\sstyle\s*=\s*(?:"[^"]*|'[^']*)display\s*:\s*none""", re.I)
TOP = {"", "html", "body"}
"""Tags that hold the whole page, its article and all else."""
PUNCTUATION = re.compile(r"[.,;:!?。，،؟]")


@dataclass(frozen=True)
class PathRatios:
    """Width of the smoothing in text nodes, weight of punctuation, share of the best path."""

    width: float = 1.0
    mark_weight: float = 12.0
    share: float = 0.12


@dataclass
class Node:
    path: int
    block: int
    text: str
    link: bool


@dataclass
class Page:
    """Text nodes of a page and its tree of paths."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    nodes: list[Node] = field(default_factory=list)


def read_page(source: str) -> Page:
    """Tags to paths and text nodes; elements that never hold the article are left out."""
    page, known = Page(), {}
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    open_tags: Counter[str] = Counter()
    block, at, links = 0, 0, 0

    def add(text: str) -> None:
        if text and not stack[-1][2]:
            page.nodes.append(Node(stack[-1][1], block, html.unescape(text), links > 0))

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    while at < len(source):
        token = TOKEN.search(source, at)
        if token is None:
            add(source[at:])
            break
        add(source[at : token.start()])
        at, raw = token.end(), token.group()
        name = NAME.match(raw)
        if name is None:
            continue
        if not raw.endswith(">"):
            break  # the page ends inside a tag
        tag, closing = name.group(1).lower(), raw[1] == "/"
        if tag == "br":
            add(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag not in LINES:
            # only pieces of a line that do not count are remembered
            if closing and open_tags[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif not closing and tag not in VOID and (unseen(raw) or marked(raw, ADVERT)):
                stack.append((tag, stack[-1][1], True))
                open_tags[tag] += 1
            continue
        block += 1
        if closing:
            if open_tags[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
                links = 0
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            at = end.start() if end else len(source)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_PARAGRAPH and open_tags["p"]:
            while stack[-1][0] != "p":
                pop()
            pop()
        closes = SAME_CLOSES.get(tag)
        if closes:
            depth = len(stack) - 1
            while depth > 0 and stack[depth][0] not in SCOPES and stack[depth][0] not in closes:
                depth -= 1
            if stack[depth][0] in closes:
                while len(stack) > depth:
                    pop()
        above = stack[-1]
        path = known.setdefault((above[1], tag), len(page.tag))
        if path == len(page.tag):
            page.parent.append(above[1])
            page.tag.append(tag)
        noise = above[2] or tag in NEVER or (tag not in TOP and unseen(raw)) or (tag not in {"html", "body", "article", "main"} and marked(raw, NOISE))
        stack.append((tag, path, noise))
        open_tags[tag] += 1
    return page


def marked(raw: str, words: re.Pattern) -> bool:
    return any(words.search(OWN_HEADER.sub(" ", value.strip("\"'"))) for value in MARKED.findall(raw))


def unseen(raw: str) -> bool:
    return bool(HIDDEN.search(QUOTED.sub('""', raw)) or UNSEEN.search(raw))


def smoothed(values: np.ndarray, width: float) -> np.ndarray:
    reach = max(1, round(2 * width))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach:-reach]
    return np.convolve(values, kernel)[reach:-reach] / weight


def main_text(source: str | None, ratios: PathRatios = PathRatios()) -> str:
    """Text of the content blocks in page order, one line each; empty if there are none."""
    page = read_page(source or "")
    blocks: dict[int, tuple[int, list[str], list[int]]] = {}
    for node in page.nodes:
        path, texts, linked = blocks.setdefault(node.block, (node.path, [], [0]))
        texts.append(node.text)
        linked[0] += len(node.text) if node.link else 0
    rows = []
    for path, texts, linked in blocks.values():
        text = " ".join("".join(texts).split())
        if text:
            rows.append((path, text, min(len(text), linked[0])))
    if not rows:
        return ""
    paths, place = np.unique([path for path, _, _ in rows], return_inverse=True)
    count = np.bincount(place)
    # text inside links does not speak for a path
    length = np.bincount(place, [len(text) - linked for _, text, linked in rows]) / count
    marks = np.bincount(place, [len(PUNCTUATION.findall(text)) * (linked < len(text)) for _, text, linked in rows]) / count
    fused = smoothed(length[place], ratios.width) + ratios.mark_weight * smoothed(marks[place], ratios.width)
    score = np.bincount(place, fused) / count * (length > 0)
    best = score.max()
    if best <= 0:
        # nothing but links: what an article or main element holds is meant to be read
        return "\n".join(text for path, text, _ in rows if within(page, path, {"article", "main"}))
    chosen = {int(p) for p, s in zip(paths, score, strict=True) if s >= ratios.share * best}
    container = lowest_common(page, {page.parent[path] for path in chosen})
    if page.tag[container] in TOP:
        # chosen paths all over the page: blocks are shared with the one of most text only
        mass = Counter()
        for path, text, linked in rows:
            if path in chosen:
                mass[page.parent[path]] += len(text) - linked
        container = max(mass, key=lambda p: (mass[p], -p))
    whole = page.tag[container] not in TOP
    kept = [text for path, text, linked in rows if path in chosen or (whole and linked < len(text) and below(page, path, container))]
    return "\n".join(kept)


def lowest_common(page: Page, paths: set[int]) -> int:
    """The deepest path that all the paths are at or below; a parent's number is below its children's."""
    while len(paths) > 1:
        last = max(paths)
        paths = (paths - {last}) | {page.parent[last]}
    return paths.pop()


def within(page: Page, path: int, tags: set[str]) -> bool:
    while path >= 0:
        if page.tag[path] in tags:
            return True
        path = page.parent[path]
    return False


def below(page: Page, path: int, container: int) -> bool:
    while path > container:
        path = page.parent[path]
    return path == container


def extracted(pages: DataFrame, ratios: PathRatios = PathRatios()) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages(page_id, url, html).

    A null or empty page, or one without an article, has an empty text. Whole pages are
    read, nothing is cut. Repeated rows come out as often as they came in; other columns
    are ignored; no rows give no rows. A page is read in one pass.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py(), ratios) for source in batch.column(2)]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")
