"""Main text of web pages by tag-path ratios.

A page's text blocks are grouped by their root-to-leaf path of block elements (with class and id). For every
path, the text outside links and the punctuation per block are taken, smoothed over neighbouring paths in page
order and fused (geometric mean); the share of link text lowers the ratio, and so does a class or id that names
furniture and nothing else (``sidebar`` or ``comment-list``, not ``share-price-report``). Paths above the
threshold, a share of the best ratio, are content. The answer is every block below their common ancestor, short
ones too, except paths that are mostly links or whose lowered ratio misses the threshold; a heading that stands
before the ancestor belongs to it. Elements that are never text (scripts, navigation, forms, footers, ...) are
left out, and where a page marks an article or a main part, only paths inside it compete.

A page is read once from left to right: a tag ends at the next unquoted ``>`` within ``TAG_CHARS`` characters,
else at the next ``>`` at all; a ``<`` that begins no tag is text. Paths are numbers, so depth costs nothing.

Defined results: a null or empty page, or one without content, gives the empty text; broken nesting is
repaired as browsers do for paragraphs, list items and table cells; equal pages give equal texts; null
ids are kept; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, tidy

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr img".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
NEVER = frozenset(
    "head script style noscript template iframe textarea title nav footer aside form button select option input"
    " svg canvas object embed menu dialog figure-ad".split()
)
CLOSED_BY_BLOCK = frozenset(("p",))
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "dt": ("dl",), "dd": ("dl",)}
FURNITURE = frozenset(
    "ad ads adv advert advertisement advertising adverts banner sponsor sponsored promo promotion promotions cookie"
    " cookies consent gdpr notice notices notification popup modal overlay menu nav navbar navigation breadcrumb"
    " breadcrumbs sidebar aside footer masthead comment comments commentlist disqus reply replies respond related"
    " recommended share sharing social subscribe subscription newsletter signup login widget widgets toolbar pagination"
    " pager skip alert copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
NEUTRAL = frozenset(
    "box wrap wrapper area list item items section block container inner outer content row col column left right top"
    " bottom head heading bar panel group module link links text icon button btn post posts article articles form site"
    " page web main the and for js is".split()
)
HEADINGS = frozenset(("h1", "h2"))
FURNITURE_CONTAINERS = frozenset("div section ul ol li p span header table tr td article dl figure center small a".split())
LAYOUT = re.compile(r"\b(?:has|with|no|without|overflow)-\S+", re.I)

TAG_CHARS = 1 << 14
TAG = re.compile(r"</?[a-zA-Z][^\s/>]*")
ENDS = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")


@dataclass(frozen=True)
class PathRules:
    threshold: float = 0.25  # of the best path's ratio
    named: float = 0.05  # factor on the ratio of a path whose class or id names furniture
    linked: float = 0.5  # a path with more of its text in links is a link list


class Block:
    __slots__ = ("path", "held", "pieces", "linked")

    def __init__(self, path: int, held: bool):
        self.path, self.held, self.pieces, self.linked = path, held, [], 0


class Paths:
    """Root-to-leaf paths as numbers; a path's parent has a smaller number."""

    def __init__(self):
        self.parent, self.label, self.named, self.known = [-1], [""], [False], {}

    def below(self, parent: int, label: str, named: bool) -> int:
        found = self.known.setdefault((parent, label), len(self.parent))
        if found == len(self.parent):
            self.parent.append(parent)
            self.label.append(label)
            self.named.append(named or self.named[parent])
        return found

    def common(self, chosen: list[int]) -> int:
        """The deepest path that all of ``chosen`` run through."""
        count = [0] * len(self.parent)
        for path in set(chosen):
            count[path] += 1
        for path in range(len(count) - 1, 0, -1):
            count[self.parent[path]] += count[path]
        return max((p for p, n in enumerate(count) if n == count[0]), default=0)

    def under(self, root: int) -> list[bool]:
        out = [False] * len(self.parent)
        out[root] = True
        for path in range(root + 1, len(out)):
            out[path] = out[self.parent[path]]
        return out


def names_furniture(value: str) -> bool:
    """Whether a word of a class or id names furniture and no other word speaks against it."""
    for token in LAYOUT.sub(" ", value).split():
        parts = {p.lower() for p in PART.findall(token)}
        if parts & FURNITURE and parts <= FURNITURE | NEUTRAL:
            return True
    return False


def judged(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, str]:
    """Whether the element is never text, whether it is named as furniture, and its label in paths."""
    if tag in NEVER or (tag == "header" and not in_article):
        return True, False, tag
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return False, False, tag
    label, never, named = tag, False, False
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if name in ("class", "id"):
            label += ("." if name == "class" else "#") + value
            if tag in FURNITURE_CONTAINERS:
                never = never or "hidden" in value.split()
                named = named or names_furniture(value)
        elif name == "role":
            never = never or value.lower() in ROLES
        elif name == "style":
            never = never or "display:none" in value.replace(" ", "").lower()
        elif name == "hidden" or value.lower() == "true":
            never = True
    return never, named, label


def tokens(html: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, tag, attributes) of each tag; end tags begin with /, comments and declarations have no name."""
    at, last = 0, {c: html.rfind(c) for c in ">\"'"}
    while (at := html.find("<", at)) >= 0:
        if html.startswith("<!--", at) or html.startswith("<![CDATA[", at):
            close = "-->" if html[at + 2] == "-" else "]]>"
            end = html.find(close, at + 4)
            end = len(html) if end < 0 else end + 3
        elif html.startswith(("<!", "<?"), at):
            end = html.find(">", at) + 1 or len(html)
        else:
            name = TAG.match(html, at)
            if name is None:
                at += 1
                continue
            if at > last[">"]:
                return  # no tag ends any more: the rest is text
            stop, limit = name.end(), name.end() + TAG_CHARS
            while True:
                mark = ENDS.search(html, stop, limit)
                if mark is None or mark[0] == ">":
                    break
                stop = html.find(mark[0], mark.end(), limit) + 1 if mark.end() <= last[mark[0]] else 0
                if not stop:
                    mark = None
                    break
            close = mark.start() if mark else html.find(">", name.end())
            yield at, close + 1, name[0][1:].lower(), html[name.end() : close]
            at = close + 1
            continue
        yield at, end, "", ""
        at = end


def blocks_of(html: str) -> tuple[list[Block], Paths]:
    """The text blocks of a page in order, without elements that are never text."""
    stack: list[tuple[str, int, bool, bool]] = []  # tag, path, never, inside an article or main part
    opened: dict[str, int] = {}
    paths = Paths()
    blocks: list[Block] = []
    block: Block | None = None
    at, size = 0, len(html)

    def text(raw: str) -> None:
        nonlocal block
        if stack and stack[-1][2]:
            return
        if block is None:
            if not raw.strip():
                return
            block = Block(stack[-1][1] if stack else 0, bool(stack) and stack[-1][3])
            blocks.append(block)
        block.pieces.append(unescape(raw))
        if opened.get("a"):
            block.linked += len(raw)

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1

    for start, end, tag, attrs in tokens(html):
        if start < at:
            continue
        if start > at:
            text(html[at:start])
        at = end
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if opened.get(tag):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        pop_to(depth)
                        break
            if tag not in INLINE:
                block = None
            continue
        if tag not in INLINE:
            block = None
            if opened.get("p") and tag != "br":
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in CLOSED_BY_BLOCK:
                        pop_to(depth)
                        break
                    if stack[depth][0] not in INLINE:
                        break
            rivals = {"td", "th"} if tag in ("td", "th") else {"dt", "dd"} if tag in ("dt", "dd") else {tag}
            if tag in SAME_CLOSES and any(opened.get(r) for r in rivals):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in SAME_CLOSES[tag]:
                        break
                    if stack[depth][0] in rivals:
                        pop_to(depth)
                        break
        if tag in VOID:
            continue
        above = stack[-1] if stack else ("", 0, False, False)
        never, named, label = judged(tag, attrs, above[3])
        path = above[1] if tag in INLINE and not named else paths.below(above[1], label, named)
        held = above[3] or tag in ("article", "main") or 'role="main"' in attrs
        if attrs.endswith("/"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = close.end() if close else size
            continue
        stack.append((tag, path, never or above[2], held))
        opened[tag] = opened.get(tag, 0) + 1
    if at < size:
        text(html[at:])
    return blocks, paths


def smoothed(values: np.ndarray) -> np.ndarray:
    wide = np.pad(values, 1, mode="edge")
    return (wide[:-2] + 2 * wide[1:-1] + wide[2:]) / 4


def path_ratios(found: list[tuple[Block, str]], paths: Paths, rules: PathRules) -> tuple[dict[int, float], dict[int, float]]:
    """Per path, in page order: the fused ratio, and the share of its text that lies in links."""
    sums: dict[int, list[float]] = {}  # text outside links, punctuation, blocks, all text
    for b, t in found:
        own = sums.setdefault(b.path, [0.0, 0.0, 0.0, 0.0])
        own[0] += max(0, len(t) - b.linked)
        own[1] += len(PUNCTUATION.findall(t)) if b.linked < len(t) / 2 else 0
        own[2] += 1
        own[3] += len(t)
    table = np.array(list(sums.values()))
    links = 1 - table[:, 0] / table[:, 3]
    factor = np.where([paths.named[p] for p in sums], rules.named, 1.0) * (1 - links)
    # furniture by name or by links lends its neighbours nothing
    length, marks = (smoothed(table[:, k] / table[:, 2] * factor) for k in (0, 1))
    fused = np.sqrt((length + 1) * (marks + 0.1)) * factor
    return dict(zip(sums, fused.tolist())), dict(zip(sums, links.tolist()))


def main_text(html: str | None, rules: PathRules = PathRules()) -> str:
    """The content blocks of a page, white space collapsed, one block a line."""
    if not html:
        return ""
    blocks, paths = blocks_of(html)
    found = [(b, " ".join("".join(b.pieces).split())) for b in blocks]
    found = [(b, t) for b, t in found if t]
    if any(b.held for b, _ in found):
        found = [(b, t) for b, t in found if b.held]
    if not found:
        return ""
    ratio, links = path_ratios(found, paths, rules)
    least = rules.threshold * max(ratio.values())
    chosen = [p for p, r in ratio.items() if r >= least]
    inside = paths.under(paths.common(chosen))
    listed: dict[int, int] = {}
    for b, _ in found:
        listed[b.path] = listed.get(b.path, 0) + 1

    def content(path: int) -> bool:
        if ratio[path] >= least:
            return True
        return not paths.named[path] and not (links[path] > rules.linked and listed[path] > 1)

    first = next(k for k, (b, _) in enumerate(found) if inside[b.path] and content(b.path))
    tag = lambda path: paths.label[path].partition(".")[0].partition("#")[0]
    is_title = lambda path: tag(path) in HEADINGS and content(path)
    titles = [] if any(inside[b.path] and is_title(b.path) for b, _ in found[first:]) else [k for k in range(first) if is_title(found[k][0].path)]
    kept = [t for k, (b, t) in enumerate(found) if (inside[b.path] and content(b.path)) or k in titles[-1:]]
    return "\n".join(kept)


def extract_pages(
    df: DataFrame, id_col: str = "page_id", html_col: str = "html", rules: PathRules = PathRules(), carry: tuple[str, ...] = ("url",)
) -> DataFrame:
    """Per page: id, the carried columns, ``text`` and ``n_chars``."""
    bound_batches(df.sparkSession)
    kept = [id_col, *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            texts = [main_text(x.as_py(), rules) for x in batch.column(0)]
            own = [batch.column(k + 1) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*kept, "text", "n_chars"],
            )

    fields = [df.schema[c] for c in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return df.select(html_col, *kept).mapInArrow(run, T.StructType(fields))
