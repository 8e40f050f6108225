"""Main text of web pages by the maximum-scoring run of tokens: words add, tags subtract."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready

SAMPLE = 2_000  # pages the weights are learned from, about
INSIDE = 1.0  # per word in a marked article, at least; tags and skipped parts in it weigh nothing
OUTSIDE = -2.0  # per word outside the article, on pages that mark one
SKIPPED = -1.0  # for a whole part that is never content
LIMIT = 3.0  # of a word's weight
TAG_RANGE = (-1.0, -0.02)
UNSEEN = {"w:a": -0.5}  # a word of a link, where no page tells; other unseen words are 1

SPECIAL = re.compile("[>\"']")
NAME_END = re.compile(r"[\s/>]")
ARTICLE = re.compile(r"<article[\s>]", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"\S+")

RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "br", "td", "th", "ruby", "rb", "rt",
}
SKIP_TAGS = {
    "aside", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "header", "iframe", "input", "menu",
    "nav", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title",
}
SKIP_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "navigation", "search"}
# Parts of class names and ids that name something other than the article.
SKIP_NAMES = {
    "ad", "ads", "adslot", "advert", "advertisement", "advertising", "adverts", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "share", "sharing",
    "sidebar", "signup", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
# On these elements only names of comments count; others there describe the page.
WIDE_TAGS = {"html", "body", "main", "article"}
COMMENT_NAMES = {"comment", "comments", "disqus", "replies"}
CLOSES_SAME = {"dd", "dt", "li", "option", "p", "td", "th", "tr"}


# Elements whose names are features; all others count as one.
KNOWN = INLINE | VOID | SKIP_TAGS | {
    "address", "article", "audio", "blockquote", "body", "caption", "center", "col", "dd", "details", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "legend", "li",
    "main", "map", "math", "ol", "optgroup", "p", "picture", "pre", "progress", "section", "summary", "table", "tbody",
    "tfoot", "thead", "tr", "ul", "video",
}


class Scanner:
    """Where the markup of a page begins and ends, in time linear in its length whatever the page holds.

    A `<` begins a tag if a `>` outside quotes closes it, else it is text. What a failed search has
    passed (quotes opened outside of quotes) fails from there for any later search too, and is kept;
    the next special character is looked for once for all that come before it.
    """

    def __init__(self, source: str):
        self.source, self.last = source, source.rfind(">")
        self.dead: set[int] = set()
        self.seen = {SPECIAL: (0, -1), NAME_END: (0, -1)}

    def _next(self, pattern: re.Pattern, at: int) -> int:
        """The first place from `at` on that the pattern matches; the end of the page if there is none."""
        begin, found = self.seen[pattern]
        if not begin <= at <= found:
            match = pattern.search(self.source, at)
            found = match.start() if match else len(self.source)
            self.seen[pattern] = (at, found)
        return found

    def tag_end(self, at: int) -> int:
        """The closing bracket of the tag whose name ends at `at`, or -1."""
        source, opened = self.source, []
        while at <= self.last:
            at = self._next(SPECIAL, at)
            if at >= len(source):
                break
            if source[at] == ">":
                return at
            if at in self.dead:
                break
            opened.append(at)
            at = source.find(source[at], at + 1) + 1
            if not at:
                break
        self.dead.update(opened)
        return -1

    def tag(self, at: int) -> tuple[bool, str, str, int] | None:
        """Whether it closes, name, rest and end of the tag at the `<` at `at`; None if it is text."""
        source = self.source
        begin = at + 2 if source.startswith("/", at + 1) else at + 1
        if begin > self.last or not (source[begin].isascii() and source[begin].isalpha()):
            return None
        stop = self._next(NAME_END, begin)
        end = self.tag_end(stop)
        if end < 0:
            return None
        return begin > at + 1, source[begin:stop].lower(), source[stop:end], end + 1

    def text_end(self, at: int) -> int:
        """The next `<` from `at` on that begins a tag, a comment or a declaration."""
        source = self.source
        while (at := source.find("<", at)) >= 0:
            if source[at + 1 : at + 2] in ("!", "?") or self.tag(at):
                return at
            at += 1
        return len(source)

    def aside_end(self, at: int) -> int:
        """The end of the comment or declaration at `at`; an open one reaches the end of the page."""
        closing = "-->" if self.source.startswith("<!--", at) else ">"
        end = self.source.find(closing, at + 2)
        return len(self.source) if end < 0 else end + len(closing)


@dataclass
class Part:
    """A token that is scored: a run of text, a tag, or a part that is skipped."""

    kind: str  # feature: "w:tag", "t:tag" or "skip"
    words: int = 0
    inside: bool = True  # in the marked article, if the page marks one
    text: str = ""
    block: int = 0


@dataclass
class Page:
    parts: list[Part] = field(default_factory=list)
    marked: bool = False


def _skips(name: str, rest: str) -> bool:
    if name in SKIP_TAGS:
        return True
    if "=" not in rest and "hidden" not in rest:
        return False
    for key, *values in ATTRIBUTE.findall(rest):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key in ("class", "id"):
            names = set(re.split(r"[^a-z0-9]+", value))
            if names & (COMMENT_NAMES if name in WIDE_TAGS else SKIP_NAMES):
                return True
        elif key == "role" and value in SKIP_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _feature(name: str) -> str:
    return name if name in KNOWN else "other" if name else ""


def read(source: str) -> Page:
    """The page as scored tokens, in one pass. Text in skipped parts is left out."""
    page, scan = Page(), Scanner(source)
    parts, stack, opened = page.parts, [], Counter()
    skip_at = 0  # depth of the outermost skipped element, 0 if none
    block, place, size = 0, 0, len(source)
    main = "article" if ARTICLE.search(source) else "main"

    def pop_to(depth: int) -> None:
        nonlocal skip_at
        while len(stack) > depth:
            opened[stack.pop()] -= 1
        if len(stack) < skip_at:
            skip_at = 0

    while place < size:
        if source.startswith(("<!", "<?"), place):
            place = scan.aside_end(place)
            continue
        token = scan.tag(place) if source[place] == "<" else None
        if token is None:
            begin, place = place, scan.text_end(place + 1)
            if skip_at:
                continue
            text = source[begin:place]
            text = html.unescape(text) if "&" in text else text
            words = len(WORD.findall(text))
            inner = "a" if opened["a"] else stack[-1] if stack else ""
            parts.append(Part(f"w:{_feature(inner)}", words, opened[main] > 0, text, block))
            continue
        closes, name, rest, place = token
        if closes:
            if name not in INLINE:
                block += 1
            if opened[name]:
                depth = len(stack) - 1
                while stack[depth] != name:
                    depth -= 1
                inside = opened[main] > 0
                quiet = skip_at
                pop_to(depth)
                if not quiet:
                    parts.append(Part(f"t:{_feature(name)}", 0, inside))
            continue
        if name not in INLINE:
            block += 1
            if opened["p"] and not skip_at:  # a paragraph ends where another block begins
                pop_to(len(stack) - 1 - stack[::-1].index("p"))
        if name in CLOSES_SAME and stack and stack[-1] == name:
            pop_to(len(stack) - 1)
        if not skip_at and name == main:
            page.marked = True
        if not skip_at:
            skips = _skips(name, rest)
            if name in ("br", "td", "th"):
                parts.append(Part(f"t:{name}", 0, opened[main] > 0, " ", block))
            else:
                parts.append(Part("skip" if skips else f"t:{_feature(name)}", 0, opened[main] > 0 or name == main))
        else:
            skips = False
        if name in VOID or rest.endswith("/") and name not in INLINE | SKIP_TAGS | {"div", "p"}:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, place)
            place = end.end() if end else size
            continue
        stack.append(name)
        opened[name] += 1
        if skips:
            skip_at = len(stack)
    return page


def _weight(weights: dict[str, float], part: Part, marked: bool) -> float:
    """The score of a part. Nothing inside a marked article is negative: a run that meets one has all its words."""
    if marked and part.inside:
        return max(INSIDE, weights.get(part.kind, INSIDE)) * part.words
    if part.kind == "skip":
        return SKIPPED
    if not part.words:
        return weights.get(part.kind, -0.1)
    if marked:
        return OUTSIDE * part.words
    return weights.get(part.kind, UNSEEN.get(part.kind, 1.0)) * part.words


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the run with the largest sum, the longest first one; empty if none is positive."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best + 1e-12:
            best, begin, end = total, start, i + 1
    return begin, end


def main_text(source: str | None, weights: dict[str, float]) -> str:
    page = read(source or "")
    begin, end = best_run([_weight(weights, p, page.marked) for p in page.parts])
    blocks: dict[int, list[str]] = {}
    for part in page.parts[begin:end]:
        if part.text and (part.inside or not page.marked):
            blocks.setdefault(part.block, []).append(part.text)
    lines = (" ".join("".join(texts).split()) for texts in blocks.values())
    return "\n\n".join(line for line in lines if line)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from pages that are labelled by their own markup: those with an article or main element.

    A feature is the element a word stands in (link or innermost element), or a tag's name. It is
    counted inside and outside the marked part; its weight is the log of the ratio. Tags are kept
    negative, words within LIMIT. Only the counts reach the driver, two rows for each name in KNOWN at most.
    """
    share = min(1.0, sample / max(1, pages.count()))
    chosen = pages.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(9)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        inside, outside = Counter(), Counter()
        for source in batch.column(0).to_pylist():
            page = read(source or "")
            if page.marked:
                for p in page.parts:
                    (inside if p.inside else outside)[p.kind] += max(1, p.words)
        names = [*{*inside, *outside}]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([inside[n] for n in names], pa.int64()),
             pa.array([outside[n] for n in names], pa.int64())],
            ["name", "inside", "outside"],
        )

    counts = (
        mapped(chosen.select(html_col), count, "name string, inside long, outside long")
        .groupBy("name")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()
    )
    out = {}
    for name, inside, outside in counts:
        ratio = float(np.log((inside + 1) / (outside + 1)))
        low, high = (-LIMIT, LIMIT) if name.startswith("w:") else TAG_RANGE
        # Words of a kind seen inside at all are content when they stand among content.
        out[name] = float(np.clip(ratio, low if inside == 0 else max(low, -0.5), high))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """All rows and columns of `pages` but the html, with _text, the main text of the whole page.

    Null or empty html gives an empty text, and so does a page without positive words. Repeated rows
    are extracted one by one; an empty table gives no rows. A column of `pages` named _text is replaced.
    """
    ready(pages.sparkSession)
    weights = learn(pages, id_col, html_col) if weights is None else weights
    others = [c for c in pages.columns if c not in (html_col, "_text")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(s, weights) for s in batch.column(html_col).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in others], pa.array(texts, pa.string())], [*others, "_text"]
        )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in others)
    return mapped(pages.select(*others, html_col), run, f"{schema}, _text string" if others else "_text string")
