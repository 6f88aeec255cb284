"""Main text of web pages by tree scoring.

A page is read into elements and blocks of text. Each paragraph block has points for its
length and its commas, which it passes to its ancestors, less to farther ones, discounted by
the share of its text that stands in links. The container of the most points is the article;
siblings that score well or read like prose belong to it too. Page furniture (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) neither scores
nor is kept.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, quoted

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end the block of text before and after them.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead title tr ul video audio canvas".split()
)
#: Elements whose text never belongs to the article.
FURNITURE = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video nav footer aside menu "
    "form fieldset button select option textarea input label dialog title".split()
)
#: Paragraph elements give their points to the parent; other elements with text of their own keep them.
PARAGRAPH = frozenset("p pre blockquote td th li dd dt h1 h2 h3 h4 h5 h6 figcaption caption summary address".split())
#: Start tags that end an open element of these kinds, up to the nearest element named last.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
P_ENDS = BLOCK - frozenset("br body head html title option li dt dd td th tr tbody thead tfoot caption summary".split())
P_STOPS = frozenset("td th li dd dt div article section body html table blockquote button".split())

#: Words of class names, ids and roles that mark page furniture.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notification alert popup modal overlay sidebar aside rail widget menu nav navbar navigation breadcrumb "
    "breadcrumbs topbar toolbar footer foot masthead comment comments commentlist disqus replies reply respond discussion "
    "social share sharing related recommended recommendations newsletter subscribe subscription signup login search "
    "pagination pager contentinfo complementary hidden skip outbrain taboola".split()
)
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
LAYOUT = re.compile(r"(?:with|has|no|without)[-_]\w+", re.IGNORECASE)  # says what else the page has
SPACE = re.compile(r"\s+")

#: Production parameters.
LINK_SHARE = 0.5  # lists and boxes with more of their text in links are menus
SIBLING_SHARE = 0.2
PROSE_CHARS = 80


def is_furniture(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    for name, value in attrs:
        if name in ("hidden",) or (name == "aria-hidden" and value == "true"):
            return tag not in ("body", "html")
        if name in ("class", "id", "role") and value and tag not in ("body", "html", "article", "main"):
            words = {w.lower() for w in SPLIT.split(LAYOUT.sub("", value))}
            if MARKS & words or ("header" in words and not in_article):
                return True
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return tag not in ("body", "html")
    return False


class Page(HTMLParser):
    """Elements by number (parent, tag, whether furniture) and blocks (element, text, link characters).

    ``places`` has, per tag, where its open elements stand in the stack, so that no tag searches the stack.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.off, self.article = [-1], ["#page"], [False], [False]
        self.open = [0]
        self.places: dict[str, list[int]] = {}
        self.block_places = [0]
        self.links = 0
        self.blocks: list[tuple[int, str, int]] = []
        self.parts: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append((self.open[self.block_places[-1]], text, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def close(self) -> None:
        super().close()
        self.flush()

    def _end(self, down_to: int) -> None:
        """Close the open elements above place ``down_to`` of the stack, and that one."""
        for e in self.open[down_to:]:
            self.links -= self.tag[e] == "a"
            self.places[self.tag[e]].pop()
        while self.block_places[-1] >= down_to:
            self.block_places.pop()
        del self.open[down_to:]

    def _place(self, tags) -> int:
        """The last place of the stack with one of the tags, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _last(self, tags, stops) -> int | None:
        k = self._place(tags)
        return k if k and k >= self._place(stops) else None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.flush()
        if tag in P_ENDS and (k := self._last({"p"}, P_STOPS)) is not None:
            self._end(k)
        if tag in CLOSES and (k := self._last(*CLOSES[tag])) is not None:
            self._end(k)
        if tag in VOID:
            return
        top = self.open[-1]
        self.parent.append(top)
        self.tag.append(tag)
        self.off.append(self.off[top] or is_furniture(tag, attrs, self.article[top]))
        self.article.append(self.article[top] or tag in ("article", "main"))
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.block_places.append(len(self.open))
        self.open.append(len(self.tag) - 1)
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes void elements only, and those never open

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        stops = () if tag in ("body", "html", "article", "main", "table") else ("article", "main", "table")
        if tag not in VOID and (k := self._last({tag}, stops)) is not None:
            self._end(k)

    def handle_data(self, data: str) -> None:
        if not self.off[self.open[-1]]:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def passed_up(points: list[float], parent: list[int]) -> list[float]:
    """Scores of elements: all of their own points, half of those of their children, a sixth of the next, and from
    there on a third of each step. An element's number is larger than its parent's, so one pass adds them up."""
    nearer, farther = [0.0] * len(points), [0.0] * len(points)
    for k in range(len(points) - 1, 0, -1):
        up = parent[k]
        nearer[up] += points[k]
        farther[up] += nearer[k] / 6 + farther[k] / 3
    return [p + n / 2 + f for p, n, f in zip(points, nearer, farther)]


def main_blocks(html: str) -> list[str]:
    """Blocks of the article in page order."""
    page = Page()
    page.feed(html)
    page.close()
    parent, tag, blocks = page.parent, page.tag, page.blocks
    if not blocks:
        return []
    size = len(tag)
    points, chars, linked, first = [0.0] * size, [0] * size, [0] * size, [len(blocks)] * size
    for n, (element, text, in_links) in enumerate(blocks):
        worth = (1 + text.count(",") + text.count("，") + len(text) / 100) * (1 - in_links / len(text))
        points[parent[element] if tag[element] in PARAGRAPH and element else element] += worth
        chars[element] += len(text)
        linked[element] += in_links
        first[element] = min(first[element], n)
    for k in range(size - 1, 0, -1):
        up = parent[k]
        chars[up] += chars[k]
        linked[up] += linked[k]
        first[up] = min(first[up], first[k])
    score = passed_up(points, parent)
    share = [linked[k] / chars[k] if chars[k] else 0.0 for k in range(size)]
    best = max((k for k in range(size) if score[k] > 0), key=lambda k: (score[k] * (1 - share[k]), -k), default=None)
    if best is None:
        return []
    up = best
    while up:  # an article element holds the container of the most points together with its like
        if tag[up] in ("article", "main"):
            best = up
            break
        up = parent[up]
    taken = {best}
    if tag[best] not in ("article", "main", "body", "html", "#page"):
        least = max(10.0, SIBLING_SHARE * score[best])
        for k in range(1, size):
            if k != best and parent[k] == parent[best] and chars[k]:
                prose = tag[k] == "p" and share[k] < 0.25 and (chars[k] > PROSE_CHARS or blocks[first[k]][1].endswith("."))
                if score[k] >= least and share[k] <= LINK_SHARE or prose or tag[k] == "h1":
                    taken.add(k)
    boxes = ("ul", "ol", "dl", "div", "section", "table")
    kept, cut = [False] * size, [False] * size  # inside what is taken, inside a menu
    for k in range(size):
        up = parent[k]
        kept[k] = k in taken or (up >= 0 and kept[up])
        cut[k] = (tag[k] in boxes and k not in taken and share[k] > LINK_SHARE) or (up >= 0 and cut[up])
    return [text for element, text, _ in blocks if kept[element] and not cut[element]]


def main_text(html: str) -> str:
    return " ".join(main_blocks(html))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per row: id, url, ``text`` of the article and ``n_chars``.

    Every row gives one row, also repeated ones and those with a null id or url. A null or
    empty page, or one without an article, gives the empty text. Whole pages are read, of
    any length; other columns are not looked at.
    """
    rows = pages.select(
        F.col(quoted(id_col)).alias("id"), F.col(quoted(url_col)).alias("url"), F.col(quoted(html_col)).alias("html")
    )

    def extract_batches(batches):
        for batch in batches:
            texts = pa.array([main_text(h) if h else "" for h in column(batch, "html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["id", "url", "text"])

    id_type = pages.schema[id_col].dataType.simpleString()
    out = arrow_map(rows, extract_batches, f"id {id_type}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
