"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, table

# HTML elements by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - frozenset("br caption dd dt html body head li option optgroup tbody td tfoot th thead tr".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
            "thead": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl div section article aside main nav header footer form body html".split())
DROPPED = frozenset(
    "head title script style noscript template iframe object embed svg canvas math audio video nav menu aside "
    "footer form button select textarea input label fieldset dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                  "toolbar tablist note status".split())
HINTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|"
    r"copyright|disqus|footer|gdpr|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|notification|overlay|"
    r"pager|pagination|popup|promos?|promotion|recommend\w*|related|replies|reply|respond|search|share|sharing|"
    r"sidebar|signup|skip|social|sponsor\w*|subscribe|teasers?|toolbar|widget)(?=$|[\s_\d-])", re.IGNORECASE)
_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")


class Page:
    """A page's elements in page order (parents before children) and its text between them."""

    def __init__(self, source: str):
        self.tags, self.parents, self.dropped, self.links = ["#root"], [-1], [False], [False]
        self.texts: list[tuple[int, str | None]] = []  # (element, text), None where a block begins or ends
        self._open = [0]
        self._read(source)

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = _MARKUP.search(source, at)
            if not m:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                self._end(tag)
            else:
                self._start(tag, m[3])
                if tag in RAW:  # nothing in it is markup
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                    if tag in ("title", "textarea"):
                        self._text(source[at:close.start() if close else n])
                    at = close.end() if close else n
                    self._end(tag)

    def _text(self, text: str) -> None:
        self.texts.append((self._open[-1], entities.unescape(text) if "&" in text else text))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SCOPES)
        parent = self._open[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.links.append(self.links[parent] or tag == "a")
        self.dropped.append(self._hinted(tag, attributes))
        if tag in BLOCK:
            self.texts.append((parent, None))
        if tag not in VOID:
            self._open.append(len(self.tags) - 1)

    def _hinted(self, tag: str, attributes: str) -> bool | None:
        """Whether the element is no main text for its kind; None if only its names say so."""
        if tag in DROPPED:
            return True
        if tag in ("html", "body", "main", "article") or not attributes.strip():
            return None if tag == "header" else False
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
        if found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true":
            return True
        if "none" in found.get("style", "") and re.search(r"display\s*:\s*none", found["style"]):
            return True
        names = f"{found.get('class', '')} {found.get('id', '')}"
        return None if tag == "header" or HINTS.search(names) else False

    def _close(self, tags: set[str], barrier: frozenset) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[k]]
            if tag in tags:
                self.texts.append((self.parents[self._open[k]], None))
                del self._open[k:]
                return
            if tag in barrier:
                return

    def _end(self, tag: str) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            own = self.tags[self._open[k]]
            if own == tag:
                if any(self.tags[i] in BLOCK for i in self._open[k:]):
                    self.texts.append((self.parents[self._open[k]], None))
                del self._open[k:]
                return
            if tag not in BLOCK and own in BLOCK:
                return  # an inline end does not close the blocks around it

    def kept(self) -> list[bool]:
        """Elements that are not dropped by kind, and by name if they hold no article."""
        n = len(self.tags)
        holds = [t in ("article", "main") for t in self.tags]
        for i in range(n - 1, 0, -1):
            if holds[i]:
                holds[self.parents[i]] = True
        inside = [False] * n  # a heading's header within an article stays
        out = [True] * n
        for i in range(1, n):
            p = self.parents[i]
            inside[i] = inside[p] or self.tags[i] == "article"
            by_name = self.dropped[i] is None and not holds[i] and not (self.tags[i] == "header" and inside[i])
            out[i] = out[p] and not (self.dropped[i] is True or by_name)
        return out


def densities(page: Page, kept: list[bool]) -> tuple[list[float], list[float]]:
    """Composite text density of every element and the sum of its children's.

    Characters a tag, damped by the share of links: C/T * log(C/LC * T/LT) to the base
    ln(C/NC * LC + LCb/Cb * C + e), with C characters, T tags, LC and LT those of links,
    NC = C - LC, and b for the whole page; counts of 0 below a line count as 1.
    """
    n = len(page.tags)
    c, lc, t, lt = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in page.texts:
        if text and kept[i]:
            size = len(_SPACE.sub(" ", text).strip())
            c[i] += size
            if page.links[i]:
                lc[i] += size
    for i in range(n - 1, 0, -1):
        if kept[i]:
            p = page.parents[i]
            c[p] += c[i]
            lc[p] += lc[i]
            t[p] += t[i] + 1
            lt[p] += lt[i] + (page.tags[i] == "a")
    share = lc[0] / max(1, c[0])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if kept[i] and c[i]:
            tags = max(1, t[i])
            base = math.log(c[i] / max(1, c[i] - lc[i]) * lc[i] + share * c[i] + math.e)
            ratio = c[i] / max(1, lc[i]) * tags / max(1, lt[i])
            density[i] = c[i] / tags * (math.log(max(ratio, 1.0)) / math.log(base) if base > 1 else math.log(max(ratio, 1.0)))
        if i:
            total[page.parents[i]] += density[i]
    return density, total


def main_text(source: str) -> str:
    """The page's main text, blocks joined by one line feed.

    The element with the greatest sum of its children's densities is chosen, or the article
    around it. Parts beside the way from the page down to it belong to the text too if they
    are at least as dense as the least dense element of that way. An article holds its text
    whole, so parts beside it never join.
    """
    page = Page(source)
    kept = page.kept()
    density, total = densities(page, kept)
    n = len(page.tags)
    best = max((i for i in range(n) if kept[i]), key=lambda i: (total[i], -i))
    if not any(total):
        best = 0
    way = [best]
    while page.parents[way[-1]] >= 0:
        way.append(page.parents[way[-1]])
    articles = [i for i in way if page.tags[i] == "article"] or [i for i in way if page.tags[i] == "main"]
    taken = [False] * n
    if articles:
        taken[articles[-1]] = True
    else:
        least = min((density[i] for i in way if i and density[i] > 0), default=0.0)
        taken[best] = True
        above = set(way)
        for i in range(1, n):
            if page.parents[i] in above and i not in above and page.parents[i] != best and density[i] >= least > 0:
                taken[i] = True
    for i in range(1, n):
        taken[i] = kept[i] and (taken[i] or taken[page.parents[i]])
    blocks: list[str] = []
    part: list[str] = []
    for i, text in [*page.texts, (0, None)]:
        if text is None:
            block = " ".join("".join(part).split())
            if block:
                blocks.append(block)
            part = []
        elif taken[i]:
            part.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points).

    Null or blank pages, and pages of boilerplate only, have an empty text. Repeated rows
    stay. A page is parsed in one task, whole; pages do not meet, so nothing is shuffled.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(h) for (hs,) in columns_of([part], "html") for h in hs]
                yield pa.RecordBatch.from_arrays(
                    [part.column(at("page_id")), part.column(at("url")), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
